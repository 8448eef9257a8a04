"""Top-k under an item prior: what the lists are, and that seen items aren't shuffled or expanded."""

from __future__ import annotations

import numpy as np

from rankforge.operators import ranking


def by_hand(prior, users, seen, k):
    out = set()
    for by, user in users:
        order = sorted(((s, i) for b, i, s in prior if b == by), key=lambda x: (-x[0], x[1]))
        free = [(i, s) for s, i in order if (by, user, i) not in seen]
        out |= {(by, user, i, s, rank) for rank, (i, s) in enumerate(free[:k], 1)}
    return out


def test_lists_are_those_of_a_whole_ranking(spark):
    rng = np.random.default_rng(5)
    prior = [(b, i, float(rng.integers(0, 6))) for b in range(3) for i in range(40)]
    users = [(b, u) for b in range(3) for u in range(9)]
    # User 0 has seen everything, user 1 the whole head, user 2 nothing; item 99 is not in the catalogue.
    seen = {(b, 0, i) for b in range(3) for i in range(40)} | {(b, 1, i) for b, i, s in prior if s >= 3}
    seen |= {(b, u, int(i)) for b in range(3) for u in range(3, 9) for i in rng.choice(40, 3 * u, replace=False)} | {(0, 4, 99)}
    p = spark.createDataFrame(prior, "fold int, item_id long, score double")
    u = spark.createDataFrame(users * 2, "fold int, user_id long")
    # Rows that come twice, and rows without a user.
    x = spark.createDataFrame([*seen, *seen, (0, None, 1)], "fold int, user_id long, item_id long")
    got = ranking.top_k_prior(p, u, x, 5, by=["fold"])
    assert {tuple(r) for r in got.select("fold", "user_id", "item_id", "score", "rank").collect()} == by_hand(prior, users, seen, 5)
    assert got.count() == len(by_hand(prior, users, seen, 5))


def test_seen_items_that_hold_for_every_model(spark):
    prior = [(m, i, float(i if m else -i)) for m in range(2) for i in range(20)]
    users = [(m, u) for m in range(2) for u in range(4)]
    seen = {(u, i) for u in range(4) for i in range(0, 20, u + 1)}
    got = ranking.top_k_prior(spark.createDataFrame(prior, "model int, item_id long, score double"), spark.createDataFrame(users, "model int, user_id long"),
                              spark.createDataFrame([*seen], "user_id long, item_id long"), 3, by=["model"])
    want = by_hand(prior, users, {(m, u, i) for m in range(2) for u, i in seen}, 3)
    assert {tuple(r) for r in got.select("model", "user_id", "item_id", "score", "rank").collect()} == want


def test_seen_items_are_not_joined_position_by_position(spark):
    """The rows of a user are its k positions, however many items it has seen."""
    n = 400
    p = spark.createDataFrame([(i, float(n - i)) for i in range(n)], "item_id long, score double")
    u = spark.createDataFrame([(7,)], "user_id long")
    x = spark.createDataFrame([(7, i) for i in range(200, n)], "user_id long, item_id long")
    got = ranking.top_k_prior(p, u, x, 4)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and [r.item_id for r in got.orderBy("rank").collect()] == [0, 1, 2, 3]
