"""All fusion weights at once give what each gives alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rankforge.operators import fusion, ranking


def test_sweep_equals_one_weight_after_the_other(spark):
    rng = np.random.default_rng(9)
    # Group 3 has no candidate of the first engine, group 4 none of the second; scores repeat.
    rows = [[(g, int(i), float(rng.integers(0, 5))) for g in range(5) if g != skipped for i in rng.choice(30, 12, replace=False)] for skipped in (3, 4)]
    a, b = (spark.createDataFrame(r, "query_id long, item_id long, score double") for r in rows)
    alphas = [0.0, 0.3, 0.5, 0.95, 1.0]
    got = {(r.trial, r.query_id, r["rank"]): (r.item_id, round(r.fused_score, 9) + 0.0) for r in fusion.fusion_sweep(a, b, alphas, 6).collect()}
    want = {}
    for trial, alpha in enumerate(alphas):
        f = fusion.candidate_z_fusion(a, b, alpha, 1 - alpha).withColumn("_rs", F.round("fused_score", 9))
        want |= {(trial, r.query_id, r["rank"]): (r.item_id, round(r.fused_score, 9) + 0.0) for r in ranking.top_k(f, 6, "query_id", "_rs").collect()}
    assert got == want and len(got) == 5 * 5 * 6
