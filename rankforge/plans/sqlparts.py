"""Shared DuckDB SQL fragments for the oracles (CTE bodies over the driver views)."""

# interactions(user_id, item_id, rating, ts): latest row per (user, item)
INTERACTIONS = """
SELECT user_id, item_id, rating, ts FROM (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(floor((l_quantity - 1) / 10) AS DOUBLE) + 1 AS rating, o_orderdate AS ts,
         row_number() OVER (PARTITION BY o_custkey, l_partkey
                            ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC,
                                     floor((l_quantity - 1) / 10) DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t WHERE rn = 1
"""

RAW_RATINGS = """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       CAST(floor((l_quantity - 1) / 10) AS DOUBLE) + 1 AS rating, o_orderdate AS ts,
       l_orderkey AS order_key, l_linenumber AS line_no
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

ITEMS = """
SELECT p_partkey AS item_id, p_name AS title, string_split(p_name, ' ') AS genres,
       p_brand AS director, 1950 + p_size AS year, p_retailprice AS popularity, p_type AS family
FROM part
"""

# 5 folds by a deterministic order (no hash dependence): per user, rows dealt
# round robin by item id, offset by the user id.
FOLDED = """
SELECT *, CAST((row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 + user_id) % 5 AS INTEGER) AS fold
FROM r
"""


def with_(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n"


def rs(expr: str) -> str:
    """Ranking key: the score rounded to 1e-9."""
    return f"round({expr}, 9)"


def wrap(sql: str, doubles: list[str]) -> str:
    """Round the named double columns to 6 places (and -0.0 -> 0.0)."""
    if not doubles:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"
