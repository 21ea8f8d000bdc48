"""SQL text of the canonical views, used as CTEs by the DuckDB oracle.

They mirror ``cinelake.sources.tables``; the driver registers only the base
tables, so every oracle query is ``WITH <views> SELECT ...``.
"""

from __future__ import annotations

VIEWS = {
    "interactions": """
SELECT userId, movieId, rating, ts FROM (
 SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
        0.5E0 + 0.5E0 * floor((l.l_quantity - 1) / 5) AS rating, l.l_shipdate AS ts,
        row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
                           ORDER BY l.l_shipdate DESC, l.l_quantity DESC) AS rn
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) t WHERE rn = 1""",
    "movies": """
SELECT p_partkey AS movieId,
  CASE WHEN p_partkey % 40 = 7 THEN concat(p_name, ' ', p_brand)
       ELSE concat(p_name, ' ', p_brand, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
  CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)'
       ELSE concat_ws('|', p_type, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) END AS genres
FROM part""",
    "tags": """
SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
  CASE WHEN l.l_quantity = 50 THEN NULL
       ELSE concat(' ', o.o_orderpriority, ' ', c.c_mktsegment, ' ') END AS tag, l.l_shipdate AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey WHERE l.l_linenumber = 1""",
    "links": """
SELECT p_partkey AS movieId, 100000 + p_partkey AS imdbId,
  CASE WHEN p_partkey % 100 = 0 THEN NULL ELSE CAST(p_partkey * 10 AS DOUBLE) END AS tmdbId FROM part""",
    "rating_feed": """
SELECT event_id, ts, event_type, 0.5E0 + 0.5E0 * floor(least(value, 499.0E0) / 50) AS rating,
  value AS latency_ms FROM events""",
}

# Derived helper views used by several oracle queries.
DERIVED = {
    # Bayesian popularity per rated movie (m = 50), C = mean over all ratings.
    "pop": """
SELECT movieId, count(*) AS n_ratings, avg(rating) AS mean_rating,
  count(*) / (count(*) + 50.0E0) * avg(rating)
  + 50.0E0 / (count(*) + 50.0E0) * (SELECT avg(rating) FROM interactions) AS score
FROM interactions GROUP BY movieId""",
}


def with_views(sql: str, *extra: tuple[str, str]) -> str:
    """Prefix ``sql`` with every canonical view, derived view and extra CTE."""
    ctes = list(VIEWS.items()) + list(DERIVED.items()) + list(extra)
    body = ",\n".join(f"{name} AS ({text}\n)" for name, text in ctes)
    return f"WITH {body}\n{sql}"
