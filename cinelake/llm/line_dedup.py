"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host (``source``). For every line (outer blanks trimmed)
the pages of the host that contain it are counted and divided by the number of
the host's pages; a line whose share exceeds ``max_ratio``, on ``min_pages`` or
more, is boilerplate of that host and all its occurrences there are dropped.

A page holds (mean lines) / max_ratio boilerplate lines of its host at most, so
the list of each host is short; it is joined to the pages by host, broadcast
only if its counted rows are few. Lines are compared by their MD5.

Defined results: one row out per row in, in which only ``text`` differs: the
remaining lines in order. A null text stays null (0 lines), an empty one empty
(1 line); blank lines are never dropped. Null hosts form one host. Repeated
rows count as pages of their own. Other columns are kept as they are, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import if_small

MAX_RATIO = 0.10
MIN_PAGES = 5


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def boilerplate_lines(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """h_source, digests: the boilerplate lines of each host."""
    pages = docs.select("source", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), F.trim))).alias("line"))
    held = (pages.where("line <> ''").select("source", F.unhex(F.md5("line")).alias("digest"))
            .groupBy("source", "digest").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= min_pages))
    hosts = if_small(docs.groupBy(F.col("source").alias("h_source")).agg(F.count(F.lit(1)).alias("n_host")), "line-hosts")
    over = held.join(hosts, F.col("source").eqNullSafe(F.col("h_source"))).where(
        F.col("n_pages") > F.lit(max_ratio) * F.col("n_host"))
    return over.groupBy("h_source").agg(F.collect_list("digest").alias("digests"))


def _cleaned(docs: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """_row (all columns of docs), text (cleaned), n_lines, n_dropped."""
    lists = if_small(boilerplate_lines(docs, max_ratio, min_pages), "line-boilerplate")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text", "source")
    lines = F.split("text", "\n")
    kept = F.when(F.col("digests").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains("digests", _digest(x))))
    out = rows.join(lists, F.col("source").eqNullSafe(F.col("h_source")), "left").withColumn("_kept", kept)
    n_lines, n_kept = (F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(x)) for x in (lines, F.col("_kept")))
    return out.select("_row", F.array_join("_kept", "\n").alias("text"), n_lines.cast("bigint").alias("n_lines"),
                      (n_lines - n_kept).cast("bigint").alias("n_dropped"))


def drop_boilerplate(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """doc_id, the cleaned text, its lines before and the lines dropped."""
    return _cleaned(docs, max_ratio, min_pages).select(F.col("_row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


def clean_texts(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows and columns of ``docs`` with ``text`` cleaned (and ``n_chars``,
    if there is such a column, counted anew for texts that lost a line)."""
    out = _cleaned(docs, max_ratio, min_pages)

    def column(c: str):
        old = F.col("_row").getField(c)
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)
    return out.select(*[column(c) for c in docs.columns])


ORACLE_SQL = f"""
WITH held AS (
  SELECT source, trim(line) AS line, count(DISTINCT doc_id) AS n_pages
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE trim(line) <> '' GROUP BY ALL),
hosts AS (SELECT source, count(*) AS n_host FROM documents GROUP BY source),
lists AS (
  SELECT h.source, list(h.line) AS lines FROM held h JOIN hosts USING (source)
  WHERE h.n_pages >= {MIN_PAGES} AND h.n_pages > {MAX_RATIO}E0 * n_host GROUP BY h.source),
cut AS (
  SELECT d.doc_id, string_split(d.text, chr(10)) AS all_lines,
    CASE WHEN b.lines IS NULL THEN string_split(d.text, chr(10))
         ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(b.lines, trim(x))) END AS kept
  FROM documents d LEFT JOIN lists b ON d.source = b.source)
SELECT doc_id, array_to_string(kept, chr(10)) AS text,
  CAST(coalesce(len(all_lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(all_lines), 0) - coalesce(len(kept), 0) AS BIGINT) AS n_dropped
FROM cut"""
