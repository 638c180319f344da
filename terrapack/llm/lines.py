"""Line dedup: lines that occur in many documents go from all of them. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, content_id, stored, table, text_or_empty

MIN_DOCUMENTS = 10


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(SPACE)))


def line_hash(line: Column) -> Column:
    """16 bytes for the line's key; null for an empty key, which is never counted."""
    key = line_key(line)
    return F.when(key != "", F.unhex(F.md5(key.cast("binary"))))


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """All columns of `docs` with the frequent lines gone from `text`, and n_lines and n_dropped.

    Lines are exploded as hashes, once for each document and hash, and counted; repeated rows count as documents of
    their own. The frequent hashes are joined to the hashes of each distinct text, and each text gets its list back,
    by which its lines are filtered in place: their order is that of the text, and only hashes and one copy of the
    texts are shuffled. The lists are a table of their own, so that a text of many copies is joined by several tasks. A null text is one empty line, and so is an empty one; it stays. A text that loses all its
    lines becomes empty. Column names that start with __tp_ are reserved.
    """
    rows = docs.withColumn("__tp_lines", F.split(text_or_empty(), "\n", -1))
    hashes = F.array_compact(F.array_distinct(F.transform("__tp_lines", line_hash)))
    lines = rows.select(content_id(text_or_empty()).alias("__tp_id"), F.explode(hashes).alias("hash"))
    frequent = stored(lines.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") >= min_documents).select("hash"), "frequent-lines")
    texts = stored(lines.join(frequent, "hash", "left_semi").groupBy("__tp_id").agg(F.collect_set("hash").alias("__tp_drop")), "texts-to-cut")
    keep = lambda x: ~F.coalesce(F.array_contains("__tp_drop", line_hash(x)), F.lit(False))
    out = rows.withColumn("__tp_id", content_id(text_or_empty())).join(texts, "__tp_id", "left")
    out = out.withColumn("__tp_kept", F.when(F.col("__tp_drop").isNull(), F.col("__tp_lines")).otherwise(F.filter("__tp_lines", keep)))
    more = {"text": F.array_join("__tp_kept", "\n"), "n_lines": F.size("__tp_lines").cast("long"), "n_dropped": (F.size("__tp_lines") - F.size("__tp_kept")).cast("long")}
    return out.withColumns(more).drop("__tp_id", "__tp_lines", "__tp_drop", "__tp_kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH lines AS (
  SELECT doc_id, rid, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= {MIN_DOCUMENTS}
), marked AS (
  SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
