"""Exact dedup by content sort (DataFrame functions only).

Texts are lower-cased (A-Z only) and range-partitioned by their first characters,
then by a hash of the rest: Spark samples the splitters, which so stay short
however long the texts are. Inside a partition an external sort puts equal texts
next to each other. A window over that sort compares each text with its neighbour as
a whole; of equal ones the `keep` ("max" or "min") doc_id stays.

Hot texts: copies of one text would all fall between two splitters. A text whose hash
occurs more than rows / (4 * partitions) times is aggregated before anything is
shuffled: there are fewer than 4 * partitions such hashes, by that very bound, so the
list and the one row per text (told apart by SHA-256) may be broadcast. Of a hot
text only the rows with the doc_id that stays enter the sort as texts; its other rows
pass with their result alone.

Null text counts as empty; all empty texts are one group. Of rows that share both
text and doc_id one is kept. Rows that share a doc_id with other texts are judged
apart. A null doc_id stays only in a group of null doc_ids. Empty table: no rows.
Other columns are ignored by `exact_dedup` and kept by `distinct_texts`, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, handover, partitions, table


def _digest(norm):
    return F.sha2(F.encode(norm, "UTF-8"), 256)


def hot_texts(base: DataFrame, keep: str, most: int) -> DataFrame:
    """h, text_sha256, best, size of the texts with more than `most` rows; fewer than rows / most of them."""
    best = {"max": F.max, "min": F.min}[keep]
    keys = base.select("doc_id", "norm", F.xxhash64("norm").alias("h"))
    hashes = keys.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > most).select("h")
    found = handover(hashes, "hot-hashes")
    rows = keys.join(F.broadcast(found), "h").select("h", _digest("norm").alias("text_sha256"), "doc_id")
    return handover(rows.groupBy("h", "text_sha256").agg(best("doc_id").alias("best"), F.count(F.lit(1)).alias("size")), "hot-texts")


def content_sort(docs: DataFrame, keep: str, most: int | None, carry: bool) -> DataFrame:
    """Rows in sorted neighbourhoods: r.doc_id, r.norm, r.h, hot (text_sha256, best, size or null), place, best, size; with carry also `row`."""
    n = partitions(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_lower(F.col("text").cast("string")).alias("norm"))
    most = most or max(8, -(-docs.count() // (4 * n)))
    hot = hot_texts(base, keep, most)
    if carry:
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        base = docs.select(row).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), ascii_lower(F.col("row.text").cast("string")).alias("norm"))
    keyed = base.withColumn("h", F.xxhash64("norm"))
    if hot.take(1):
        told = F.broadcast(hot.select(F.col("h").alias("hot_h"), F.struct("text_sha256", "best", "size").alias("hot")))
        keyed = keyed.join(told, (F.col("h") == F.col("hot_h")) & (_digest("norm") == F.col("hot.text_sha256")), "left").drop("hot_h")
    else:
        keyed = keyed.withColumn("hot", F.lit(None).cast("struct<text_sha256:string,best:bigint,size:bigint>"))
    sent = F.col("hot").isNull() | F.col("doc_id").eqNullSafe(F.col("hot.best"))  # as a text
    if carry:
        keyed = keyed.filter(sent)
    else:
        keyed = keyed.withColumn("norm", F.when(sent, F.col("norm"))).withColumn("h", F.when(sent, F.col("h")).otherwise(F.xxhash64("doc_id")))
    rest = ["row"] if carry else []
    ranged = keyed.select("doc_id", "norm", "h", "hot", F.substring("norm", 1, 32).alias("front"), *rest).repartitionByRange(n, "front", "h")
    equal = W.partitionBy("front", "h", "norm")
    first = {"max": F.desc_nulls_last, "min": F.asc_nulls_last}[keep]("doc_id")
    return (
        ranged.withColumn("place", F.row_number().over(equal.orderBy(first, *[F.xxhash64(c) for c in rest])))
        .withColumn("all_best", {"max": F.max, "min": F.min}[keep]("doc_id").over(equal))
        .withColumn("all_size", F.count(F.lit(1)).over(equal))
    )


def exact_dedup(docs: DataFrame, keep: str = "max", most: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. `most`: rows of a text from which on it is hot (default by the rows)."""
    x = content_sort(docs, keep, most, carry=False)
    keep_id = F.when(F.col("hot").isNull(), F.col("all_best")).otherwise(F.col("hot.best"))
    return x.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("hot.size", "all_size").cast("long").alias("group_size"),
        (F.col("norm").isNotNull() & (F.col("place") == 1)).alias("kept"),
        F.coalesce("hot.text_sha256", _digest("norm")).alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame, keep: str = "max", most: int | None = None) -> DataFrame:
    """One whole row of each text, with all columns of docs."""
    x = content_sort(docs, keep, most, carry=True).filter("place = 1")
    return x.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (w ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
