"""The item table over the driver's tables.

An item is {run_date, source_id, lane, block, pos, title, title_cn, title_en, desc,
url, dt, score}; dt and score may be null. Every third day of thirty has stories:
titles that several sources carry, on several days, with changing translations. Every
fifth item is a short note with fixed words, dated close to others of its host. A
third of the rows falls on the last day. `ITEMS_SQL` states the same view for the SQL
oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import as_of_ts
from ..functions.text import upper_by_letter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str, desc: bool = True, docs: DataFrame | None = None) -> DataFrame:
    """`docs` may be a stream of documents; by default the table.

    Columns are made before the labels are joined, so without `desc` no text is shuffled.
    """
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    scored = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("scored", F.lit(True))
    lanes = F.array(*[F.lit(x) for x in C.LANES])
    no = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    d = F.col("doc_id")
    first = F.substring(F.split("text", "\n").getItem(0), 1, 150)
    text = lambda c: c.cast("string")
    story, note = F.floor(d / 30) % 3 == 2, d % 5 == 3
    told = F.concat(F.lit("Shared release story "), text(F.floor(d / 270)))
    noted = F.concat_ws(" ", F.lit("weekly notes on"), *[F.concat(F.lit(k), text(d * n)) for k, n in (("a", 1), ("b", 7), ("c", 11))])
    page = F.when(d % 20 < 10, text(F.floor(d / 2))).otherwise(F.concat(F.lit("own"), text(d)))
    hours = F.when(note, (d % 40) * 20 + F.floor(d / 40) % 5).otherwise(d * 37 % 900)
    columns = [
        F.date_sub(F.lit(C.AS_OF_DATE).cast("date"), F.when(d % 3 == 0, 0).otherwise(d % 30).cast("int")).alias("run_date"),
        F.col("source").alias("source_id"),
        F.get(lanes, no % len(C.LANES)).alias("lane"),
        F.upper("source").alias("block"),
        d.alias("pos"),
        F.when(story, told).when(note, noted).when(F.col("lang") == "de", F.concat(F.lit("新模型上架："), first)).otherwise(first).alias("title"),
        F.when(story, F.concat(F.lit("发布说明 "), text(d % 7))).when(F.col("lang") == "fr", F.concat(F.lit("中文 "), first)).alias("title_cn"),
        F.when(F.col("lang") == "es", upper_by_letter(first)).alias("title_en"),
        F.concat(F.lit("https://www.site"), (F.floor(d / 2) % 20).cast("string"), F.lit(".example.com/p/"), page, F.lit("?ref="), d.cast("string")).alias("url"),
        F.when(d % 53 != 0, as_of_ts(C.AS_OF) - F.make_interval(hours=hours.cast("int"))).alias("dt"),
    ]
    if desc:
        columns.append(F.col("text").alias("desc"))
    rows = docs.select(*columns)
    names = [c for c in rows.columns if c != "desc"]
    p = F.col("pos")
    score = F.when(
        F.col("scored"),
        F.struct((p * 7 % 11).cast("int").alias("rel"), (p * 5 % 11).cast("int").alias("info"), (p * 3 % 11).cast("int").alias("fresh")),
    )
    return rows.join(scored, rows["pos"] == scored["doc_id"], "left").select(*names, score.alias("score"), *(["desc"] if desc else []))


_LANE_LIST = "[" + ", ".join(f"'{x}'" for x in C.LANES) + "]"
_FIRST = "substr(string_split(text, chr(10))[1], 1, 150)"
_STORY, _NOTE = "(d.doc_id // 30) % 3 = 2", "d.doc_id % 5 = 3"
_NOTED = "'weekly notes on a' || d.doc_id || ' b' || d.doc_id * 7 || ' c' || d.doc_id * 11"
ITEMS_SQL = f"""
items AS (
  SELECT CAST(CAST(DATE '{C.AS_OF_DATE}' - CASE WHEN d.doc_id % 3 = 0 THEN 0 ELSE CAST(d.doc_id % 30 AS INT) END AS DATE) AS VARCHAR) AS run_date, d.source AS source_id,
         {_LANE_LIST}[CAST(regexp_extract(d.source, '(\\d+)', 1) AS INT) % {len(C.LANES)} + 1] AS lane, upper(d.source) AS block, d.doc_id AS pos,
         CASE WHEN {_STORY} THEN 'Shared release story ' || (d.doc_id // 270) WHEN {_NOTE} THEN {_NOTED}
              WHEN lang = 'de' THEN '新模型上架：' || {_FIRST} ELSE {_FIRST} END AS title,
         CASE WHEN {_STORY} THEN '发布说明 ' || (d.doc_id % 7) WHEN lang = 'fr' THEN '中文 ' || {_FIRST} END AS title_cn,
         CASE WHEN lang = 'es' THEN upper({_FIRST}) END AS title_en,
         text AS descr,
         'https://www.site' || (d.doc_id // 2 % 20) || '.example.com/p/' || CASE WHEN d.doc_id % 20 < 10 THEN CAST(d.doc_id // 2 AS VARCHAR) ELSE 'own' || d.doc_id END || '?ref=' || d.doc_id AS url,
         CASE WHEN d.doc_id % 53 <> 0 THEN TIMESTAMP '{C.AS_OF}'
              - to_hours(CAST(CASE WHEN {_NOTE} THEN (d.doc_id % 40) * 20 + (d.doc_id // 40) % 5 ELSE d.doc_id * 37 % 900 END AS INT)) END AS dt,
         l.doc_id IS NOT NULL AS scored,
         CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id * 7 % 11 END AS rel,
         CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id * 5 % 11 END AS info,
         CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id * 3 % 11 END AS fresh
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id
)"""
