"""Run reports as JSON documents whose shape drifts: written in today's shape, read as VARIANT.

A report has generated_at, counts (total, repeat, byLevel), sources (id, ok, via, n, raw, diag)
and degraded (id, lane, reason). Older ones name a source `source_id` and what it took `taken`,
and have no levels or paths. One scan reads them all: fields are looked up by path, and what a
report doesn't have is null. A document that is no JSON gives one row with `bad` set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.responses import parse_diag

LEVELS = ("top", "watch", "normal")


def day_reports(counts: DataFrame, sources: DataFrame, degraded: DataFrame) -> DataFrame:
    """run_date, report: a JSON document per run that has items.

    counts: run_date, total, repeat and a column per level; sources: run_date, id, ok, via, n, raw,
    diag (array); degraded: run_date, id, lane, reason. Null fields are left out. Runs without
    items have no report, so what was written before stays.
    """
    told = lambda df, *names: df.groupBy("run_date").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("x"))
    s = told(sources, "id", "ok", "via", "n", "raw", "diag").withColumnRenamed("x", "sources")
    d = told(degraded, "id", "lane", "reason").withColumnRenamed("x", "degraded")
    x = counts.filter("total > 0").join(s, "run_date", "left").join(d, "run_date", "left")
    none = lambda c: F.coalesce(c, F.array().cast(x.schema[c].dataType)).alias(c)
    head = F.struct("total", "repeat", F.struct(*LEVELS).alias("byLevel")).alias("counts")
    return x.select("run_date", F.to_json(F.struct(F.date_format("run_date", "yyyy-MM-dd HH:mm").alias("generated_at"), head, none("sources"), none("degraded"))).alias("report"))


def write_day_reports(reports: DataFrame, path: str) -> None:
    """A folder per run; a second write of a run replaces it and no other."""
    reports.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").text(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """run_date and the document of each stored report, as VARIANT (null where it is no JSON). A file is one document."""
    return spark.read.text(path, wholetext=True).select("run_date", F.try_parse_json("value").alias("doc"))


def _first(v: Column, kind: str, *paths: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, kind) for p in paths])


def report_counts(reports: DataFrame) -> DataFrame:
    """run_date, bad, generated_at, total, repeat and a column per level."""
    v = F.col("doc")
    return reports.select(
        "run_date", v.isNull().alias("bad"), _first(v, "string", "$.generated_at").alias("generated_at"), _first(v, "long", "$.counts.total", "$.total").alias("total"), _first(v, "long", "$.counts.repeat").alias("repeat"),
        *[_first(v, "long", f"$.counts.byLevel.{x}").alias(x) for x in LEVELS],
    )


def _exploded(rows: DataFrame, column: str, at: str) -> DataFrame:
    """A row per element of the array `column` (VARIANT): place as `at`, element as `item`."""
    each = rows.sparkSession.tvf.variant_explode(F.col(column).outer())
    return rows.lateralJoin(each).withColumnRenamed("pos", at).withColumnRenamed("value", "item").drop("key", column)


def report_sources(reports: DataFrame) -> DataFrame:
    """run_date, source_id, ok, via, n, raw, diag (VARIANT), lane and reason (where degraded) of each source of each report."""
    some = lambda p: F.try_variant_get("doc", p, "variant")
    item = F.col("item")
    n = _first(item, "long", "$.n", "$.taken")
    rows = _exploded(reports.select("run_date", some("$.sources").alias("list")), "list", "ord")
    rows = rows.select("run_date", _first(item, "string", "$.id", "$.source_id").alias("source_id"), F.coalesce(_first(item, "boolean", "$.ok"), n > 0).alias("ok"), _first(item, "string", "$.via").alias("via"), n.alias("n"), _first(item, "long", "$.raw").alias("raw"), F.try_variant_get(item, "$.diag", "variant").alias("diag"))
    bad = _exploded(reports.select("run_date", some("$.degraded").alias("list")), "list", "ord")
    bad = bad.select("run_date", _first(item, "string", "$.id", "$.source_id").alias("source_id"), _first(item, "string", "$.lane").alias("lane"), _first(item, "string", "$.reason").alias("reason"))
    return rows.join(bad, ["run_date", "source_id"], "left")


def report_paths(reports: DataFrame) -> DataFrame:
    """run_date, source_id, path_rank, host, outcome, n, desc_median, code: what each source's paths said, from all diag lines."""
    lines = _exploded(report_sources(reports).select("run_date", "source_id", "diag"), "diag", "path_rank")
    return lines.select("run_date", "source_id", F.col("path_rank").cast("int").alias("path_rank"), parse_diag(F.col("item").cast("string")).alias("d")).select("run_date", "source_id", "path_rank", "d.*")


def attempts(paths: DataFrame) -> DataFrame:
    """report_paths() as operators.report takes attempts: ok, n and desc_median without nulls."""
    return paths.withColumn("ok", F.col("outcome") == "ok").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("desc_median", F.coalesce("desc_median", F.lit(0)))
