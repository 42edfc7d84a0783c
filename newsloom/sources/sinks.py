"""Sinks and what reads them back: the brief by day, run reports as JSON, snapshots of the case library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_brief(brief: DataFrame, path: str) -> None:
    """One partition per day; a second run replaces the days it has and no others."""
    brief.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def latest_brief(spark: SparkSession, path: str) -> DataFrame:
    """The newest day: partitions are pruned by a subquery of one row."""
    archive = spark.read.parquet(path)
    return archive.join(F.broadcast(archive.agg(F.max("run_date").alias("run_date"))), "run_date")


def run_report(funnel: DataFrame, degraded: DataFrame, counts: DataFrame) -> DataFrame:
    """run_date and the report as nested JSON: counts, one entry per source, degraded sources."""
    sources = funnel.groupBy("run_date").agg(F.array_sort(F.collect_list(F.struct("source_id", "raw", "deduped", "in_window", "taken", "stale"))).alias("sources"))
    bad = degraded.groupBy("run_date").agg(F.array_sort(F.collect_list(F.struct("source_id", "reason"))).alias("degraded"))
    x = counts.join(sources, "run_date", "left").join(bad, "run_date", "left")
    none = F.array().cast(bad.schema["degraded"].dataType)
    return x.select("run_date", F.to_json(F.struct(F.struct("total", "stale").alias("counts"), "sources", F.coalesce("degraded", none).alias("degraded"))).alias("report"))


def write_snapshot(library: DataFrame, path: str, version: int) -> str:
    """A new version folder; the table that is read is never overwritten, and a version written twice is the same."""
    at = f"{path}/v={version:012d}"
    library.write.mode("overwrite").parquet(at)
    return at


REPORT = (
    "counts struct<total:long, stale:long>, "
    "sources array<struct<source_id:string, raw:long, deduped:long, in_window:long, taken:long, stale:long>>, "
    "degraded array<struct<source_id:string, reason:string>>"
)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """run_date and the parts of each stored report."""
    rows = spark.read.schema("run_date date, report string").json(path)
    return rows.select("run_date", F.from_json("report", REPORT).alias("r")).select("run_date", "r.*")


def report_sources(reports: DataFrame) -> DataFrame:
    """A row per run and source, with the reason where it was degraded."""
    rows = reports.select("run_date", F.explode("sources").alias("s"), "degraded")
    why = F.get(F.filter("degraded", lambda x: x["source_id"] == F.col("s.source_id")), F.lit(0))["reason"]
    return rows.select("run_date", "s.*", why.alias("reason"))


def write_cases(library: DataFrame, path: str, version: int) -> None:
    """A snapshot, and beside it its size and sorted distinct types."""
    at = write_snapshot(library, path, version)
    stored = library.sparkSession.read.schema(library.schema).parquet(at)
    kinds = F.array_sort(F.collect_set(F.nullif(F.col("type"), F.lit(""))))
    stored.agg(F.count(F.lit(1)).alias("n"), kinds.alias("types")).write.mode("overwrite").json(f"{path}/about/v={version:012d}")


def read_cases(rows: DataFrame) -> DataFrame:
    """A stored library by url: rows without one go, of rows that share a url the last (greatest pos) stays."""
    kept = rows.filter(F.coalesce("url", F.lit("")) != "")
    rest = [c for c in rows.columns if c != "url"]
    return kept.groupBy("url").agg(F.max_by(F.struct(*rest), "pos").alias("r")).select("url", "r.*")
