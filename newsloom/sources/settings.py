"""Sources and lanes as tables, from configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = (
    "lanes array<struct<id:string, name:string>>, "
    "sources array<struct<id:string, lane:string, block:string, enabled:boolean, mode:string, route:string, urls:array<string>, kind:string, take:int, min_take:int, desc_min:int, max_age_h:int, sort_desc:boolean>>"
)


def read_settings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lane, lane_rank) and one row per source with its lane's rank (99: unknown lane), its paths' kind, gates and limits. A file is one JSON object."""
    config = spark.read.schema(CONFIG).option("multiLine", True).json(path)
    lanes = config.select(F.posexplode("lanes").alias("lane_rank", "l")).groupBy(F.col("l.id").alias("lane")).agg(F.min("lane_rank").alias("lane_rank"))
    sources = config.select(F.explode("sources").alias("s")).select("s.*").withColumnRenamed("id", "source_id")
    return lanes, sources.join(F.broadcast(lanes), "lane", "left").withColumn("lane_rank", F.coalesce("lane_rank", F.lit(99)))  # a few lanes


def enabled_sources(sources: DataFrame, lane: str | None = None, ids: list[str] | None = None) -> DataFrame:
    """Enabled sources, of one lane or of some ids if asked for; those with take = 0 give no items and go."""
    out = sources.filter(F.coalesce("enabled", F.lit(False)) & F.coalesce(F.col("take") != 0, F.lit(True)))
    out = out.filter(F.col("lane") == lane) if lane else out
    return out.filter(F.col("source_id").isin(ids)) if ids else out
