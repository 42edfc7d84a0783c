"""Curated rows beside the parsed ones, and bodies fetched later."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.residue import body_header_strip


def union_sources(*parts: DataFrame) -> DataFrame:
    """Rows of all parsers, then the curated ones; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def restore(items: DataFrame) -> DataFrame:
    """Curated rows get their own summary and reason back, where they have one, and their summary as text.

    items: is_curated, summary, reason, desc, curated_summary, curated_reason.
    """
    own = lambda c: F.nullif(F.col(c), F.lit(""))
    back = lambda c: F.when(F.col("is_curated") & own(f"curated_{c}").isNotNull(), F.substring(f"curated_{c}", 1, 300)).otherwise(F.col(c))
    desc = F.when(F.col("is_curated"), F.coalesce(own("curated_summary"), "desc", F.lit(""))).otherwise(F.col("desc"))
    return items.withColumn("summary", back("summary")).withColumn("reason", back("reason")).withColumn("desc", desc)


def fill_bodies(items: DataFrame, bodies: DataFrame) -> DataFrame:
    """desc from a landed body (url, body) where that is longer; adds desc_from ('reader' or null). The longest body of a url counts."""
    plain = bodies.filter(F.col("url") != "").select("url", body_header_strip(F.col("body")).alias("body"))
    best = plain.groupBy("url").agg(F.max_by("body", F.struct(F.char_length("body"), "body")).alias("body"))
    longer = F.char_length("body") > F.char_length(F.coalesce("desc", F.lit("")))
    x = items.join(best, "url", "left").withColumn("desc_from", F.when(longer, "reader"))
    return x.withColumn("desc", F.when(longer, F.col("body")).otherwise(F.col("desc"))).drop("body")
