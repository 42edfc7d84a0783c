"""The case library: gates, merge, purge, eviction and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalars as S
from ..functions import text as X

TEXTS = ["title", "summary", "type"]


def entry_gate(title: Column, title_cn: Column, type_: Column, total: Column, rel: Column, lane: Column) -> Column:
    """Whether an item may enter: a work, total high enough, related enough where scored."""
    work = ~(X.is_nonwork(title) | X.is_nonwork(title_cn) | (F.coalesce(type_, F.lit("")) == C.NONWORK_LABEL))
    return (lane == "apps") & work & (total >= C.CASE_MIN_TOTAL) & (rel.isNull() | (rel >= C.CASE_MIN_REL))


def keep_gate(title: Column, type_: Column, score: Column, rel: Column) -> Column:
    """Whether a stored row may stay; a row without a score stays."""
    work = ~(X.is_nonwork(title) | (F.coalesce(type_, F.lit("")) == C.NONWORK_LABEL))
    return work & (score.isNull() | ((score >= C.CASE_MIN_TOTAL) & ~F.coalesce(rel < C.CASE_MIN_REL, F.lit(False))))


def last_write(items: DataFrame) -> DataFrame:
    """One row per url: the last non-empty value of each column in order of pos."""
    w = W.partitionBy("url").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cols = [F.last(F.nullif(F.col(c), F.lit("")), ignorenulls=True).over(w).alias(c) for c in TEXTS]
    cols += [F.last(F.nullif(F.col(c), F.lit(0).cast(items.schema[c].dataType)), ignorenulls=True).over(w).alias(c) for c in ("score", "rel")]
    return items.select("url", *cols, F.row_number().over(W.partitionBy("url").orderBy("pos")).alias("_rn")).filter("_rn = 1").drop("_rn")


def upsert(library: DataFrame, new: DataFrame, day: str) -> DataFrame:
    """Full outer merge on url: only values that are there overwrite; new rows get first_seen."""
    a, b = library.alias("a"), new.alias("b")
    cols = [F.coalesce(F.nullif(F.col(f"b.{c}"), F.lit("")), F.col(f"a.{c}")).alias(c) for c in TEXTS]
    cols += [F.coalesce(F.nullif(F.col(f"b.{c}"), F.lit(0).cast(new.schema[c].dataType)), F.col(f"a.{c}")).alias(c) for c in ("score", "rel")]
    today = F.lit(day).cast("date")
    seen = [F.coalesce("a.first_seen", today).alias("first_seen"), F.when(F.col("b.url").isNotNull(), today).otherwise(F.col("a.last_seen")).alias("last_seen")]
    return a.join(b, F.col("a.url") == F.col("b.url"), "full").select(F.coalesce("b.url", "a.url").alias("url"), *cols, *seen)


def purge(library: DataFrame, cut: DataFrame) -> DataFrame:
    """Library without the urls of `cut` (today's items that fail the entry gate) and without rows that fail the keep gate."""
    return library.join(cut.select("url").distinct(), "url", "left_anti").filter(keep_gate(F.col("title"), F.col("type"), F.col("score"), F.col("rel")))


def coarse_type(c: Column) -> Column:
    """Coarse category of a stored fine one; others stay as they are."""
    table = {fine: C.COARSE_TYPES.get(section, C.DEFAULT_TYPE) for section, fine in C.FINE_TYPES.items()}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c), c)


def evict(library: DataFrame, most: int = C.CASE_MAX) -> DataFrame:
    """The `most` best by raw score (5.5 without one), then last seen: a top-k heap, no full sort."""
    return library.orderBy(F.desc(F.coalesce("score", F.lit(5.5))), F.desc("last_seen"), "url").limit(most)


def show_order(library: DataFrame, as_of_date: str) -> DataFrame:
    """Adds decayed: rows with a score first, best decayed score first."""
    decayed = S.case_decay(F.col("score"), F.coalesce("last_seen", "first_seen"), as_of_date)
    return library.withColumn("decayed", decayed).orderBy(F.desc(F.col("score").isNotNull()), F.desc("decayed"), F.desc("last_seen"), "url")


def rescore_worklist(library: DataFrame, most: int = C.RESCORE_MAX) -> DataFrame:
    return library.filter("score is null").orderBy(F.desc("last_seen"), "url").limit(most)


def types(library: DataFrame) -> DataFrame:
    return library.filter("type <> ''").select("type").distinct()
