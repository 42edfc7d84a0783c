"""Counts, work lists and source health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as X
from . import ranks as R
from . import select as L


def dim_lane(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(C.LANES)), "lane_rank int, lane string")


def summary_or_desc(summary: Column, desc: Column) -> Column:
    return F.coalesce(F.nullif(summary, F.lit("")), F.substring(desc, 1, 200))


def publish(brief: DataFrame, as_of: str = C.AS_OF) -> DataFrame:
    """The published columns of a brief (with summary, desc, desc_zh, dt): texts cut to their lengths, nothing internal."""
    return brief.select(
        "run_date",
        "pos",
        X.item_id(F.col("title")).alias("id"),
        L.S.pub_display(F.col("dt"), as_of).alias("pub_time"),
        L.S.pub_iso(F.col("dt")).alias("pub_ts"),
        F.substring("desc", 1, 2000).alias("descr"),
        F.substring(summary_or_desc(F.col("summary"), F.col("desc")), 1, 300).alias("summary"),
        F.substring("desc_zh", 1, 2400).alias("desc_zh"),
    )


def source_funnel(items: DataFrame) -> DataFrame:
    """Raw, deduped, in window, taken and stale rows per source and run.

    Items are read once: rows are flagged by the rules of in_source_dedup and
    window_with_floor in place of being dropped, and counted by one aggregate.
    """
    source = ["run_date", "source_id"]
    rows = items.select(*source, "pos", "dt", X.norm_title(F.col("title")).alias("key"), L.in_window().alias("inside"))
    first = F.row_number().over(W.partitionBy(*source, "key").orderBy("pos")) == 1
    rows = rows.withColumn("one", F.coalesce(F.col("key") != "", F.lit(False)) & first)
    rows = rows.withColumn("taken", F.col("one") & L.taken("inside", [*source, "one"]))
    return rows.groupBy(*source).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("one").alias("deduped"),
        F.count_if(F.col("one") & F.col("inside")).alias("in_window"),
        F.count_if("taken").alias("taken"),
        F.count_if(F.col("taken") & ~F.col("inside")).alias("stale"),
    )


def lane_counts(spark: SparkSession, brief: DataFrame) -> DataFrame:
    """Items per day and lane, zeros included."""
    n = brief.groupBy("run_date", "lane").agg(F.count(F.lit(1)).alias("n"))
    days = brief.select("run_date").distinct().withColumn("lane", F.explode(F.array(*[F.lit(x) for x in C.LANES])))
    return days.join(n, ["run_date", "lane"], "left").fillna(0, ["n"])


def level_counts(brief: DataFrame) -> DataFrame:
    return brief.groupBy("run_date").agg(*[F.count_if(F.col("level") == x).alias(x) for x in ("top", "watch", "normal")])


def brief_counts(brief: DataFrame) -> DataFrame:
    """Total, per lane and per level of each day in one pass; brief has is_repeat."""
    sets = [["run_date"], ["run_date", "lane"], ["run_date", "level"]]
    return brief.groupingSets([[F.col(c) for c in s] for s in sets], "run_date", "lane", "level").agg(F.count(F.lit(1)).alias("n"), F.count_if("stale").alias("stale"), F.count_if("is_repeat").alias("repeat"))


def tier_inversion(brief: DataFrame) -> DataFrame:
    top, watch = F.min(F.when(F.col("level") == "top", F.col("total"))), F.max(F.when(F.col("level") == "watch", F.col("total")))
    return brief.groupBy("run_date").agg(top.alias("top_min"), watch.alias("watch_max")).withColumn("inverted", F.coalesce(F.col("top_min") < F.col("watch_max"), F.lit(False)))


def _batched(items: DataFrame) -> DataFrame:
    return items.withColumn("translate", ~X.has_cjk(F.col("title"))).withColumn("want_type", F.col("lane") == "apps")


def batch_plan_counts(items: DataFrame, size: int = 25) -> DataFrame:
    return _batched(items).groupBy("run_date", "translate", "want_type").agg(F.count(F.lit(1)).alias("n")).withColumn("batches", F.ceil(F.col("n") / size))


def batch_assign(items: DataFrame, size: int = 25) -> DataFrame:
    """Batch and place in it of each row, in order of pos, per day and kind of order. A day's rows are placed by counts, not by one sort; `items` is read three times."""
    kinds = _batched(items).select(F.struct("run_date", "translate", "want_type").alias("g"), "pos")
    rn = F.col("place") - 1
    return R.places(kinds, "g", F.lit(0), F.lit(0)).select("g.*", "pos", F.floor(rn / size).alias("batch"), (rn % size).cast("int").alias("i")).select("run_date", "pos", "translate", "want_type", "batch", "i")


def worklist(rows: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of each day in order of ord. Adds rn."""
    return rows.withColumn("rn", F.row_number().over(W.partitionBy("run_date").orderBy("ord"))).filter(F.col("rn") <= most)


def best_path(attempts: DataFrame) -> DataFrame:
    """Per source: ok and all paths, the path of most text (first on ties)."""
    order = F.struct("desc_median", "n", (-F.col("path_rank")).alias("r"))
    return attempts.groupBy("source_id").agg(F.count_if("ok").alias("ok_paths"), F.count(F.lit(1)).alias("paths"), F.max_by("host", F.when(F.col("ok"), order)).alias("best_host"))


def freshness(attempts: DataFrame) -> DataFrame:
    """Age in hours of the freshest item; empty, zombie over 240 h, slow over 72 h."""
    fresh = attempts.groupBy("source_id").agg(F.sum("n").alias("n"), F.min("age_h").alias("fresh_h"))
    return fresh.withColumn("flag", F.when(F.col("n") == 0, "empty").when(F.col("fresh_h") > 240, "zombie").when(F.col("fresh_h") > 72, "slow").otherwise("ok"))


def pick_path(attempts: DataFrame, desc_min: int) -> DataFrame:
    """source_id, host: the first path (by rank) that parsed and has text enough (desc_min 0: no gate).

    attempts: source_id, path_rank, host, ok, n, desc_median, special. A path without
    items fails, but for special parsers, which may find nothing.
    """
    passes = F.col("ok") & ((F.col("n") > 0) | F.col("special")) & (F.lit(desc_min == 0) | (F.col("desc_median") >= desc_min))
    return attempts.filter(passes).groupBy("source_id").agg(F.min_by("host", "path_rank").alias("host"))


def degraded(attempts: DataFrame, desc_min: int) -> DataFrame:
    """source_id, reason of sources with no passing path: what each path said, in order, 200 characters at most."""
    told = F.array_sort(F.collect_list(F.struct("path_rank", "diag")))
    reason = F.substring(F.array_join(F.transform(told, lambda x: x["diag"]), "; "), 1, 200)
    every = attempts.groupBy("source_id").agg(reason.alias("reason"))
    return every.join(pick_path(attempts, desc_min), "source_id", "left_anti")


def lane_coverage(sources: DataFrame) -> DataFrame:
    """Enabled and all sources per lane, lanes without sources included."""
    lanes = dim_lane(sources.sparkSession)
    return lanes.join(sources, "lane", "left").groupBy("lane").agg(F.count_if("enabled").alias("enabled"), F.count("source_id").alias("total"))


def desc_median(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Median length of non-empty texts per key, whole (0 if none): from counts per length, not from all lengths."""
    n = F.char_length(text)
    lengths = rows.groupBy(*keys, n.alias("n")).agg(F.count(F.lit(1)).alias("c"))
    return lengths.groupBy(*keys).agg(F.coalesce(F.floor(F.percentile(F.when(F.col("n") > 0, F.col("n")), 0.5, F.col("c"))), F.lit(0)).alias("desc_median"))
