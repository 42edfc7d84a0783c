"""Selection: dedup inside a source, time window with a floor, fold across sources, levels, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalars as S
from ..functions import text as X
from ..session import handover
from . import ranks as R


def in_source_dedup(items: DataFrame) -> DataFrame:
    """First row per normalised title of a source and run; rows without a key go. Adds `key`."""
    keyed = items.withColumn("key", X.norm_title(F.col("title"))).filter("key <> ''")
    w = W.partitionBy("run_date", "source_id", "key").orderBy("pos")
    return keyed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def lane_hours(lane: Column) -> Column:
    out = F.lit(C.DEFAULT_HOURS)
    for name, hours in C.LANE_HOURS.items():
        out = F.when(lane == name, hours).otherwise(out)
    return out


def in_window(as_of: str = C.AS_OF) -> Column:
    """Undated, or not older than the lane's hours."""
    limit = S.as_of_ts(as_of) - F.make_interval(hours=lane_hours(F.col("lane")))
    return F.col("dt").isNull() | (F.col("dt") >= limit)


def taken(inside: str, group: list[str], take: int = C.TAKE, min_take: int = C.MIN_TAKE) -> Column:
    """Whether a row is among the newest `take` inside of its group, or fills it up to `min_take` from outside."""
    place = F.row_number().over(W.partitionBy(*group, inside).orderBy(F.desc_nulls_last("dt"), "pos"))
    n = F.least(F.count_if(inside).over(W.partitionBy(*group)), F.lit(take))
    return F.when(F.col(inside), place <= take).otherwise(place <= F.lit(min_take) - F.least(n, F.lit(min_take)))


def window_with_floor(items: DataFrame, as_of: str = C.AS_OF, take: int = C.TAKE, min_take: int = C.MIN_TAKE) -> DataFrame:
    """Newest `take` in-window rows of a source; filled up to `min_take` with the newest older ones, marked stale. Adds age_h, stale."""
    marked = items.withColumn("_in", in_window(as_of)).withColumn("age_h", S.age_hours(F.col("dt"), as_of))
    kept = marked.withColumn("_taken", taken("_in", ["run_date", "source_id"], take, min_take)).filter("_taken")
    return kept.withColumn("stale", ~F.col("_in")).drop("_in", "_taken")


def window_by_settings(items: DataFrame, sources: DataFrame, as_of: str = C.AS_OF) -> DataFrame:
    """window_with_floor under each source's own limits: take, min_take, max_age_h (its lane's, if null or 0) and sort_desc (false: feed order).

    sources: source_id and these columns, nulls for the usual values; a row per source. Sources
    that take nothing give nothing. The largest limit of all sources is a constant, so Spark cuts
    each source to that many rows before the shuffle; a source's own limit then cuts the rest.
    """
    limits = sources.select("source_id", F.coalesce("take", F.lit(C.TAKE)).alias("_take"), F.coalesce("min_take", F.lit(C.MIN_TAKE)).alias("_least"), F.nullif("max_age_h", F.lit(0)).alias("_hours"), F.coalesce("sort_desc", F.lit(True)).alias("_newest"))
    most = limits.agg(F.max(F.greatest("_take", "_least"))).first()[0] or 0
    x = items.join(limits, "source_id", "left").fillna({"_take": C.TAKE, "_least": C.MIN_TAKE, "_newest": True}).filter("_take > 0")
    since = S.as_of_ts(as_of) - F.make_interval(hours=F.coalesce("_hours", lane_hours(F.col("lane"))))
    x = x.withColumn("_in", F.col("dt").isNull() | (F.col("dt") >= since)).withColumn("age_h", S.age_hours(F.col("dt"), as_of))
    place = F.row_number().over(W.partitionBy("run_date", "source_id", "_in").orderBy(F.desc_nulls_last(F.when(F.col("_newest"), F.col("dt"))), "pos"))
    cut = x.withColumn("_place", place).filter(F.col("_place") <= max(most, C.TAKE, C.MIN_TAKE))
    n = F.least(F.count_if("_in").over(W.partitionBy("run_date", "source_id")), F.col("_take"))
    kept = cut.withColumn("_n", n).filter(F.when(F.col("_in"), F.col("_place") <= F.col("_take")).otherwise(F.col("_place") <= F.col("_least") - F.least("_n", "_least")))
    return kept.withColumn("stale", ~F.col("_in")).drop("_in", "_take", "_least", "_hours", "_newest", "_place", "_n")


def lane_rank(lane: Column) -> Column:
    out = F.lit(99)
    for i, name in enumerate(C.LANES):
        out = F.when(lane == name, i).otherwise(out)
    return out


def age_sort(age: Column) -> Column:
    return F.when(age.isNull() | (age < 0), 9999).otherwise(age)


def cross_source_fold(items: DataFrame) -> DataFrame:
    """One row per title key of a run: best lane, then youngest, then first; the others' blocks in also_in.

    The kept row is an aggregate, so copies of a common title are combined before the shuffle.
    """
    order = F.struct(lane_rank(F.col("lane")).alias("r"), age_sort(F.col("age_h")).alias("a"), F.col("pos").alias("p"))
    rest = [c for c in items.columns if c not in ("run_date", "key")]
    best = items.groupBy("run_date", "key").agg(
        F.min_by(F.struct(*rest), order).alias("m"),
        F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("block").alias("b")))).alias("_all"),
    )
    also = F.transform(F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0))), lambda x: x["b"])
    return best.select("run_date", "key", "m.*", also.alias("also_in"))


def score_items(items: DataFrame) -> DataFrame:
    """Adds total and kw_boost; items without a score get the fallback total."""
    base = F.coalesce(S.weighted_total(F.col("score"), F.col("lane")), S.fallback_total(F.col("lane"), F.col("age_h"), F.size("also_in") > 0))
    total, raised = S.boosted(F.col("_base"), X.keyword_hit(F.col("title"), F.col("title_cn")))
    return items.withColumn("_base", base).withColumn("total", total).withColumn("kw_boost", raised).withColumn("fallback", F.col("score").isNull()).drop("_base")


def assign_levels(items: DataFrame) -> DataFrame:
    """Adds level: top and watch under the day's quotas, else normal. `items` is read a few times: give it a table.

    Rows stay where they are. Counts per day and total tell at which totals the quotas end; how
    far they reach among the rows of these totals is a pos, found by counting. A row per day
    then goes to all tasks.
    """
    sums = handover(items.groupBy("run_date", F.col("total").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high")), "levels")
    starts = R.class_starts(sums.select("run_date", (-F.col("t")).alias("key"), "n"), "run_date", "key").select("run_date", (-F.col("key")).alias("t"), "n", "before", F.col("total").alias("of"))
    n = F.col("of")
    top = F.least(F.lit(C.TOP_MAX), F.greatest(F.lit(C.TOP_MIN), S.half_even_percent(n, C.TOP_PERCENT)))
    watch = top + F.greatest(F.lit(0), S.half_even_percent(n, C.WATCH_PERCENT))
    quotas = F.array(F.struct(F.lit("top").alias("cut"), top.cast("long").alias("upto")), F.struct(F.lit("watch").alias("cut"), watch.cast("long").alias("upto")))
    cuts = starts.withColumn("q", F.explode(quotas)).select("run_date", "t", "n", "before", "q.cut", F.least("of", F.col("q.upto")).alias("upto"))
    cuts = cuts.filter((F.col("before") < F.col("upto")) & (F.col("upto") <= F.col("before") + F.col("n"))).join(sums.drop("n"), ["run_date", "t"])
    wanted = cuts.select("run_date", F.col("t").alias("total"), "cut", (F.col("upto") - F.col("before")).alias("k"), "low", "high")
    span = sums.agg(F.max(F.col("high") - F.col("low") + 1)).first()[0] or 1
    last = R.kth_smallest(items.select("run_date", "total", "pos").withColumn("cut", F.explode(F.array(F.lit("top"), F.lit("watch")))), wanted, ["run_date", "total", "cut"], R.rounds_for(span))
    ends = last.groupBy("run_date").agg(*[F.max(F.when(F.col("cut") == c, F.struct("total", "pos"))).alias(f"_{c}") for c in ("top", "watch")])
    within = lambda c: (F.col("total") > F.col(f"_{c}.total")) | ((F.col("total") == F.col(f"_{c}.total")) & (F.col("pos") <= F.col(f"_{c}.pos")))
    level = F.when(within("top") & (F.col("total") >= C.FLOOR_TOP), "top").when(within("watch") & (F.col("total") >= C.FLOOR_WATCH), "watch").otherwise("normal")
    return items.join(F.broadcast(ends), "run_date").withColumn("level", level).drop("_top", "_watch")


def brief_order(items: DataFrame, compat_age_zero: bool = False) -> DataFrame:
    """Adds ord: place in the day's brief. `items` is read three times: give it a table."""
    rank = F.when(F.col("level") == "top", 0).when(F.col("level") == "watch", 1).otherwise(2)
    age = age_sort(F.col("age_h"))
    if compat_age_zero:
        age = F.when(F.col("age_h") == 0, 9999).otherwise(age)
    return R.places(items, "run_date", F.struct(rank.alias("r"), (-F.col("total")).alias("t")), age).withColumnRenamed("place", "ord")


def brief(items: DataFrame, take: int = C.TAKE) -> DataFrame:
    """The whole chain from items to an ordered brief."""
    scored = handover(score_items(cross_source_fold(window_with_floor(in_source_dedup(items), take=take))), "scored")
    return brief_order(assign_levels(scored))
