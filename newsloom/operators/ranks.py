"""Places of rows within large groups, from counts instead of one sort per group.

A group (a day) may hold most of the rows, so no window is dealt by the group alone. What
orders its rows comes first as a few classes (a score of some hundred values); counts per
class, in order, say where each class begins. Inside a class rows are ordered by `pos`,
whole numbers that tell a group's rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets that an interval of pos is cut into, per round.
BUCKETS = 1024


def class_starts(counts: DataFrame, group: str, key: str) -> DataFrame:
    """group, key, n, before: rows of the classes before each one, and of the group (`total`). counts: group, key, n.

    A group's classes lie in one array: a few hundred at most.
    """
    packed = counts.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(key, "n"))).alias("c"))
    upto = F.transform("c", lambda x: F.struct(x[key].alias(key), x["n"].alias("n"), F.aggregate(F.filter("c", lambda y: y[key] < x[key]), F.lit(0).cast("long"), lambda s, y: s + y["n"]).alias("before")))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda s, y: s + y["n"])
    return packed.select(group, total.alias("total"), F.explode(upto).alias("u")).select(group, "total", "u.*")


def bucket(pos: Column, low: Column, high: Column, buckets: int = BUCKETS) -> Column:
    """Which of `buckets` equal parts of low .. high holds pos."""
    width = F.ceil((high - low + 1) / F.lit(buckets)).cast("long")
    return F.floor((pos - low) / width).cast("long")


def kth_smallest(rows: DataFrame, wanted: DataFrame, keys: list[str], rounds: int) -> DataFrame:
    """keys, pos: the k-th smallest pos of each group of `wanted` (keys, k, low, high: all its pos lie between), by counting.

    Each round reads the rows once and cuts every interval into BUCKETS parts, of which the one
    with the k-th stays. `wanted` has a row per group, a few thousand at most, and is broadcast.
    """
    for _ in range(rounds):
        inside = rows.join(F.broadcast(wanted), keys).filter(F.col("pos").between(F.col("low"), F.col("high")))
        counts = inside.groupBy(*keys, "k", "low", "high", bucket(F.col("pos"), F.col("low"), F.col("high")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        packed = counts.groupBy(*keys, "k", "low", "high").agg(F.array_sort(F.collect_list(F.struct("b", "n"))).alias("c"))
        # the first bucket whose sum reaches k, and how many lie before it
        step = lambda s, x: F.when(s["found"] >= 0, s).otherwise(F.struct((s["sum"] + F.when(s["sum"] + x["n"] < F.col("k"), x["n"]).otherwise(0)).alias("sum"), F.when(s["sum"] + x["n"] >= F.col("k"), x["b"]).otherwise(F.lit(-1).cast("long")).alias("found")))
        at = F.aggregate("c", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("found")), step)
        width = F.ceil((F.col("high") - F.col("low") + 1) / F.lit(BUCKETS)).cast("long")
        found = packed.select(*keys, "k", "low", "high", width.alias("width"), at.alias("at")).filter("at.found >= 0")
        wanted = found.select(*keys, (F.col("k") - F.col("at.sum")).alias("k"), (F.col("low") + F.col("at.found") * F.col("width")).alias("low"), F.least("high", F.col("low") + (F.col("at.found") + 1) * F.col("width") - 1).alias("high"))
    return wanted.select(*keys, F.col("low").alias("pos"))


def rounds_for(span: int) -> int:
    """Rounds until an interval of `span` numbers is one number."""
    rounds = 0
    while span > 1:
        span, rounds = -(-span // BUCKETS), rounds + 1
    return max(1, rounds)


def places(rows: DataFrame, group: str, first: Column, second: Column, parts: int = 64) -> DataFrame:
    """Adds place (from 1) in the order of first (a class of a few hundred values), second, pos within the group.

    The rows are read twice and dealt once, by group, both orders and a part of pos; the rest is done on counts.
    """
    ends = rows.groupBy(group).agg(F.min("pos").alias("_low"), F.max("pos").alias("_high"))  # a row per group
    keyed = rows.join(F.broadcast(ends), group).withColumn("_1", first).withColumn("_2", second).withColumn("_3", bucket(F.col("pos"), F.col("_low"), F.col("_high"), parts)).drop("_low", "_high")
    keys = [group, "_1", "_2", "_3"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    inner = counts.withColumn("_inner", F.sum("n").over(W.partitionBy(group, "_1").orderBy("_2", "_3").rowsBetween(W.unboundedPreceding, -1)))
    outer = class_starts(counts.groupBy(group, "_1").agg(F.sum("n").alias("n")), group, "_1").select(group, "_1", "before")
    starts = inner.join(outer, [group, "_1"]).select(*keys, (F.coalesce("_inner", F.lit(0)) + F.col("before")).alias("_start"))
    local = keyed.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy("pos")))
    return local.join(starts, keys).withColumn("place", (F.col("_start") + F.col("_rn")).cast("long")).drop("_1", "_2", "_3", "_rn", "_start")
