"""Levels and order from counts, against plain windows over a day."""

import random
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom import config as C
from newsloom.functions import scalars as S
from newsloom.operators import ranks as R
from newsloom.operators import select as L


@pytest.fixture(scope="module")
def days(spark):
    rnd = random.Random(9)
    rows = []
    for day, n, totals in (("2024-01-01", 4000, [8.4]), ("2024-01-02", 700, [5.0, 6.5, 7.0, 8.0, 9.5]), ("2024-01-03", 3, [9.0]), ("2024-01-04", 1, [1.0]), ("2024-01-05", 90, [x / 10 for x in range(101)]), ("2024-01-06", 60, [9.0, 9.1])):
        pos = rnd.sample(range(-50, 200_000), n)
        rows += [(day, p, rnd.choice(totals), rnd.choice([None, -1, 0, 3, 40])) for p in pos]
    rows += [("2024-01-02", 10**14, 9.5, 1), ("2024-01-02", -(10**13), 9.5, 1)]  # far off the others
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "run_date string, pos long, total double, age_h int").cache()


def by_windows(items):
    day = W.partitionBy("run_date")
    n = F.count(F.lit(1)).over(day)
    top = F.least(F.lit(C.TOP_MAX), F.greatest(F.lit(C.TOP_MIN), S.half_even_percent(n, C.TOP_PERCENT)))
    rn = F.row_number().over(day.orderBy(F.desc("total"), "pos"))
    x = items.withColumn("rn", rn).withColumn("top", top).withColumn("watch", S.half_even_percent(n, C.WATCH_PERCENT))
    level = F.when((F.col("rn") <= F.col("top")) & (F.col("total") >= C.FLOOR_TOP), "top").when((F.col("rn") <= F.col("top") + F.col("watch")) & (F.col("total") >= C.FLOOR_WATCH), "watch").otherwise("normal")
    x = x.withColumn("level", level)
    rank = F.when(F.col("level") == "top", 0).when(F.col("level") == "watch", 1).otherwise(2)
    return x.withColumn("ord", F.row_number().over(day.orderBy(rank, F.desc("total"), L.age_sort(F.col("age_h")), "pos")).cast("long"))


def test_levels_and_order_equal_those_of_windows(days):
    columns = ["run_date", "pos", "total", "age_h", "level", "ord"]
    want = sorted(map(tuple, by_windows(days).select(*columns).collect()), key=str)
    got = L.brief_order(L.assign_levels(days)).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {r[4] for r in want} == {"top", "watch", "normal"}


def test_no_day_is_one_task(days):
    """No window is dealt by the day alone."""
    for df in (L.assign_levels(days), L.brief_order(days.withColumn("level", F.lit("top")))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
        assert all("," in keys for keys in windows), windows


def test_empty_days(spark):
    none = spark.createDataFrame([], "run_date string, pos long, total double, age_h int")
    assert L.brief_order(L.assign_levels(none)).count() == 0


def test_kth_smallest(spark):
    rnd = random.Random(3)
    sets = {g: rnd.sample(range(-(10**6), 10**6), 500) for g in "abc"} | {"d": [7], "e": [-(10**15), 5, 10**15]}
    rows = spark.createDataFrame([(g, p) for g, x in sets.items() for p in x], "g string, pos long")
    for k in (1, 2, 250, 500):
        wanted = [(g, k, min(x), max(x)) for g, x in sets.items() if k <= len(x)]
        span = max(h - low + 1 for _, _, low, h in wanted)
        found = R.kth_smallest(rows, spark.createDataFrame(wanted, "g string, k long, low long, high long"), ["g"], R.rounds_for(span))
        assert {r.g: r.pos for r in found.collect()} == {g: sorted(sets[g])[k - 1] for g, *_ in wanted}
