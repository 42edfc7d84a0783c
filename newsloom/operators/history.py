"""Across days: repeats, pinned titles, the archive before a day, retention."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X


def title_keys(items: DataFrame) -> DataFrame:
    """run_date, pos, key: every non-empty normalised title form."""
    forms = F.array_distinct(F.filter(F.array(*[X.norm_title(F.col(c)) for c in ("title", "title_cn", "title_en")]), lambda k: k != ""))
    return items.select("run_date", "pos", F.explode(forms).alias("key"))


def previous_dates(dates: DataFrame) -> DataFrame:
    """run_date, prev_date over the distinct days (few rows: one per day)."""
    days = dates.select("run_date").distinct().withColumn("_g", F.lit(0))
    return days.withColumn("prev_date", F.lag("run_date").over(W.partitionBy("_g").orderBy("run_date"))).drop("_g")


def cross_day_repeat(items: DataFrame) -> DataFrame:
    """run_date, pos, is_repeat: a title form occurs in the archive before. A flag, nothing is dropped."""
    keys = title_keys(items)
    prev = keys.select(F.col("run_date").alias("prev_date"), "key").distinct()
    hits = keys.join(F.broadcast(previous_dates(items)), "run_date").join(prev, ["prev_date", "key"], "left_semi").select("run_date", "pos").distinct()
    return items.select("run_date", "pos").join(hits.withColumn("hit", F.lit(True)), ["run_date", "pos"], "left").select("run_date", "pos", F.coalesce("hit", F.lit(False)).alias("is_repeat"))


def title_pins(items: DataFrame, before: str) -> DataFrame:
    """id, pinned: newest non-empty translated title of an id in the archives before a day."""
    old = items.filter((F.col("run_date") < F.lit(before).cast("date")) & (F.coalesce("title_cn", F.lit("")) != ""))
    return old.groupBy(X.item_id(F.col("title")).alias("id")).agg(F.max_by("title_cn", F.struct("run_date", "pos")).alias("pinned"))


def pinned(items: DataFrame, pins: DataFrame) -> DataFrame:
    """Items with title_cn replaced by its pin where both exist and differ. Adds id, was_pinned."""
    joined = items.withColumn("id", X.item_id(F.col("title"))).join(pins.select("id", "pinned"), "id", "left")
    differs = F.col("pinned").isNotNull() & (F.coalesce("title_cn", F.lit("")) != "") & (F.col("title_cn") != F.col("pinned"))
    return joined.withColumn("was_pinned", differs).withColumn("title_cn", F.when(differs, F.col("pinned")).otherwise(F.col("title_cn"))).drop("pinned")


def pin_titles(items: DataFrame, before: str) -> DataFrame:
    """Items of the day `before`, pinned to their wording in the archives before it."""
    return pinned(items.filter(F.col("run_date") == F.lit(before).cast("date")), title_pins(items, before))


def newest_pins(*pins: DataFrame) -> DataFrame:
    """id, pinned, seen, pos: of each id the wording that was seen last."""
    rows = pins[0]
    for more in pins[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("id").agg(F.max_by(F.struct("pinned", "seen", "pos"), F.struct("seen", "pos")).alias("p")).select("id", "p.*")


def archive_pins(archive: DataFrame) -> DataFrame:
    """The pins that archived rows (run_date, pos, title, title_cn) speak for."""
    worded = archive.filter(F.coalesce("title_cn", F.lit("")) != "")
    return newest_pins(worded.select(X.item_id(F.col("title")).alias("id"), F.col("title_cn").alias("pinned"), F.col("run_date").alias("seen"), "pos"))


def roll_pins(archive: DataFrame, store: str, day: str, keep_days: int = 30) -> DataFrame:
    """Pins as of `day` (dates before it count): the newest stored version before, merged with the archive since then.

    A daily run reads yesterday's version and one partition of the archive; after a gap, those
    of the gap; at first, all that is kept. Pins not seen for `keep_days` go, as their archives do.
    A version that is written twice is the same, and versions are never read while being written.
    `archive` is partitioned by run_date.
    """
    spark, to = archive.sparkSession, F.lit(day).cast("date")
    try:
        before = spark.read.parquet(store).filter(F.col("v") < to)
        last = before.agg(F.max("v")).first()[0]
    except AnalysisException:  # nothing stored yet
        last = None
    since = F.date_sub(to, keep_days) if last is None else F.greatest(F.date_sub(to, keep_days), F.lit(last).cast("date"))
    pins = archive_pins(archive.filter((F.col("run_date") >= since) & (F.col("run_date") < to)))
    if last is not None:
        pins = newest_pins(before.filter(F.col("v") == F.lit(last)).drop("v"), pins)
    pins.filter(F.col("seen") >= F.date_sub(to, keep_days)).write.mode("overwrite").parquet(f"{store}/v={day}")
    return spark.read.parquet(f"{store}/v={day}")


def first_wordings(items: DataFrame) -> DataFrame:
    """Backfill of pins: the first translated title so far of each id, per row."""
    w = W.partitionBy("id").orderBy("run_date", "pos").rowsBetween(W.unboundedPreceding, 0)
    return items.withColumn("id", X.item_id(F.col("title"))).withColumn("pinned", F.first(F.nullif(F.col("title_cn"), F.lit("")), ignorenulls=True).over(w))


def retention(files: DataFrame, as_of_date: str, keep_days: int = 30) -> DataFrame:
    """name, removed, undated of archive files (name, mtime): a date in the name decides, else mtime; the last kept day is kept."""
    y, m, d = (F.regexp_extract("name", r"^(20\d{2})-?(\d{2})-?(\d{2})", i) for i in (1, 2, 3))
    dated = F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")
    day = F.coalesce(dated, F.col("mtime").cast("date"))
    return files.select("name", (day < F.date_sub(F.lit(as_of_date).cast("date"), keep_days)).alias("removed"), dated.isNull().alias("undated"))
