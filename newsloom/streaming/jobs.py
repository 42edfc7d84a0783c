"""Structured Streaming jobs over landed files.

Ingest keeps every row. Dedup and pins drop rows that are older than their watermark
(30 days behind the newest row), health those an hour behind: their state is gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as X
from ..operators import cases as K
from ..sources import feeds
from ..sources.sinks import write_snapshot

HORIZON = "30 days"


def ingest(bodies: DataFrame, parser, **settings) -> DataFrame:
    """Landed bodies to cleaned items with their id: stateless. `parser` is one of sources.feeds.PARSERS without a limit per body."""
    return parser(bodies, **settings).withColumn("id", X.item_id(F.col("title")))


def ingest_mixed(bodies: DataFrame) -> DataFrame:
    """Landed bodies of several kinds (`kind`: json, else a feed) to cleaned items with their id, each by its kind's parser in one stream."""
    by = lambda cond: bodies.filter(cond).drop("kind")
    parts = [ingest(by(F.col("kind") == "json"), feeds.parse_json_items), ingest(by(F.coalesce(F.col("kind") != "json", F.lit(True))), feeds.parse_feed)]
    return parts[0].unionByName(parts[1])


def dedup(items: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """The first row of an id within the horizon; seen_at is the event time."""
    return items.withWatermark("seen_at", horizon).dropDuplicatesWithinWatermark(["id"])


def health(attempts: DataFrame, width: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Attempts and failures per source and window of ts (append mode: a window leaves when it is over)."""
    at = F.window("ts", width, slide) if slide else F.window("ts", width)
    x = attempts.withWatermark("ts", late).groupBy(at.alias("w"), "source_id").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(~F.col("ok")).alias("failed"))
    return x.select("source_id", F.col("w.start").alias("since"), F.col("w.end").alias("until"), "attempts", "failed")


def title_pins(items: DataFrame, horizon_days: int = 30) -> DataFrame:
    """id, pinned, seen_at: the wording an id keeps until it hasn't been seen for horizon_days; a row per id and batch.

    The earliest wording of a batch pins a new id (ties: the smallest). The state is
    one wording per id, and expires by event time, the horizon behind the newest row.
    """
    wait = horizon_days * 86_400_000

    def pin(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept, seen = state.get if state.exists else (None, 0)
        found = first = newest = None
        for p in parts:
            ms = p["seen_at"].astype("datetime64[ms]").astype("int64")
            best = min(zip(ms, p["title_cn"]))
            found = best if found is None else min(found, best)
            first = best[0] if first is None else min(first, best[0])
            newest = int(ms.max()) if newest is None else max(newest, int(ms.max()))
        if found is None:
            return
        if kept is None or first - seen > wait:  # a new id, or one not seen for the horizon
            kept = found[1]
        seen = max(seen, newest)
        if seen + wait > state.getCurrentWatermarkMs():
            state.update((kept, seen))
            state.setTimeoutTimestamp(seen + wait)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"id": [key[0]], "pinned": [kept], "seen_at": [pd.Timestamp(seen, unit="ms")]})

    worded = items.filter(F.coalesce("title_cn", F.lit("")) != "").select("id", "title_cn", "seen_at").withWatermark("seen_at", f"{horizon_days} days")
    return worded.groupBy("id").applyInPandasWithState(pin, "id string, pinned string, seen_at timestamp", "pinned string, seen long", "update", GroupStateTimeout.EventTimeTimeout)


def cases_upsert(new: DataFrame, library: DataFrame, path: str, day: str) -> DataStreamWriter:
    """Merge each micro-batch into the library under `path`. Version k is made of version k - 1 and batch k, so a repeated batch writes the same again."""
    spark, schema = library.sparkSession, library.schema
    library.limit(0).write.mode("ignore").parquet(f"{path}/empty")

    def merge(batch: DataFrame, k: int) -> None:
        old = library if k == 0 else spark.read.schema(schema).parquet(f"{path}/v={k - 1:012d}")
        write_snapshot(K.upsert(old, K.last_write(batch), day), path, k)

    return new.writeStream.foreachBatch(merge)


def drained(stream: DataFrame, at: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there, into Parquet under `at`, and read that.

    In update mode the rows of all batches are there, with their batch (`k`); see latest().
    """
    spark: SparkSession = stream.sparkSession
    out = f"{at.rstrip('/')}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}/state").outputMode(mode)
    if mode == "append":
        query = writer.format("parquet").start(f"{out}/rows")
    else:
        query = writer.foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{out}/rows/k={k}")).start()
    query.awaitTermination()
    schema = stream.schema if mode == "append" else stream.schema.add("k", "long")
    return spark.read.schema(schema).parquet(f"{out}/rows")


def latest(rows: DataFrame, key: str) -> DataFrame:
    """Of each key the row of its last batch."""
    rest = [c for c in rows.columns if c not in (key, "k")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "k").alias("r")).select(key, "r.*")
