"""Cost-balanced packing of token ids into sequences.

A sequence costs the sum over its pieces of `linear * n + quadratic * n * n`
(a piece attends to itself). Documents are dealt by a hash of their place in the scan
into pools of about `pool_bytes` of text, so that repeated rows spread. In a pool of N ids there are
ceil(N / max_len) sequences: whole multiples of max_len of a long document are
sequences of their own; the rests go in descending length to the sequence of
lowest cost that still has room; what fits nowhere whole is cut to fill the
room that is left. So a pool leaves less than max_len ids of padding.

Shuffle: ids move once, to their pool. The number of pools follows the bytes of
text, so that a pool always fits one task.

Null text: the end id alone. Rows that share a doc_id are packed separately.
Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batched, record_batch, table
from .tokens import crc, encoder, vocabulary_path, with_end

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


def plan_pool(lengths: list[int], max_len: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences from 0."""
    pieces, rests, sequence = [], [], 0
    for d, n in enumerate(lengths):
        whole = n - n % max_len
        for at in range(0, whole, max_len):
            pieces.append((d, at, max_len, sequence, 0))
            sequence += 1
        if n > whole:
            rests.append((n - whole, d, whole))
    bins = -(-sum(r[0] for r in rests) // max_len)
    used, cost, late = np.zeros(bins, np.int64), np.zeros(bins), []
    for n, d, at in sorted(rests, key=lambda r: (-r[0], r[1])):
        b = int(np.where(used + n <= max_len, cost, np.inf).argmin())
        if used[b] + n > max_len:
            late.append((n, d, at))
            continue
        pieces.append((d, at, n, sequence + b, int(used[b])))
        used[b] += n
        cost[b] += linear * n + quadratic * n * n
    room = sorted((b for b in range(bins) if used[b] < max_len), key=lambda b: (used[b], b), reverse=True)
    for n, d, at in late:
        while n:
            b = room[-1]
            take = min(n, max_len - int(used[b]))
            pieces.append((d, at, take, sequence + b, int(used[b])))
            used[b] += take
            n, at = n - take, at + take
            if used[b] == max_len:
                room.pop()
    return pieces


def pack(docs: DataFrame, path: str | None = None, max_len: int = 4096, pool_bytes: int = 4 << 20, linear: float = 1.0, quadratic: float = 1.0 / 4096, keep_ids: bool = False) -> DataFrame:
    """Pieces (schema PIECE); with keep_ids also their ids as array<int>."""
    path = path or vocabulary_path()
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = base.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8).alias("n")).first().n or 0
    pools = max(1, round(size / pool_bytes))

    def encode(batches):
        enc = encoder(path)
        for batch in batches:
            ids = [with_end(x).tobytes() for x in enc.column(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(ids, pa.binary())], names=["pool", "doc_id", "ids"])

    width = encoder(path).dtype
    schema = PIECE + (", ids array<int>" if keep_ids else "")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        pool = group["pool"][0].as_py() if len(group) else 0
        names, ids = group["doc_id"].to_pylist(), [np.frombuffer(x, width) for x in group["ids"].to_pylist()]
        rows = []
        for d, at, n, seq, offset in plan_pool([len(x) for x in ids], max_len, linear, quadratic):
            piece = ids[d][at : at + n]
            rows.append((names[d], at, n, crc(piece), len(ids[d]), (pool << 32) + seq, offset, linear * n + quadratic * n * n) + ((piece.tolist(),) if keep_ids else ()))
        return pa.Table.from_batches([record_batch(rows, schema)])

    pooled = base.withColumn("pool", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(pools)))
    return pooled.transform(batched, encode, "pool long, doc_id long, ids binary").groupBy("pool").applyInArrow(run, schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
