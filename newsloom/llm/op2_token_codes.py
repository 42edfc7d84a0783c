"""Token ids in directly addressable codes.

File format, one segment a row (`codes`), about `segment_tokens` ids each:

    u32 magic, u32 ids, u32 levels
    per level: u32 chunks, chunks bytes (8 bits of each id that reaches this
    level, low bits first), continuation bitmap (1: the id goes on at the next
    level), rank directory (u32 ones before each block of 512 bits)

Token i is read by its chunk at level 0; where its bit is set, the rank of that
bit (directory + ones inside one block) is its place at the next level. No
block is decoded. The document directory (`doc_ids`, `doc_ends`) stands beside
the codes.

Shuffle: one range partitioning by doc_id, so files are in ascending doc_id
order; each partition numbers its own ids, and the offset of a partition is a
sum over one number per partition.

`token_at` reads single tokens of the data set: the document directory's sums tell the
segment, and the segment's codes the id.

Null text: no ids but the end id. Rows that share a doc_id keep one entry each,
in order of text. Null doc_ids come first. Empty table: no segments, no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batched, handover, partitions, record_batch, table
from .tokens import crc, encoder, vocabulary_path, with_end

MAGIC = 0x31434144
BLOCK = 512
CODES = "part int, segment long, first_id long, n_ids long, doc_ids array<long>, doc_ends array<long>, codes binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode_codes(ids: np.ndarray) -> bytes:
    """The codes of one segment."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        pad = -len(bits) % (BLOCK // 8)
        ones = np.unpackbits(np.append(bits, np.zeros(pad, np.uint8))).reshape(-1, BLOCK).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append(np.array([len(rest)], "<u4").tobytes() + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            break
    return np.array([MAGIC, len(ids), len(levels)], "<u4").tobytes() + b"".join(levels)


class Codes:
    """Reader of one segment: code[i] is one token, ids() all of them."""

    def __init__(self, raw: bytes):
        magic, self.n, count = (int(x) for x in np.frombuffer(raw, "<u4", 3))
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at, self.levels = 12, []
        for _ in range(count):
            n = int(np.frombuffer(raw, "<u4", 1, at)[0])
            at += 4
            chunks = np.frombuffer(raw, np.uint8, n, at)
            at += n
            bits = np.frombuffer(raw, np.uint8, -(-n // 8), at)
            at += len(bits)
            ranks = np.frombuffer(raw, "<u4", -(-n // BLOCK), at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i, shift = int(ranks[block]) + int(inside.sum()), shift + 8
        return value

    def ids(self) -> np.ndarray:
        out = np.zeros(self.n, np.uint32)
        where = np.arange(self.n)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[where] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            where = where[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write_codes(docs: DataFrame, path: str | None = None, segment_tokens: int = 1 << 18) -> DataFrame:
    """Encode all documents; return the written segments as they are read back (schema CODES)."""
    path = path or vocabulary_path()

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        first, segment, ids, docs_in, ends, size = 0, 0, [], [], [], 0

        def row():
            return record_batch([(part, segment, first, size, docs_in, ends, encode_codes(np.concatenate(ids)))], CODES)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), enc.column(batch.column(1))):
                ids.append(with_end(raw))
                size += len(ids[-1])
                docs_in.append(doc)
                ends.append(size)
                if size >= segment_tokens:
                    yield row()
                    first, segment, ids, docs_in, ends, size = first + size, segment + 1, [], [], [], 0
        if docs_in:
            yield row()

    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return handover(ordered.transform(batched, run, CODES), "codes")


def read_codes(codes: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the written segments."""
    base = bases(codes)

    def run(batches):
        for batch in batches:
            for part, first, docs_in, ends, raw in zip(*(c.to_pylist() for c in batch.columns)):
                ids, began, rows = Codes(raw).ids(), 0, []
                for doc, end in zip(docs_in, ends):
                    rows.append((doc, base[part] + first + began, end - began, crc(ids[began:end])))
                    began = end
                yield record_batch(rows, READ)

    return codes.select("part", "first_id", "doc_ids", "doc_ends", "codes").transform(batched, run, READ)


def bases(codes: DataFrame) -> dict[int, int]:
    """Ids before each partition's first; one number per partition comes to the driver."""
    sums = codes.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, total = {}, 0
    for r in sums:
        base[r.part] = total
        total += r.n
    return base


def token_at(codes: DataFrame, positions: DataFrame) -> DataFrame:
    """position, id of the ids at places (`position`, from 0) of the whole data set; places beyond its end give no row.

    A segment is opened once and gives only the ids that are asked for, each by rank.
    """
    spark = codes.sparkSession
    base = spark.createDataFrame(list(bases(codes).items()) or [(-1, 0)], "part int, base long")
    at = codes.select("part", "segment", "n_ids", "first_id").join(F.broadcast(base), "part")
    spans = at.select("part", "segment", (F.col("base") + F.col("first_id")).alias("begin"), (F.col("base") + F.col("first_id") + F.col("n_ids")).alias("end"))
    width = 1 << 18
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("begin") / width), F.floor((F.col("end") - 1) / width))))
    asked = positions.select(F.col("position").cast("long")).withColumn("cell", F.floor(F.col("position") / width))
    met = asked.join(cells, "cell").filter("position >= begin and position < end")
    wanted = met.groupBy("part", "segment").agg(F.collect_set((F.col("position") - F.col("begin"))).alias("at"), F.first("begin").alias("begin"))

    def run(batches):
        for batch in batches:
            rows = []
            for places, begin, raw in zip(*(c.to_pylist() for c in batch.columns)):
                code = Codes(raw)
                rows += [(begin + i, code[i]) for i in places]
            yield record_batch(rows, "position long, id long")

    return wanted.join(codes, ["part", "segment"]).select("at", "begin", "codes").transform(batched, run, "position long, id long")


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_codes(write_codes(table(spark, sf_dir, "documents")))
