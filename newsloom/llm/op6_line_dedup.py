"""Line dedup by winnowing over line hashes.

Lines are stripped and lower-cased; blank ones don't count. In each window of
`window` consecutive line hashes the least one (the last of equals) is picked. The
fingerprints are the hashes of the runs of `min_lines` lines that hold a picked
line, and of all shorter runs of `min_words` words. They join on their hash with
the first place that run occurs at (least doc_id, then line); a run that isn't the
first is deleted. A common line that stands elsewhere with other neighbours is
another run and hides nothing.

With `window` up to `min_lines` every run of `min_lines` lines holds a picked line,
and the result is exact: a line goes if and only if it lies in such a run that
occurs before. A match that goes on is then met by its next run, so there is nothing
to extend. With wider windows runs shorter than `window` may be missed, and
matches are extended both ways, line by line, as far as `reach` lines.

Shuffle: one row per fingerprint (about one a line), pre-aggregated to the first
place of each hash; the join back drops hashes that occur once, and AQE splits hot
hashes. Texts move once, to meet their deleted lines.

Null and empty texts have no lines. Documents are told apart by doc_id and a hash of
their text, so rows that share a doc_id are cut each by its own runs; rows that share
both are one document, and cut alike. Null doc_ids come first in order. Empty table: no
rows. Other columns are ignored by the query and kept by `line_dedup`, whatever their
names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, free_name, record_batch, table

ROLL, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
PRINT = "h long, doc_id long, mark long, pos int, n int, hashes binary"


def lines_of(text: str | None) -> list[str]:
    return [x for line in (text or "").split("\n") if (x := line.strip().lower())]


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def selected(hashes: list[int], window: int) -> set[int]:
    """Positions of picked lines."""
    picked = set()
    for a in range(max(1, len(hashes) - window + 1)) if hashes else ():
        part = hashes[a : a + window]
        low = min(part)
        picked.add(a + len(part) - 1 - part[::-1].index(low))
    return picked


def key_runs(hashes: list[int], words: list[int], window: int, min_lines: int, min_words: int) -> list[tuple[int, int]]:
    """(begin, lines) of the runs that are fingerprints."""
    last = len(hashes) - min_lines
    out = [(i, min_lines) for i in sorted({b for i in selected(hashes, window) for b in range(max(0, i - min_lines + 1), min(i, last) + 1)})]
    for i in range(len(hashes)):
        total = 0
        for n in range(1, min(min_lines, len(hashes) - i + 1)):
            total += words[i + n - 1]
            if total >= min_words:
                out.append((i, n))
    return out


def run_hash(hashes: list[int]) -> int:
    """64 bits, signed, of a run of line hashes."""
    h = len(hashes)
    for x in hashes:
        h = (h * ROLL + x) & MASK
    return h - (h >> 63 << 64)


def fingerprints(docs: DataFrame, window: int, min_lines: int, min_words: int, reach: int) -> DataFrame:
    """`hashes`: 32 bits of each line from `reach` before a run to `reach` after min_lines; empty where nothing is to be extended."""

    def run(batches):
        for batch in batches:
            rows = []
            for d, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
                lines = lines_of(text)
                full = [line_hash(x) for x in lines]
                runs = key_runs(full, [len(x.split()) for x in lines], window, min_lines, min_words)
                if window <= min_lines:
                    rows += [(run_hash(full[i : i + n]), d, mark, i, n, b"") for i, n in runs]
                    continue
                h = np.zeros(len(full) + 2 * reach + min_lines, "<u4")
                h[reach : reach + len(full)] = np.array(full, np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF) | np.uint64(1)  # 0: no line
                rows += [(run_hash(full[i : i + n]), d, mark, i, n, h[i : i + 2 * reach + min_lines].tobytes()) for i, n in runs]
            yield record_batch(rows, PRINT)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text), text).transform(batched, run, PRINT)


def repeated_runs(docs: DataFrame, window: int = 2, min_lines: int = 2, min_words: int = 50, reach: int = 4) -> DataFrame:
    """doc_id, mark (hash of the text), runs (begin, end, ... as a flat array of line numbers): later repeats, per document."""
    prints = fingerprints(docs, window, min_lines, min_words, reach)
    place = F.struct("doc_id", "mark", "pos", F.col("hashes").alias("around"))
    first = prints.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("h", "first")
    met = prints.join(first, "h").filter("not (doc_id <=> first.doc_id and mark = first.mark and pos = first.pos)")
    runs = "doc_id long, mark long, begin long, end long"

    def extend(batches):
        for batch in batches:
            rows = []
            for d, mark, pos, n, own, other in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(own, "<u4"), np.frombuffer(other, "<u4")
                same = (a == b) & (a != 0)
                left, right = reach, reach + n
                while left and same[left - 1]:
                    left -= 1
                while right < len(same) and same[right]:
                    right += 1
                rows.append((d, mark, pos + left - reach, pos + right - reach))
            yield record_batch(rows, runs)

    if window <= min_lines:
        found = met.select("doc_id", "mark", F.col("pos").cast("long").alias("begin"), (F.col("pos") + F.col("n")).cast("long").alias("end"))
    else:
        found = met.select("doc_id", "mark", "pos", "n", "hashes", "first.around").transform(batched, extend, runs)
    return found.groupBy("doc_id", "mark").agg(F.flatten(F.array_sort(F.collect_set(F.array("begin", "end")))).alias("runs"))


def cut_lines(text: str | None, runs: list[int] | None) -> tuple[str | None, int, int]:
    """Text without the lines of the runs, lines, removed lines."""
    if text is None:
        return None, 0, 0
    gone = {i for k in range(0, len(runs or ()), 2) for i in range(runs[k], runs[k + 1])}
    kept, n = [], 0
    for line in text.split("\n"):
        if line.strip():
            if n not in gone:
                kept.append(line)
            n += 1
        else:
            kept.append(line)
    return "\n".join(kept), n, len([i for i in gone if i < n])


def line_dedup(docs: DataFrame, **limits) -> DataFrame:
    """All columns of docs with text cut, then n_lines, n_removed (with underscores behind, where docs has such columns)."""
    n_lines, n_removed, runs_name = (free_name(n, docs.columns) for n in ("n_lines", "n_removed", "runs"))
    runs = repeated_runs(docs, **limits)
    mine = F.col("d.doc_id").cast("long").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("r.mark"))
    joined = docs.alias("d").join(runs.alias("r"), mine, "left").select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("r.runs").alias(runs_name))
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def run(batches):
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            cut = [cut_lines(t, r) for t, r in zip(column["text"].to_pylist(), column.pop(runs_name).to_pylist())]
            column["text"] = pa.array([c[0] for c in cut], pa.string())
            column[n_lines], column[n_removed] = (pa.array([c[k] for c in cut], pa.int64()) for k in (1, 2))
            yield pa.RecordBatch.from_arrays(list(column.values()), names=list(column))

    return joined.transform(batched, run, schema)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    cut = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.char_length(text).cast("long").alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
