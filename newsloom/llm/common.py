"""Shared helpers of the training-data operators: tables, hand-over tables, Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BATCH, batched, give_back, handover, shared_dir  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: SQL (DuckDB) of crc32: a table by its rule as `tab` of the CTE `crc`, and the checksum of a text of Latin-1 characters.
SQL_CRC = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS tab)"


def sql_crc32(text: str) -> str:
    code = "CAST(unicode(ch) AS BIGINT)"
    in_utf8 = f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {code} < 128 THEN [{code}] ELSE [192 | ({code} >> 6), 128 | ({code} & 63)] END))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {in_utf8}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """Lower-case A-Z only. Pure ASCII texts (bytes = characters) take the byte-wise lower()."""
    c = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def free_name(name: str, taken) -> str:
    """`name`, with underscores behind it until no column in `taken` is called so (case aside)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def text_buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, offsets) of an Arrow string column; nulls are empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.chunk(0) if arr.num_chunks else pa.array([], pa.string())
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(arr) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Cut a batch so that a piece holds about `most` bytes of text; a longer text stands alone."""
    col = batch.column(batch.schema.get_field_index(column))
    if not batch.num_rows:
        return
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
    piece, began = 0, 0
    for i, n in enumerate(sizes):
        if i > began and piece + n > most:
            yield batch.slice(began, i - began)
            began, piece = i, 0
        piece += n
    yield batch.slice(began)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def record_batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    """Rows as an Arrow batch of a flat schema such as "a long, b array<string>"."""
    fields = [f.split() for f in ddl.split(", ")]
    types = [pa.list_(_ARROW[t[6:-1]]) if t.startswith("array<") else _ARROW[t] for _, t in fields]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[n for n, _ in fields])


ROLL = np.uint64(0x9E3779B97F4A7C15)
ROLL_INVERSE = np.uint64(pow(int(ROLL), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), mod 2 ** 64; kept for the next buffer."""
    if int(base) not in _powers or len(_powers[int(base)]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _powers[int(base)] = np.cumprod(out)
    return _powers[int(base)][:n]


def hash_spans(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of raw[begin:end] for each span: a polynomial from prefix sums, shifted back to the span's start, and its length."""
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw), ROLL), out=prefix[1:])
    return mix((prefix[end] - prefix[begin]) * powers(len(raw), ROLL_INVERSE)[begin] ^ (end - begin).astype(np.uint64))
