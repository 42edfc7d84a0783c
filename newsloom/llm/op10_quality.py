"""Quality classifier by co-training of two views.

View A sees the text: which hashed words it has, and the shape of its characters and
words in steps. View B sees the metadata of the page: language, source and length.
Both are ridge logistic regressions on features that are there or not, and start from
labelled rows. In each round each view scores all unlabelled rows and labels those it
is surest of, and the other view learns from them too. Then each view is calibrated
(a logistic curve on its margin) and one more logistic model combines the calibrated
margins, both on labelled rows held back from the views. It scores every document.

Features are taken once, in a narrow pass, and handed over as a table (2 bytes a
feature); rounds and scoring read that. A round's choice is an aggregate: each task
keeps its `each` surest rows per view and class, and of these the surest go to the
driver. Learning uses at most `max_train` labelled rows (of smallest hash,
crc32(doc_id) mod 5 not 0) and 4 * rounds * each rows that the views have labelled.
Documents with crc32(doc_id) mod 5 = 0 are never learnt from, labelled or not.

Null text is empty; null lang or source is a value of its own. A document labelled
more than once counts with its lowest quality. Rows that share a doc_id are all
scored. With one class or no labelled row every score is the share of good rows (0.5
without rows). Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batched, handover, hash_spans, slices, table, text_buffers
from .op1_toxicity import held_out, logistic

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#$%&*@^~|<>{}[]\\=+_`"
_MARK = b"!?"
_STOP = b".,;:"
WORDS = 1 << 13  # hashed words
STEPS = 9  # of each shape
SHAPES = 10
WIDTH_A = WORDS + STEPS * SHAPES
LANGS, SOURCES, LENGTHS = 8, 32, 24
WIDTH_B = LANGS + SOURCES + LENGTHS

FEATURES = "row long, doc_id long, y int, pool boolean, a binary, b binary"


def shapes(text: str) -> list[float]:
    """Ten measures of a text, each from 0 to 1."""
    raw, words = text.encode(), text.split()
    n, m = max(1, len(raw)), max(1, len(words))
    share = lambda drop: (len(raw) - len(raw.translate(None, drop))) / n
    same = sum(map(operator.eq, words, words[1:])) / m
    small = [share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_MARK), share(_STOP), same, min(raw.count(b"\n") / m, 1.0)]
    return [min(max(-math.log2(v + 2**-8), 0) / STEPS, 1) for v in small] + [len(set(words)) / m, min(n / m, 20) / 20, min(math.log1p(m) / 12, 1)]


def text_views(batch: pa.Array) -> list[np.ndarray]:
    """Features of view A of each text, ascending."""
    raw, offsets = text_buffers(batch)
    low = raw.copy()
    low[(raw >= 65) & (raw <= 90)] += 32
    word = raw > 32
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    begin[inner] |= word[inner]
    after = np.append(~word, True)
    after[inner] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(word & after[1:]) + 1
    hashed = (hash_spans(low, starts, ends) % np.uint64(WORDS)).astype(np.uint16)
    first = np.searchsorted(starts, offsets)
    out = []
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        steps = [WORDS + i * STEPS + min(int(v * STEPS), STEPS - 1) for i, v in enumerate(shapes(batch[k].as_py() or ""))]
        out.append(np.append(np.unique(hashed[a:b]), np.array(steps, np.uint16)))
    return out


def meta_view(lang: str | None, source: str | None, length: int) -> np.ndarray:
    """Features of view B."""
    named = lambda x, n: (1 + zlib.crc32(x.encode()) % (n - 1)) if x is not None else 0
    return np.array([named(lang, LANGS), LANGS + named(source, SOURCES), LANGS + SOURCES + min(length.bit_length(), LENGTHS - 1)], np.uint16)


def features(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """Schema FEATURES of every row; picked: doc_id, y of the labelled ones."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                column = dict(zip(batch.schema.names, batch.columns))
                a = text_views(column["text"])
                length = pa.compute.fill_null(pa.compute.utf8_length(column["text"]), 0).to_pylist()
                b = [meta_view(*x) for x in zip(column["lang"].to_pylist(), column["source"].to_pylist(), length)]
                packed = [pa.array([x.astype("<u2").tobytes() for x in v], pa.binary()) for v in (a, b)]
                yield pa.RecordBatch.from_arrays([*(column[c] for c in ("row", "doc_id", "y", "pool")), *packed], names=["row", "doc_id", "y", "pool", "a", "b"])

    x = docs.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(picked), "doc_id", "left")  # at most max_train rows
    x = x.withColumn("pool", F.col("y").isNull() & ~held_out(F.col("doc_id")))
    return x.select("row", "doc_id", "y", "pool", "text", "lang", "source").transform(batched, run, FEATURES)


class Flat:
    """Packed features of many rows, ready to be weighed."""

    def __init__(self, packed: list[bytes]):
        self.flat = np.frombuffer(b"".join(packed), "<u2").astype(np.int64)
        self.of = np.repeat(np.arange(len(packed)), [len(x) // 2 for x in packed])
        self.n = len(packed)

    def margin(self, model: tuple[np.ndarray, float]) -> np.ndarray:
        return np.bincount(self.of, weights=model[0][self.flat], minlength=self.n) + model[1]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def curve(x: np.ndarray, y: np.ndarray, l2: float = 0.1, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression on few columns by Newton steps; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


class CoTrained:
    """Two views, their curves and the weights that combine them; or the share of good rows alone."""

    def __init__(self, views=None, curves=None, last=None, share: float = 0.5):
        self.views, self.curves, self.last, self.share = views, curves, last, share

    def score(self, a: list[bytes], b: list[bytes]) -> np.ndarray:
        if self.views is None:
            return np.full(len(a), self.share)
        z = [Flat(x).margin(v) * c[0] + c[1] for x, v, c in zip((a, b), self.views, self.curves)]
        return sigmoid(np.c_[z[0], z[1]] @ self.last[:2] + self.last[2])


def learn(view: int, packed: list[bytes], y: list[int]) -> tuple[np.ndarray, float]:
    rows = [np.frombuffer(x, "<u2").tolist() for x in packed]
    return logistic(rows, np.array(y, float), (WIDTH_A, WIDTH_B)[view], l2=0.5, steps=100)


def surest(pool: DataFrame, models, taken: list[set[int]], each: int, sure: float) -> list[tuple[int, int, object]]:
    """(view, label, row with a and b) of the unlabelled rows each view is surest of, `each` per class; `taken[v]`: rows that view v has labelled before."""

    def run(batches):
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for batch in batches:
            row, packed = batch.column(0).to_pylist(), [batch.column(1).to_pylist(), batch.column(2).to_pylist()]
            for v in (0, 1):
                p = sigmoid(Flat(packed[v]).margin(models[v]))
                for label, chance in ((1, p), (0, 1 - p)):
                    rows = [(-float(chance[k]), row[k]) for k in np.flatnonzero(chance >= sure).tolist() if row[k] not in taken[v]]
                    best[v, label] = sorted(best.get((v, label), []) + rows)[:each]
        out = [(v, label, -c, r) for (v, label), rows in best.items() for c, r in rows]
        columns = list(zip(*out)) if out else [()] * 4
        types = [pa.int32(), pa.int32(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["view", "label", "chance", "row"])

    found = pool.select("row", "a", "b").transform(batched, run, "view int, label int, chance double, row long")
    found = found.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(64)))
    for keys in (["view", "label", "part"], ["view", "label"]):  # first among a part of the tasks' rows
        place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("chance"), "row"))
        found = found.withColumn("place", place).filter(F.col("place") <= each)
    picks = found.select("view", "label", "row", "place").collect()  # 4 * each rows
    rows = {r.row: r for r in pool.filter(F.col("row").isin([r.row for r in picks])).select("row", "a", "b").collect()} if picks else {}
    return [(r.view, r.label, rows[r.row]) for r in sorted(picks, key=lambda r: (r.view, r.label, r.place))]


def co_train(labelled: list, pool: DataFrame, rounds: int = 3, each: int = 200, sure: float = 0.97) -> CoTrained:
    """labelled: rows (doc_id, y, a, b), of which every fifth is held back for the curves."""
    y = [r.y for r in labelled]
    if len(set(y)) < 2:
        return CoTrained(share=sum(y) / len(y) if y else 0.5)
    back = [k % 5 == 4 for k in range(len(y))]
    if len({v for v, held in zip(y, back) if held}) < 2 or len({v for v, held in zip(y, back) if not held}) < 2:
        back = None  # too few: learn and calibrate on all
    own = [r for k, r in enumerate(labelled) if not (back and back[k])]
    texts = [[[bytes(r[c]) for r in own] for c in ("a", "b")][v] for v in (0, 1)]
    told = [[r.y for r in own], [r.y for r in own]]
    models = [learn(v, texts[v], told[v]) for v in (0, 1)]
    taken: list[set[int]] = [set(), set()]
    for _ in range(rounds):
        found = surest(pool, models, taken, each, sure)
        for v, label, r in found:  # what one view is sure of, the other learns
            texts[1 - v].append(bytes((r.a, r.b)[1 - v]))
            told[1 - v].append(label)
            taken[v].add(r.row)
        if not found:
            break
        models = [learn(v, texts[v], told[v]) for v in (0, 1)]
    rest = [r for k, r in enumerate(labelled) if not back or back[k]]
    right = np.array([r.y for r in rest], float)
    margins = [Flat([bytes(r[c]) for r in rest]).margin(m) for c, m in zip(("a", "b"), models)]
    curves = [curve(z[:, None], right) for z in margins]
    last = curve(np.c_[margins[0] * curves[0][0] + curves[0][1], margins[1] * curves[1][0] + curves[1][1]], right)
    return CoTrained(models, curves, last, sum(y) / len(y))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_train: int = 10_000, **limits) -> DataFrame:
    """doc_id, held_out, score, kept."""
    base = docs.select(F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("text", "lang", "source")])
    rows = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y")).dropna().filter(~held_out(F.col("doc_id")))
    picked = rows.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    held = handover(features(base, picked), "features")
    learnt = held.filter("y is not null").select("row", "doc_id", "y", "a", "b").orderBy(F.xxhash64("doc_id"), "row").collect()  # of at most max_train documents
    model = docs.sparkSession.sparkContext.broadcast(co_train(learnt, held.filter("pool"), **limits))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(batch.column(1).to_pylist(), batch.column(2).to_pylist()), pa.float64())], names=["doc_id", "score"])

    scored = held.select("doc_id", "a", "b").transform(batched, run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).alias("kept"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
