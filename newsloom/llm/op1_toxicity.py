"""Toxicity of deobfuscated text.

1. Language model: counts of character trigrams of all documents (a-z, word
   edge, one class for other letters), summed by Spark; the table has at most
   28**3 entries.
2. Noisy channel: leetspeak, spelled-out words (s p a c e d) and repeated letters
   make a lattice of readings - each symbol with the letters it may stand for, a
   run of a letter as one or two of it, trailing symbols as noise. Viterbi finds
   the reading of least channel cost plus trigram cost. Decoded are tokens that
   show such marks, and runs of three or more single characters with white space
   or punctuation between them, where each separator is dropped or a word edge.
3. Score: words and word beginnings of the restored text, of which those that
   tell toxic documents are chosen by their counts over the labelled rows, feed a
   logistic regression.

The model learns from at most `max_train` labelled documents (those of smallest
hash; all of them below the bound) whose crc32(doc_id) mod 5 is not 0, and keeps at
most `max_features` features (those that tell most). A document labelled more than
once counts as toxic if one of its labels says so. Labels, lang, source and doc_id
are no inputs of a score. Texts are read three times: for the trigrams, for the
labelled rows (which are handed over as a table) and to be scored, in a narrow pass.

Null and empty texts have no features and get the intercept's score. Rows that
share a doc_id are all scored. With no labelled row of either class every score
is the share of toxic rows (0 without rows). Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, handover, slices, table, text_buffers

# The letters a symbol may stand for, likelier ones first.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
CLASSES = 28  # 0 edge, 1-26 a-z, 27 other letters
WORD = re.compile(r"[^\W\d_]+")
SIGNS = "@$!|+(€£¡*"
SEPARATOR = re.compile(rf"([^\w{SIGNS}]|_)+")
#: Three or more single characters apart, not cut out of a word (nor the s of it's).
SPELLED = re.compile(rf"(?<![^\W_])(?<![^\W_]['’])(?:[^\W_]|[{SIGNS}])(?:(?:[^\w{SIGNS}]|_)++(?:[^\W_]|[{SIGNS}])){{2,}}(?![^\W_])")
#: A letter four times or more reads as three times: beyond two it is stretched.
STRETCHED = re.compile(rf"((?P<ch>[^\W_])(?P<by>(?:[^\w{SIGNS}]|_)++)(?P=ch)(?P=by)(?P=ch))(?:(?P=by)(?P=ch))+(?![^\W_])")
MARKED = re.compile(r"[^\W\d_][.\-_*][^\W\d_]|[^\W\d_][0-9@$!|+(€£¡*]|[0-9@$!|+(€£¡*][^\W\d_]|([^\W\d_])\1\1").search
SUBSTITUTE, DOUBLE, DROP = 0.7, 1.5, 0.3
EDGE, OTHER = 2.0, 1.5  # a word edge at the usual separator of a run; a dropped separator of another kind


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over the whole texts of all documents."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        to = np.zeros(256, np.int64)
        to[ord("a") : ord("z") + 1] = to[ord("A") : ord("Z") + 1] = np.arange(1, 27)
        to[0xC0:] = 27  # the first byte of a character beyond ASCII; the others go
        for whole in batches:
            for batch in slices(whole, "text"):
                raw, _ = text_buffers(batch.column(0))
                x = to[raw[(raw < 0x80) | (raw >= 0xC0)]]
                if len(x) > 2:
                    total += np.bincount((x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    out = np.zeros(CLASSES**3)
    rows = docs.select(F.col("text").cast("string")).transform(batched, run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most 28**3 rows
        out[r.gram] = r.n
    return out


def costs(counts: np.ndarray) -> np.ndarray:
    """-log P(third | first two), smoothed by the lower orders; [28, 28, 28]."""
    c = counts.reshape(CLASSES, CLASSES, CLASSES)
    one = (c.sum((0, 1)) + 1) / (c.sum() + CLASSES)
    two = (c.sum(0) + 8 * one) / (c.sum(0).sum(-1, keepdims=True) + 8)
    return -np.log((c + 8 * two) / (c.sum(-1, keepdims=True) + 8))


def letter_class(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 0 if ch == " " else 27


class Decoder:
    """Viterbi over the lattice of a marked token; keeps what it has decoded."""

    def __init__(self, cost: np.ndarray, most: int = 20_000):
        self.cost, self.most, self.known = cost.tolist(), most, {}

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """Per run of a character its readings with their channel cost."""
        runs = [(m.group()[0], len(m.group())) for m in re.finditer(r"(.)\1*", token)]
        out = []
        for k, (ch, n) in enumerate(runs):
            if ch in READINGS:
                options = [(r, SUBSTITUTE + 0.2 * i) for i, r in enumerate(READINGS[ch])]
                options += [(r + r, SUBSTITUTE + DOUBLE) for r in READINGS[ch][:2] if n > 1]
                options.append(("", DROP if k == len(runs) - 1 and not ch.isdigit() else 4.0 + n))
            elif ch.isalpha():
                options = [(ch, 0.0 if n != 2 else 2.5)] + ([(ch + ch, 0.0 if n == 2 else DOUBLE)] if n > 1 else [])
            else:
                options = [("", 0.5)]
            out.append(options)
        return out

    def spelled(self, run: str) -> list[list[tuple[str, float]]]:
        """Of a run of single characters: letters and signs as above, separators dropped or a word edge."""
        parts = [m.group() for m in re.finditer(rf"{SEPARATOR.pattern}|.", run)]
        usual = Counter(parts[1::2]).most_common(1)[0][0] if len(parts) > 1 else ""
        out = []
        for k, ch in enumerate(parts):
            if k % 2:
                options = [("", 0.0), (" ", EDGE)] if ch == usual else [("", OTHER), (" ", 0.0)]
            elif ch in READINGS:
                options = [(r, SUBSTITUTE + 0.2 * i) for i, r in enumerate(READINGS[ch])]
                if k == len(parts) - 1 and not ch.isdigit():
                    options.append(("", DROP))
            else:
                options = [(ch, 0.0)]
                if k > 3 and parts[k - 2] == parts[k - 4] == ch:
                    options.append(("", DROP))
            out.append(options)
        return out

    def decode(self, token: str, spelled: bool = False) -> str:
        token = token.lower()
        key = (token, spelled)
        if key in self.known:
            return self.known[key]
        best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}  # cost and the reading, linked backwards
        for options in self.spelled(token) if spelled else self.lattice(token):
            step: dict[tuple[int, int], tuple] = {}
            for (a, b), (total, text) in best.items():
                for read, price in options:
                    x, y, new = a, b, total + price
                    for ch in read:
                        z = letter_class(ch)
                        new += self.cost[x][y][z]
                        x, y = y, z
                    at = (x, y)
                    if at not in step or new < step[at][0]:
                        step[at] = (new, (text, read) if read else text)
            best = step
        text = min(((total + self.cost[a][b][0], a, b, text) for (a, b), (total, text) in best.items()), key=lambda x: x[:3])[3]
        read = []
        while text:
            text, last = text
            read.append(last)
        out = "".join(reversed(read))
        if len(self.known) >= self.most:
            self.known.clear()
        self.known[key] = out
        return out

    def words(self, token: str) -> list[str]:
        """Words of a token, restored if it is spelled out or shows marks."""
        if SPELLED.fullmatch(token):
            # an "a" before or an "I" after may stand outside of what is spelled out: such readings count too
            ends = [m.span() for m in SEPARATOR.finditer(token)]
            parts = [token[a:b] for a in (0, ends[0][1]) for b in (len(token), ends[-1][0]) if a + 1 < b]
            return [w for part in parts for w in WORD.findall(self.decode(part, spelled=True))]
        if MARKED(token):
            token = self.decode(token)
        return WORD.findall(token.lower())


BEGINNINGS = (4, 5, 6)


def tokens_of(text: str) -> set[str]:
    """Distinct white-space tokens of a text; a run of single characters apart, of which one is a letter, is a token too."""
    found = set(text.split())
    found.update(STRETCHED.sub(r"\1", m) for m in SPELLED.findall(text) if WORD.search(m))
    return found


class Features:
    """Features of texts; what a token gives is kept."""

    def __init__(self, cost: np.ndarray, chosen=None, most: int = 100_000):
        self.decoder, self.chosen, self.most, self.known = Decoder(cost), chosen, most, {}

    def of_token(self, token: str) -> tuple:
        words = self.decoder.words(token)
        found = (*words, *(w[:n] + "~" for w in words for n in BEGINNINGS if len(w) > n))
        return found if self.chosen is None else tuple(f for f in found if f in self.chosen)

    def of(self, text: str | None) -> set[str]:
        if not text:
            return set()
        tokens = tokens_of(text)
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for t in tokens:
            if t not in known:
                known[t] = self.of_token(t)
        return set().union(*filter(None, map(known.__getitem__, tokens)))


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


class Model:
    """Weights of chosen features, an intercept and the decoder's costs."""

    def __init__(self, cost: np.ndarray, weights: dict[str, float], intercept: float):
        self.cost, self.weights, self.intercept = cost, weights, intercept

    def score(self, features: Features, text: str | None) -> float:
        total = self.intercept + sum(map(self.weights.__getitem__, sorted(features.of(text))))
        return 1 / (1 + np.exp(-min(max(total, -30.0), 30.0)))


def logistic(rows: list[list[int]], y: np.ndarray, width: int, l2: float = 1.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on 0/1 features, by accelerated gradient steps."""
    flat = np.fromiter((j for r in rows for j in r), np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w = v = np.zeros(width)
    b = c = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    # per-feature step: half the number of rows that have it, times the most features in a row
    size = 0.25 * np.bincount(flat, minlength=width) * max(1, max(map(len, rows), default=1)) ** 0.5 + l2
    size_b = 0.25 * len(y) + 1
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(c + np.bincount(of, weights=v[flat], minlength=len(rows)), -30, 30)))
        g = np.bincount(flat, weights=(p - y)[of], minlength=width) + l2 * v
        w2, b2 = v - g / size / 2, c - (p - y).sum() / size_b / 2
        v, c = w2 + k / (k + 3) * (w2 - w), b2 + k / (k + 3) * (b2 - b)
        if not np.isfinite(v).all() or np.abs(v).max(initial=0) > 50:
            v, c = np.clip(np.nan_to_num(w), -50, 50), b
        w, b = w2, b2
    return np.clip(np.nan_to_num(w), -50, 50), float(b)


def train(docs: DataFrame, labels: DataFrame, max_train: int = 24_000, max_features: int = 4096) -> Model:
    cost = costs(trigram_counts(docs))
    rows = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    learn = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")  # at most max_train documents
    learn = handover(learn.select("text", "toxic"), "labelled")

    def count(batches):
        features, bad, seen = Features(cost), Counter(), Counter()
        for batch in batches:
            for t, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                f = features.of(t)
                seen.update(f)
                if toxic:
                    bad.update(f)
        names = list(seen)
        for k in range(0, len(names), 50_000):
            part = names[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([bad[x] for x in part], pa.int64()), pa.array([seen[x] for x in part], pa.int64())], names=["f", "a", "n"])

    totals = {r.toxic: r["count"] for r in learn.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    share = min(max(bad / max(1, bad + good), 1e-6), 1 - 1e-6)
    if not bad or not good:
        return Model(cost, {}, float(np.log(share / (1 - share))))
    each = learn.select("text", "toxic").transform(batched, count, "f string, a long, n long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    # G of the 2 x 2 table, for features with twice the odds of toxic rows
    a, n = F.col("a"), F.col("n")
    gain = a * F.log((a + 0.5) / (n * F.lit(share) + 0.5)) + (n - a) * F.log((n - a + 0.5) / (n * F.lit(1 - share) + 0.5))
    chosen = each.filter((a >= 3) & (a * good > 2 * (n - a) * bad)).orderBy(gain.desc(), "f").limit(max_features)
    names = [r.f for r in chosen.select("f").collect()]
    index = {f: i for i, f in enumerate(names)}

    def project(batches):
        features = Features(cost, index)
        for batch in batches:
            f = [sorted(index[x] for x in features.of(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(f, pa.list_(pa.int32()))], names=["toxic", "f"])

    data = learn.select("text", "toxic").transform(batched, project, "toxic int, f array<int>").collect()  # at most max_train rows
    weights, intercept = logistic([r.f for r in data], np.array([r.toxic for r in data], float), len(names))
    return Model(cost, {f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-4}, intercept)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "toxicity") -> DataFrame:
    """The columns `keep` of docs (default: all), then the score as `name`, which must not be one of them."""
    keep = docs.columns if keep is None else keep
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most max_features weights and 28**3 costs
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(name, T.DoubleType())])

    def run(batches):
        m = held.value
        features = Features(m.cost, m.weights)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array([m.score(features, t.as_py()) for t in text], pa.float64())], names=[*keep, name])

    return docs.transform(batched, run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score(base, train(docs, labels, **limits), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
