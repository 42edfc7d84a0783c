"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Learning. Words are runs without white space, A-Z lower-cased; each text has one end token
behind it, which also stands for what is before its first word. Counts of words and of
pairs of neighbours are combined in each task and dealt by gram. A gram of count c has
level 1 + floor(log_b c); the filter holds (gram, 1), (gram, 2) ... up to its level, so a
count is read by probing levels until one is missing. It is never read too low, and too
high by j levels only if j false answers meet (each has a chance of about half a hundredth).
The PROBES bits of an entry lie in one block of 64 bytes.
The filter has parts: a task makes the parts of the grams that it was dealt, sized by what
they hold (BITS a level), so nothing is built on the driver.

Scoring. p(w | h) = (c(hw) + s p(w)) / (c(h) + s) with p(w) = (c(w) + 1) / (N + V + 1) and
s = c(h) ** beta, an estimate of how many different words follow h. beta is the one value at
which these estimates sum up to the number of different pairs seen (h = 1 has one follower).
All counts in it are those of the filter. The score is the sum of log10 p over a text's tokens.

The filter grows with the corpus. It is broadcast up to `most_broadcast` bytes, measured before
anything is collected. Beyond, probes go to the filter instead, by chunks of documents (CHUNK
bytes): a chunk's different grams are dealt to the tasks that hold their part and its words'
exact counts, and levels and counts come back to the chunk in the same order. A gram is
asked for once a chunk, however frequent it is. Both ways give the same scores.

`learn_and_score` does both for a table whose size doesn't matter then: the grams of all documents
meet once, by bin, with their counts in training texts. The task that makes a bin's parts of the
filter answers from them at once, and the model's table holds parts and answers.

The base score takes exact counts. Where the filter is broadcast, words of a share of 1 / HOT of
all tokens or more (so HOT at most) are too, the rest is joined by word, where none is frequent.
Words are told apart by 63 bits of hash (two of 10 million words meet with a chance of 5e-6).

Shuffles: the different grams of each chunk by bin (some parts each), as ascending differences
(under six bytes a gram), to learn and to ask, or once for both; the filter by bin, if asked later;
answers (under a byte a gram) and compressed texts by chunk. Where the filter is broadcast: rare
words by word and by document. Chunks or rows are told apart by their place in the scan, so `docs`
should be a table or a checkpoint; a chunk that is not the same when read again is an error.

Nulls: a null text is empty and has the end token alone; a null doc_id counts as an empty
string for holding out. Repeated rows count and are scored each. Without training rows all
probabilities are 1. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROLL, batched, give_back, handover, hash_spans, mix, partitions, record_batch, slices, table, text_buffers

#: Base of the levels, bits and probes of an entry.
BASE, BITS, PROBES = 1.5, 12, 6
HOT = 200_000
MOST_BROADCAST = 256 << 20
#: Bytes of text whose grams a task holds before it combines them.
CHUNK = 8 << 20

END = np.uint64(0x5E7D00D5E7D00D5E)
GRAMS = "bin int, grams binary, n binary"
MODEL = "part int, bin int, words binary, counts binary, bits binary, tokens long, types long, pairs long, histogram array<long>"
ASKS = "chunk long, bin int, grams binary, n binary"
ANSWERS = "chunk long, bin int, levels binary, known binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
FLAT = "row long, gram long, n long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"


def level(count: np.ndarray) -> np.ndarray:
    """1 + floor(log_b count)."""
    return np.where(count > 0, 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(BASE) + 1e-9), 0).astype(np.int64)


def _middles(most: int = 200) -> np.ndarray:
    """The count that a level stands for: the middle of the whole numbers that have it; 0 at level 0."""
    edge = np.ceil(BASE ** np.arange(most + 1) - 1e-9)
    return np.concatenate(([0.0], np.where(edge[1:] > edge[:-1], (edge[:-1] + edge[1:] - 1) / 2, edge[:-1])))


MIDDLE = _middles()


class Tokens(NamedTuple):
    words: np.ndarray  # hash of each token, texts one after the other, an end token behind each
    pairs: np.ndarray  # hash of each token with the one before
    ends: np.ndarray  # place of each text's end token


def tokens_of(raw: np.ndarray, offsets: np.ndarray) -> Tokens:
    """All tokens of a buffer of texts. Words have an even hash, pairs an odd one."""
    low = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    begin, last = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    begin[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    first, after = np.flatnonzero(begin), np.flatnonzero(last) + 1
    upto = np.searchsorted(first, offsets[1:])  # words before the end of each text
    ends = upto + np.arange(len(upto))
    words = np.full(len(first) + len(upto), END, np.uint64)
    is_word = np.ones(len(words), bool)
    is_word[ends] = False
    if len(first):
        words[is_word] = hash_spans(low, first, after)
    words &= ~np.uint64(1)
    before = np.concatenate(([END & ~np.uint64(1)], words[:-1])).astype(np.uint64)
    return Tokens(words, mix(words + ROLL * mix(before)) | np.uint64(1), ends)


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def packed(x: np.ndarray) -> bytes:
    """Whole numbers by planes of bytes, each compressed by itself."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    out = [pa.compress(p.tobytes(), codec="zstd", asbytes=True) if p.any() else b"" for p in planes]
    return np.array([len(x), *map(len, out)], "<u4").tobytes() + b"".join(out)


def unpacked(b: bytes) -> np.ndarray:
    n, *sizes = np.frombuffer(b, "<u4", 9).tolist()
    out, at = np.zeros((n, 8), np.uint8), 36
    for k, size in enumerate(sizes):
        if size:
            out[:, k] = np.frombuffer(pa.decompress(b[at : at + size], decompressed_size=n, codec="zstd", asbytes=True), np.uint8)
        at += size
    return out.view("<i8").ravel()


def sent(grams: np.ndarray, bins: int) -> bytes:
    """Ascending grams of one bin, of which there are some: the first, and the differences."""
    codes = (grams >> 1) // bins * 2 + (grams & 1)
    return codes[:1].tobytes() + packed(np.diff(codes))


def received(b: bytes, bin: int, bins: int) -> np.ndarray:
    codes = np.cumsum(np.append(np.frombuffer(b, "<i8", 1), unpacked(b[8:])))
    return ((codes >> 1) * bins + bin) * 2 + (codes & 1)


def dealt(grams: np.ndarray, bins: int, some: int = 64) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Ascending grams, dealt to bins: (bin, places of its grams) of those that have any, some at a time."""
    of = ((grams >> 1) % bins).astype(np.min_scalar_type(bins))  # small numbers are sorted faster
    order = np.argsort(of, kind="stable")
    first = np.flatnonzero(np.append(True, of[order[1:]] != of[order[:-1]])[: len(order)])
    ends = np.append(first[1:], len(order))
    for i in range(0, len(first), some):
        yield [(int(of[order[a]]), order[a:b]) for a, b in zip(first[i : i + some], ends[i : i + some])]


def combined(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different grams, ascending, and their counts."""
    grams = np.concatenate([np.zeros(0, np.uint64), *grams]).view(np.int64)
    grams.sort()
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
    return grams[first], np.diff(np.append(first, len(grams)))


def chunked(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of documents, cut and put together to about `most` bytes."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            held.append(part)
            size += part.nbytes
            if size > most:
                yield held
                held, size = [], 0
    if held:
        yield held


def gram_counts(docs: DataFrame, bins: int) -> DataFrame:
    """Words and pairs with their counts: one row per bin and chunk."""
    most = CHUNK

    def run(batches):
        for chunk in chunked(batches, most):
            grams, n = combined([g for x in chunk for g in tokens_of(*text_buffers(x.column(0)))[:2]])
            for some in dealt(grams, bins):
                yield record_batch([(k, sent(grams[mine], bins), packed(n[mine])) for k, mine in some], GRAMS)

    return docs.select("text").transform(batched, run, GRAMS)


def spots(grams: np.ndarray, step: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (gram, step): the block of 512 bits that holds all its bits, and a number with 9 bits for each of them."""
    h = mix(grams + np.uint64(step * int(ROLL) % (1 << 64)))
    return ((h >> np.uint64(32)) * blocks) >> np.uint64(32), mix(h)


def made_part(grams: np.ndarray, levels: np.ndarray, each: int = BITS) -> bytes:
    """A part of the filter: `each` bits for an entry."""
    blocks = max(1, -(-int(levels.sum()) * each // 512))
    bits = np.zeros(512 * blocks, bool)
    for step in range(1, int(levels.max(initial=0)) + 1):
        block, where = spots(grams[levels >= step], step, np.uint64(blocks))
        for probe in range(PROBES):
            bits[block * np.uint64(512) + (where >> np.uint64(9 * probe) & np.uint64(511))] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _met(sent: list[bytes], bin: int, bins: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different grams of a bin, ascending, and the places of each chunk's grams."""
    found = [received(b, bin, bins) for b in sent]
    grams, _ = combined([x.view(np.uint64) for x in found])
    return grams, [np.searchsorted(grams, x) for x in found]


def _counted(rows: pa.Table, bin: int, bins: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Grams and places of a bin, and the grams' counts."""
    grams, places = _met(rows["grams"].to_pylist(), bin, bins)
    n = np.zeros(len(grams), np.int64)
    for at, counts in zip(places, rows["n"].to_pylist()):
        n[at] += unpacked(counts)  # a chunk has a gram once
    return grams, places, n


def _made(bin: int, grams: np.ndarray, n: np.ndarray, parts: int, bins: int, bits: int) -> list[tuple]:
    """Rows of the model's table from a bin's grams and counts."""
    of, levels, is_word, out = (grams >> 1) % parts, level(n), grams & 1 == 0, []
    for part in np.unique(of).tolist():
        mine = of == part
        words = mine & is_word
        held = (sent(grams[words], bins), packed(n[words])) if words.any() else (None, None)
        out.append((part, bin, *held, made_part(grams[mine].view(np.uint64), levels[mine], bits), int(n[words].sum()), int(words.sum()), int((mine & ~is_word).sum()), np.bincount(levels[words]).tolist()))
    return out


def _dealing(spark: SparkSession, parts: int | None) -> tuple[int, int]:
    """Parts of the filter, and the bins that tasks take them by."""
    p = partitions(spark)
    parts = parts or 4 * p
    return parts, parts if parts % p else p


def learn(docs: DataFrame, parts: int | None = None, bits: int = BITS) -> DataFrame:
    """The model as a table: a row per part, with its words and their counts, its part of the filter and its sums."""
    parts, bins = _dealing(docs.sparkSession, parts)

    def made(key, rows):
        bin = key[0].as_py()
        grams, _, n = _counted(rows, bin, bins)
        out = record_batch(_made(bin, grams, n, parts, bins, bits), MODEL)
        give_back()
        return pa.Table.from_batches([out])

    model = gram_counts(docs, bins).groupBy("bin").applyInArrow(made, MODEL)
    return handover(model.withColumns({"parts": F.lit(parts), "bins": F.lit(bins)}), "lm")


class Model(NamedTuple):
    table: DataFrame
    parts: int
    tokens: int
    types: int
    beta: float
    filter_bytes: int
    bins: int


def followers(histogram: list[int], pairs: int) -> float:
    """The exponent beta at which c ** beta, over all words, sums up to the number of different pairs."""
    n, c = np.array(histogram[1:], float), MIDDLE[1 : len(histogram)]
    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if (n * c**mid).sum() < pairs else (low, mid)
    return high


def summed(rows: DataFrame) -> Model:
    """The model's sums: one row per part of the filter, without its bits."""
    found = rows.select("parts", "bins", "tokens", "types", "pairs", "histogram", F.octet_length("bits").alias("size")).collect()
    histogram = np.zeros(len(MIDDLE), np.int64)
    for r in found:
        histogram[: len(r.histogram)] += np.array(r.histogram, np.int64)
    sums = {k: sum(r[k] for r in found) for k in ("tokens", "types", "pairs", "size")}
    return Model(rows, found[0].parts if found else 1, sums["tokens"], sums["types"], followers(histogram.tolist(), sums["pairs"]), sums["size"], found[0].bins if found else 1)


class Filter:
    """Some or all parts of the filter in one buffer."""

    def __init__(self, parts: int, bits: dict[int, bytes]):
        self.parts = parts
        self.blocks = np.ones(parts, np.uint64)
        self.at = np.zeros(parts, np.int64)
        at = 64  # a part without grams is a block without bits
        for k, b in sorted(bits.items()):
            self.blocks[k], self.at[k] = len(b) // 64, at
            at += len(b)
        self.raw = np.frombuffer(b"".join([bytes(64), *(b for _, b in sorted(bits.items()))]), np.uint8)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Of each gram: the steps that are in the filter, from the first to the one before the first that is missing."""
        out = np.zeros(len(grams), np.int64)
        part = (grams.view(np.int64) >> 1) % self.parts
        base, blocks = self.at[part], self.blocks[part]
        left = np.arange(len(grams))
        for step in range(1, len(MIDDLE)):
            block, where = spots(grams[left], step, blocks[left])
            at = base[left] + (block << np.uint64(6)).astype(np.int64)
            for probe in range(PROBES):
                bit = (where >> np.uint64(9 * probe)).astype(np.int64) & 511
                there = np.flatnonzero(self.raw[at + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1)
                if len(there) < len(left):
                    left, at, where = left[there], at[there], where[there]
            if not len(left):
                break
            out[left] = step
        return out


def log_probabilities(t: Tokens, word: np.ndarray, pair: np.ndarray, model: Model) -> np.ndarray:
    """log10 p of each token, from the filter's counts of words and pairs."""
    before = np.concatenate((word[t.ends[:1]], word[:-1]))  # the end token stands before the first word
    pair = np.minimum(pair, before)
    alone = (word + 1) / (model.tokens + model.types + 1)
    s = np.where(before > 0, before, 1) ** model.beta
    return np.log10(np.where(before > 0, (pair + s * alone) / (before + s), alone))


def words_of(bins: int, found: Iterable[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words and their counts of parts of the model (bin, words, counts), ascending."""
    words, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for bin, w, c in found:
        if w is not None:
            words.append(received(w, bin, bins))
            counts.append(unpacked(c))
    words, counts = np.concatenate(words), np.concatenate(counts)
    order = np.argsort(words)
    return words[order], counts[order]


def word_counts(model: Model) -> DataFrame:
    """gram, c of each word."""
    bins = model.bins

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in words_of(bins, zip(*(x.to_pylist() for x in batch.columns)))], names=["gram", "c"])

    return model.table.select("bin", "words", "counts").transform(batched, run, "gram long, c long")


def _flat(docs: DataFrame, model: Model, hot: tuple[np.ndarray, np.ndarray], filter: Filter) -> DataFrame:
    """Per document one row with what is known by now, and a row for each of its words that is not hot."""
    shared = docs.sparkSession.sparkContext.broadcast((hot, filter))
    plain = model._replace(table=None)
    total = plain.tokens + plain.types + 1

    def run(batches):
        (grams, counts), bloom = shared.value

        def count(asked):
            distinct, back = np.unique(asked, return_inverse=True)
            return MIDDLE[bloom.levels(distinct)[back]]

        for batch in batches:
            for part in slices(batch, "text"):
                row, doc_id, held = (part.column(i) for i in (0, 1, 2))
                t = tokens_of(*text_buffers(part.column(3)))
                starts = np.concatenate(([0], t.ends[:-1] + 1))
                of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(t.words))))
                by_text = lambda x: np.add.reduceat(x, starts)
                score = by_text(log_probabilities(t, count(t.words), count(t.pairs), plain))
                words = t.words.view(np.int64)
                at = np.minimum(np.searchsorted(grams, words), max(0, len(grams) - 1))
                is_hot = grams[at] == words if len(grams) else np.zeros(len(words), bool)
                c = np.where(is_hot, counts[at] if len(grams) else 0, 0)
                known, base = by_text(is_hot.astype(np.int64)), by_text(np.where(is_hot, np.log10((c + 1) / total), 0.0))
                key = (mix(np.array(row).view(np.uint64)) | np.uint64(1)).view(np.int64)  # no word has an odd hash
                n = np.diff(np.append(starts, len(t.words)))
                yield _batch(np.array(row), key, np.zeros(len(n), np.int64), doc_id, held, n, known, base, score)
                rest = np.flatnonzero(~is_hot)
                order = rest[np.lexsort((words[rest], of[rest]))]
                new = np.append(True, (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])) if len(order) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                for i in range(0, len(first), 1 << 16):
                    f = order[first[i : i + (1 << 16)]]
                    yield _batch(np.array(row)[of[f]], words[f], times[i : i + (1 << 16)])

    return docs.transform(batched, run, FLAT)


def _batch(*columns) -> pa.RecordBatch:
    names = [x.split()[0] for x in FLAT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays + [pa.nulls(len(arrays[0]), t) for t in types[len(arrays) :]], names=names)


def _chunks(docs: DataFrame) -> DataFrame:
    """docs by chunks, compressed: chunk (its place and what it holds), docs."""
    most = CHUNK

    def run(batches):
        for chunk in chunked(batches, most):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, chunk[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for x in chunk:
                    stream.write_batch(x)
            yield record_batch([(out.getvalue().to_pybytes(),)], "docs binary")

    return docs.transform(batched, run, "docs binary").select(F.xxhash64(F.monotonically_increasing_id(), "docs").alias("chunk"), "docs")


def _asks(chunks: DataFrame, bins: int, learning: bool) -> DataFrame:
    """The different grams of each chunk, dealt to bins; n: how often they are in its training texts, if that is asked for."""

    def run(batches):
        for batch in batches:
            for chunk, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                kept, rest = [], []
                for x in pa.ipc.open_stream(texts.as_buffer()):
                    t = tokens_of(*text_buffers(x.column("text")))
                    held = np.repeat(np.array(x.column("held_out")), np.diff(t.ends, prepend=-1)) if learning else np.zeros(len(t.words), bool)
                    kept += [t.words[~held], t.pairs[~held]]
                    rest += [t.words[held], t.pairs[held]]
                grams, n = learnt, counts = combined(kept)
                if learning:
                    grams, _ = combined([learnt.view(np.uint64), combined(rest)[0].view(np.uint64)])
                    n = np.zeros(len(grams), np.int64)
                    n[np.searchsorted(grams, learnt)] = counts
                for some in dealt(grams, bins):
                    yield record_batch([(chunk, k, sent(grams[mine], bins), packed(n[mine]) if learning else None) for k, mine in some], ASKS)

    return chunks.transform(batched, run, ASKS)


def _answers(bin: int, chunks: list[int], grams: np.ndarray, places: list[np.ndarray], bloom: Filter, n: np.ndarray) -> list[tuple]:
    """Of each chunk's grams: their levels in the filter, and the exact counts of the words among them."""
    some = np.array_split(grams.view(np.uint64), 1 + len(grams) // (1 << 18))  # probing takes ten times their memory
    levels, is_word = np.concatenate([bloom.levels(x) for x in some]), grams & 1 == 0
    return [(chunk, bin, packed(levels[at]), packed(n[at[is_word[at]]])) for chunk, at in zip(chunks, places)]


def _scored(chunks: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Scores of chunks that have got their answers."""
    bins, plain = model.bins, model._replace(table=None)
    total = plain.tokens + plain.types + 1

    def run(key, chunk, answers):
        if chunk.num_rows != 1:
            raise ValueError("the documents were read in another order the second time: pass a table or a checkpoint")
        texts = list(pa.ipc.open_stream(chunk["docs"][0].as_buffer()))
        tokens = [tokens_of(*text_buffers(x.column("text"))) for x in texts]
        grams, _ = combined([g for t in tokens for g in t[:2]])
        is_word, places = grams & 1 == 0, dict(x for some in dealt(grams, bins) for x in some)
        if answers.num_rows != len(places):
            raise ValueError("the documents were read in another order the second time: pass a table or a checkpoint")
        middle, exact, out = np.zeros(len(grams)), np.zeros(len(grams), np.int64), []
        for bin, levels, known in zip(*(answers[x].to_pylist() for x in ("bin", "levels", "known"))):
            mine = places[bin]
            middle[mine] = MIDDLE[unpacked(levels)]
            exact[mine[is_word[mine]]] = unpacked(known)
        base = np.log10((exact + 1) / total)
        for x, t in zip(texts, tokens):
            (words, word), (pairs, pair) = (np.unique(g.view(np.int64), return_inverse=True) for g in t[:2])
            words, pairs = np.searchsorted(grams, words), np.searchsorted(grams, pairs)  # ascending ones are found fast
            starts = np.concatenate(([0], t.ends[:-1] + 1))
            by_text = lambda x: np.add.reduceat(x, starts)
            score = by_text(log_probabilities(t, middle[words][word], middle[pairs][pair], plain))
            sums = [np.diff(t.ends, prepend=-1), by_text((exact[words] > 0).astype(np.int64)[word]), np.full(len(starts), plain.tokens), by_text(base[words][word]), score]
            out.append(pa.RecordBatch.from_arrays([x.column("doc_id"), x.column("held_out"), *map(pa.array, sums)], names=[f.split()[0] for f in SCORES.split(", ")]))
        give_back()
        return pa.Table.from_batches(out)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, SCORES)


def _by_parts(docs: DataFrame, model: Model) -> DataFrame:
    """Scores, where the filter and the word counts are asked where they lie."""
    parts, bins = model.parts, model.bins

    def run(key, asks, held):
        bin, held = key[0].as_py(), held.to_pydict()
        grams, places = _met(asks["grams"].to_pylist(), bin, bins)
        words, counts = words_of(bins, zip(held["bin"], held["words"], held["counts"]))
        n = np.zeros(len(grams), np.int64)
        if len(words):
            at = np.minimum(np.searchsorted(words, grams), len(words) - 1)
            n = np.where(words[at] == grams, counts[at], 0)
        out = record_batch(_answers(bin, asks["chunk"].to_pylist(), grams, places, Filter(parts, dict(zip(held["part"], held["bits"]))), n), ANSWERS)
        give_back()
        return pa.Table.from_batches([out])

    chunks, held = _chunks(docs), model.table.select("part", "bin", "words", "counts", "bits")
    answers = _asks(chunks, bins, False).groupBy("bin").cogroup(held.groupBy("bin")).applyInArrow(run, ANSWERS)
    return _scored(chunks, answers, model)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def learn_and_score(docs: DataFrame, parts: int | None = None, bits: int = BITS) -> tuple[Model, DataFrame]:
    """The model of the rows that are not held out, and the scores of all: learn() and score() with one shuffle of the grams."""
    parts, bins = _dealing(docs.sparkSession, parts)
    both = f"{MODEL}, chunk long, levels binary, known binary"
    names = [x.split()[0] for x in MODEL.split(", ")]

    def run(key, rows):
        bin = key[0].as_py()
        grams, places, n = _counted(rows, bin, bins)
        made = _made(bin, grams[n > 0], n[n > 0], parts, bins, bits)
        answers = _answers(bin, rows["chunk"].to_pylist(), grams, places, Filter(parts, {x[0]: x[names.index("bits")] for x in made}), n)
        blank = (None,) * (len(names) - 2)
        out = record_batch([(*x, None, None, None) for x in made] + [(None, bin, *blank, chunk, levels, known) for chunk, _, levels, known in answers], both)
        give_back()
        return pa.Table.from_batches([out])

    chunks = _chunks(_documents(docs))
    made = _asks(chunks, bins, True).groupBy("bin").applyInArrow(run, both)
    made = handover(made.withColumns({"parts": F.lit(parts), "bins": F.lit(bins)}), "lm")
    model = summed(made.filter("part is not null"))
    model = model._replace(parts=parts, bins=bins)
    return model, _scored(chunks, made.filter("part is null").select("chunk", "bin", "levels", "known"), model)


def score(docs: DataFrame, model: Model, most_broadcast: int = MOST_BROADCAST, hot_share: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row. docs: doc_id, text, held_out."""
    rows = _documents(docs)
    if model.filter_bytes > most_broadcast:
        return _by_parts(rows, model)
    least = model.tokens / hot_share
    counts = word_counts(model)
    hot = sorted(tuple(r) for r in counts.filter(F.col("c") >= least).collect())  # at most hot_share words have a share of 1 / hot_share
    hot = (np.array([g for g, _ in hot], np.int64), np.array([c for _, c in hot], np.int64))
    bloom = Filter(model.parts, {r.part: bytes(r.bits) for r in model.table.select("part", "bits").toLocalIterator()})
    flat = _flat(rows.select(F.monotonically_increasing_id().alias("row"), "*"), model, hot, bloom).join(counts.filter(F.col("c") < least), "gram", "left")
    c = F.coalesce("c", F.lit(0))
    head = F.max(F.when(F.col("n_tokens").isNotNull(), F.struct("n_tokens", "doc_id", "held_out", "known", "base", "score")))
    rare = F.sum(F.when(F.col("n_tokens").isNull(), F.col("n") * F.log10((c + 1) / F.lit(model.tokens + model.types + 1))).otherwise(0.0))
    sums = flat.groupBy("row").agg(head.alias("h"), rare.alias("rare"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"))
    return sums.select("h.doc_id", "h.held_out", "h.n_tokens", (F.col("h.known") + F.col("more")).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("h.base") + F.col("rare")).alias("base_score"), "h.score")


def op13_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return learn_and_score(docs)[1]
