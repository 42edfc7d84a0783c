"""Benchmark decontamination with a generalised suffix automaton over words.

The words of all benchmark items are the letters of one suffix automaton. A
document's words are streamed through it; the state tells the longest match that
ends at each word. Where the match is `window` words or longer, a window of some
item ends there and those words are hit; an item shorter than a window counts
where it occurs whole. Each state knows the items of its windows, so nothing is
looked up per item.

Size: an automaton is made of at most `shard_words` item words, which bounds what
the driver builds (some 700 bytes a word while it grows) and broadcasts (some 150).
Larger benchmarks are dealt by item into more shards, one alive at a time: documents
are scanned once per shard, always whole, the hits so far are handed over as a table
and united with the next. Coverage is judged and text cut once, on the union.

Documents are read in narrow passes: no shuffle. Null or empty
texts have no words; null items and items without words are ignored; items that
share an item_id count once, those with a null item_id mark hits but are not
counted. Rows that share a doc_id are all returned. Other columns are ignored by
`contamination` and kept by `decontaminate`, whatever their names. Empty tables of
documents give no rows; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, batched, free_name, handover, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_LOWER = str.maketrans(UPPER, LOWER)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(TO_LOWER)) if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, ready for window search."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int = 10):
        self.window = window
        self.next: list[dict[str, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[tuple[int, int, int]] = []  # (state, item, whole length if the item is short)
        for k, (_, words) in enumerate(items):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                if i + 1 >= window:
                    ends.append((last, k, 0))
            if 0 < len(words) < window:
                ends.append((last, k, len(words)))
        self._mark(items, ends)

    def _extend(self, last: int, w: str) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: str) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _mark(self, items, ends) -> None:
        """at[s]: items with a window that ends where s ends; short[s]: (length, item) of short items that are suffixes of s."""
        own: dict[int, set[int]] = {}
        short: dict[int, set[tuple[int, int]]] = {}
        for s, k, m in ends:
            if m:
                while self.len[self.link[s]] >= m:
                    s = self.link[s]
                short.setdefault(s, set()).add((m, k))
            else:
                while self.len[self.link[s]] >= self.window:
                    s = self.link[s]
                own.setdefault(s, set()).add(k)
        self.names = [None if i is None else str(i) for i, _ in items]
        self.found: list[tuple[int, ...]] = [()]  # sets of items, and which of them holds for a state
        self.at = array("i", [0]) * len(self.next)
        self.short: dict[int, tuple[tuple[int, int], ...]] = {}
        for s in sorted(range(1, len(self.next)), key=self.len.__getitem__):  # links first
            up = self.link[s]
            if self.len[s] >= self.window:
                if self.len[up] < self.window and s in own:
                    self.found.append(tuple(own[s]))
                    self.at[s] = len(self.found) - 1
                else:
                    self.at[s] = self.at[up]
            if both := (*self.short.get(up, ()), *short.get(s, ())):
                self.short[s] = both
        self._pack()

    def _pack(self) -> None:
        """Most states have one way on: it is kept in arrays, and only the others keep a dict."""
        self.root = self.next[0]
        self.word: list[str | None] = [None] * len(self.next)
        self.to = array("i", [0]) * len(self.next)
        self.more: dict[int, dict[str, int]] = {}
        for s, ways in enumerate(self.next):
            if s and len(ways) == 1:
                ((self.word[s], self.to[s]),) = ways.items()
            elif s and ways:
                self.more[s] = ways
        self.link, self.len = array("i", self.link), array("i", self.len)
        del self.next

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [begin, end) of hit words, in order and apart, and the items found."""
        word, on, more, root, link, length = self.word, self.to, self.more, self.root, self.link, self.len
        window, short, none = self.window, self.short, {}
        state = match = 0
        spans: list[list[int]] = []
        found: set[int] = set()
        for i, w in enumerate(words):
            to = 0
            while state:
                if word[state] == w:
                    to = on[state]
                    break
                if to := more.get(state, none).get(w, 0):
                    break
                state = link[state]
                match = length[state]
            to = to or root.get(w, 0)
            if not to:
                continue
            state, match = to, match + 1
            begin = i + 1
            if match >= window:
                found.add(self.at[state])
                begin = i + 1 - window
            if state in short:
                for m, k in short[state]:
                    if m <= match:
                        found.add(-1 - k)
                        begin = min(begin, i + 1 - m)
            if begin <= i:
                while spans and begin <= spans[-1][1]:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, i + 1])
        items = {k for f in found for k in ((-1 - f,) if f < 0 else self.found[f])}
        return [(a, b) for a, b in spans], items


def automata(benchmark: DataFrame, window: int = 10, shard_words: int = 500_000) -> Iterator[SuffixAutomaton]:
    """One automaton per shard of at most about shard_words words of items."""
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).filter("text is not null")
    size = items.agg(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))).alias("n")).first().n or 0
    shards = max(1, -(-size // shard_words))
    for k in range(shards):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).collect()  # bounded: see shard_words
        yield SuffixAutomaton([(r.item_id, w) for r in rows if (w := words_of(r.text))], window)


def united(spans: list[list[int]]) -> list[tuple[int, int]]:
    """Union of flat span lists."""
    out: list[list[int]] = []
    for a, b in sorted((x[i], x[i + 1]) for x in spans for i in range(0, len(x), 2)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def scanned(automaton: SuffixAutomaton, batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per row of a batch: words, spans and items, united with those of the shards before, if the batch has any."""
    column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
    _, spans_name, items_name = names
    before = spans_name in column
    for k, text in enumerate(column["text"]):
        words = words_of(text.as_py())
        spans, found = automaton.scan(words)
        items = {automaton.names[i] for i in found if automaton.names[i] is not None}
        if before:
            spans = united([column[spans_name][k].as_py(), [x for span in spans for x in span]])
            items.update(column[items_name][k].as_py())
        yield len(words), spans, sorted(items)


def find_hits(docs: DataFrame, automaton, names: list[str], keep: list[str]) -> DataFrame:
    """The columns `keep` of docs, then number of words, spans (begin, end of hit words) and items under three `names`.

    `automaton` is broadcast.
    """
    types = (T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType()))
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(n, t) for n, t in zip(names, types))])

    def run(batches):
        for batch in batches:
            n, spans, items = [], [], []
            for words, found, told in scanned(automaton.value, batch, names):
                n.append(words)
                spans.append([x for span in found for x in span])
                items.append(told)
            arrays = [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *arrays], names=[*keep, *names])

    return docs.transform(batched, run, schema)


def all_hits(docs: DataFrame, benchmark: DataFrame, window: int, shard_words: int, names: list[str], last) -> DataFrame:
    """Scan shard by shard, and `last`(docs, automaton) with the last one. One automaton is alive at a time."""
    context, held = docs.sparkSession.sparkContext, None
    every = docs.columns
    for automaton in automata(benchmark, window, shard_words):
        if held is not None:
            docs = handover(find_hits(docs, held, names, every), "hits")
            held.destroy()
        held = context.broadcast(automaton)
    return last(docs, held)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 500_000) -> DataFrame:
    """doc_id, n_words, spans, items of every document row."""
    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    names = ["n_words", "spans", "items"]
    return all_hits(base, benchmark, window, shard_words, names, lambda df, a: find_hits(df, a, names, ["doc_id"]))


def hit_words(spans: str):
    """Number of words in a column of flat spans."""
    index = F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2))
    none = F.lit(0).cast("long")
    return F.when(F.size(spans) > 0, F.aggregate(index, none, lambda a, i: a + F.get(spans, i + 1) - F.get(spans, i))).otherwise(none)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of contamination()."""
    return found.select(
        "doc_id",
        "n_words",
        hit_words("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """Text without the words of the spans and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.translate(TO_LOWER))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, shard_words: int = 500_000) -> DataFrame:
    """Documents without benchmark spans; a document of which they cover more than max_coverage of the words goes.

    All columns stay; text (and n_chars, if there) follow the cut. Text between the kept words is untouched.
    """
    names = [free_name(n, docs.columns) for n in ("n_words", "spans", "items")]
    columns, schema = docs.columns, docs.schema

    def last(df, automaton):
        def run(batches):
            for batch in batches:
                column = {c: batch.column(batch.schema.get_field_index(c)) for c in columns}
                rows, cuts = [], {}
                for k, (words, spans, _) in enumerate(scanned(automaton.value, batch, names)):
                    if sum(b - a for a, b in spans) <= max_coverage * words:
                        if spans:
                            cuts[len(rows)] = without_spans(column["text"][k].as_py(), spans)
                        rows.append(k)
                kept = {c: x.take(pa.array(rows, pa.int64())) for c, x in column.items()}
                if cuts:
                    text = kept["text"].to_pylist()
                    for k, t in cuts.items():
                        text[k] = t
                    kept["text"] = pa.array(text, column["text"].type)
                    if "n_chars" in kept:
                        size = kept["n_chars"].to_pylist()
                        for k, t in cuts.items():
                            size[k] = len(t)
                        kept["n_chars"] = pa.array(size, column["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(kept.values()), names=columns)

        return df.transform(batched, run, schema)

    return all_hits(docs, benchmark, window, shard_words, names, last)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, {WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, range(1, greatest(len(w) - 10, 0) + 2) t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT m FROM win),
occ AS (
  SELECT d.r, i, s.m, array_to_string(d.w[i:i + s.m - 1], ' ') AS g
  FROM d, sizes s, range(1, greatest(len(d.w) - s.m + 1, 0) + 1) t(i)
),
hits AS (SELECT r, i, o.m, item FROM occ o JOIN win USING (m, g)),
pos AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, range(0, m) t(k) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
