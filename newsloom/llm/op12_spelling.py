"""Spelling variants by a rare-first q-gram prefix filter.

Words are runs of letters over all whole texts; two are near if one inserted, deleted or
replaced code point parts them. One edit destroys two of a word's bigrams at most, so if all
words order their bigrams alike (by how many words' places hold the bigram, then by the
bigram, then by place), the first bigram that survives the edit is among the three first of
both words, at the same place or one place further in the longer word. Words are joined on
their three rarest bigrams only, with these place limits.

The join's key holds more than the bigram and its place. The edit lies left or right of a
surviving bigram, so the other side is equal; and of the side with the edit the half without
it is. Each bigram gives up to four keys (edit left or right, in the near or far half), for
words of the same length, for the shorter and for the longer word of a pair. Keys are 64-bit
hashes: a false meeting falls to the check of each pair (edit distance of 1). None is capped:
a group's pairs are what the filter leaves to check.

Shuffles: words and counts (combined before), keys of words (about 30 rows a word; the
vocabulary grows slower than the texts), pairs found, then near words by word. The bigram
counts are at most the square of the alphabet's letters (90 * 90) and go to all tasks.

Null and empty texts have no words; a null doc_id is an empty string in the sampling of
damaged words (`damaged`); repeated rows count as often as they stand there. Empty table:
no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SQL_CRC, UPPER, batched, handover, sql_crc32, table

# What is a letter, and the least length of a word.
LETTERS, LEAST = "[A-Za-z\\u00C0-\\u00FF]", 7
#: A form is this often as frequent at least.
TIMES = 10
KEYS = "key long, second boolean, word string, n long"


def _lower(run: Column) -> Column:
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def damaged(doc_id: Column, run: Column, every: int = 31) -> Column:
    """The run, without one code point where the crc32 of `doc_id:run` is divided by `every`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, spoil: bool = False, least: int = LEAST, twice: int = 2) -> DataFrame:
    """word, n: runs of letters, A-Z lower-cased, of `least` code points and `twice` occurrences at least. `spoil`: some lose a letter."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run"))  # what is shorter can't be a word
    runs = runs.select("doc_id", _lower(F.col("run")).alias("run"))
    word = damaged(F.col("doc_id"), F.col("run")) if spoil else F.col("run")
    return runs.select(word.alias("word")).filter(F.char_length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= twice)


def bigram_ranks(words: DataFrame) -> dict[str, int]:
    """Place of each bigram in order of how many places of words hold it; at most the square of the alphabet."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    counts = words.select(F.explode(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("c"))
    return {b: i for i, (b, _) in enumerate(sorted(map(tuple, counts.collect()), key=lambda x: (x[1], x[0])))}


def rarest(word: str, ranks: dict[str, int], most: int = 3) -> list[int]:
    """Places of the word's rarest bigrams."""
    return [i for _, i in sorted((ranks[word[i : i + 2]], i) for i in range(len(word) - 1))[:most]]


def keys_of(word: str, at: int, shorter: int, shift: bool, equal: bool) -> Iterator[tuple]:
    """Keys of a surviving bigram at `at`, for a pair whose shorter word has `shorter` letters.

    `shift`: the edit lies left of the bigram (and a longer word has one letter more there), else right.
    Either half of the shorter word's side may be the one that is left alone.
    """
    n = len(word)
    side = at - (n - shorter) if shift else shorter - at - 2
    if side < 0 or (equal and side == 0):
        return
    half = side // 2
    if shift:
        yield ("l", shorter, side, word[:half], word[at:])
        if half:
            yield ("L", shorter, side, word[at - (side - half) :])
    else:
        yield ("r", shorter, at, word[: at + 2 + half])
        if half:
            yield ("R", shorter, at, word[: at + 2], word[n - (side - half) :])


def all_keys(word: str, ranks: dict[str, int]) -> Iterator[tuple[tuple, bool]]:
    """(key, whether the word is the second of a pair): as one of two of equal length, as the shorter, as the longer."""
    n = len(word)
    for at in rarest(word, ranks):
        for shift in (False, True):
            for key in keys_of(word, at, n, shift, True):
                yield (0, *key), False
                yield (0, *key), True
            for key in keys_of(word, at, n, shift, False):
                yield (1, *key), False
            for key in keys_of(word, at, n - 1, shift, False):
                yield (1, *key), True


def word_keys(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """key, second, word, n: the keys of each word, once as the first of a pair and once as the second."""
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        import xxhash

        digest, known = xxhash.xxh3_64_intdigest, shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                key, role, word, count = [], [], [], []
                for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    met = {(digest("\0".join(map(str, k))) - (1 << 63), second) for k, second in all_keys(w, known)}
                    for k, second in met:
                        key.append(k)
                        role.append(second)
                    word += [w] * len(met)
                    count += [n] * len(met)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(role, pa.bool_()), pa.array(word, pa.string()), pa.array(count, pa.int64())], names=["key", "second", "word", "n"])

    return words.select("word", "n").transform(batched, run, KEYS)


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: words one edit apart, each pair once. `words` (word, n) is read twice."""
    keys = word_keys(words, bigram_ranks(words))
    first, second = (keys.filter(F.col("second") == side).select("key", F.col("word").alias(x), F.col("n").alias(f"n_{x}")) for side, x in ((False, "a"), (True, "b")))
    apart = (F.char_length("a") < F.char_length("b")) | (F.col("a") < F.col("b"))
    met = first.join(second, "key").filter(apart & (F.levenshtein("a", "b", 1) == 1))
    return met.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of words (word, n), which is read several times."""
    pairs = near_pairs(words)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), "near"))  # the most frequent, of these the first
    near = pairs.select(F.explode(both).alias("p")).select("p.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    form = F.when(-F.col("best.m") >= times * F.col("n"), F.col("best.near"))
    out = handover(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.m")).alias("form_n")), "spelling")
    most = out.agg(F.max("n")).first()[0] or 1
    links = out.filter("form is not null").select("word", F.col("form").alias("root"))
    steps, reach = 0, 1
    while times**steps <= most:  # a chain is no longer than the counts can grow
        steps += 1
    while reach < steps:
        links, reach = links.join(links.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root")), reach * 2
    return out.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(handover(word_counts(table(spark, sf_dir, "documents"), spoil=True), "words"))


SQL = rf"""
WITH RECURSIVE {SQL_CRC},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(r, '{UPPER}', '{LOWER}') AS run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{{LEAST},}}')) AS r FROM documents)),
hashed AS (SELECT run, {sql_crc32("id || ':' || run")} AS h FROM runs, crc),
spoilt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
v AS (SELECT word, count(*) AS n FROM spoilt WHERE length(word) >= {LEAST} GROUP BY word HAVING count(*) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.rest
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.rest
),
near AS (SELECT word, count(*) AS n_near, arg_min(near, (-m, near)) AS best, max(m) AS m FROM pairs GROUP BY word),
f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {TIMES} * n THEN best END AS form, CASE WHEN m >= {TIMES} * n THEN m END AS form_n FROM v LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word) r USING (word)
"""
