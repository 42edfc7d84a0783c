"""Near duplicates against a curated feed: candidate edges and their greedy resolution.

Edges come from three rules: same canonical URL; same-language token Jaccard of at
least SIM_TITLE; same host, less than HOST_HOURS apart and Jaccard of at least
SIM_HOST. Title edges are found by a prefix filter (tokens in ascending document
frequency, the first n - ceil(t n) + 1 of each set) over distinct token sets, host edges
by host and span of time; both are verified exactly. Alike rows may be very many, so
whether a row has one in the base, and how many, is told without pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as X
from ..session import handover


def with_tokens(items: DataFrame) -> DataFrame:
    """Adds cjk and latin token sets, canonical url and host."""
    both = lambda f: F.array_union(f(F.col("title")), F.array_union(f(F.col("title_cn")), f(F.col("title_en"))))
    return items.withColumn("zh", both(X.cjk_tokens)).withColumn("en", both(X.latin_tokens)).withColumn("canon", X.canonical_url(F.col("url"))).withColumn("host", X.host_of(F.col("url")))


def alike(percent: int, a: str = "a", b: str = "b"):
    return X.similar(F.col(f"{a}.zh"), F.col(f"{b}.zh"), percent) | X.similar(F.col(f"{a}.en"), F.col(f"{b}.en"), percent)


def url_edges(left: DataFrame, right: DataFrame) -> DataFrame:
    """pos, other: same canonical URL."""
    b = right.select(F.col("pos").alias("other"), "canon")
    return left.filter("canon <> ''").select("pos", "canon").join(b, "canon").filter("pos <> other").select("pos", "other")


PART = 16384  # rows of a meeting's right side that a task holds at once
PAIRS = 1 << 20  # pairs that are handed on at once
_MEETING = "k string, part int, left boolean, pos long, s long, before array<string>, zh array<string>, en array<string>"


class _Right:
    """Rows of the right side of one part of a meeting, by token."""

    def __init__(self, rows: list[dict]):
        self.pos = np.array([r["pos"] for r in rows], np.int64)
        self.s = np.array([r["s"] for r in rows], np.int64)
        self.sizes = {c: np.array([len(r[c] or ()) for r in rows], np.int64) for c in ("zh", "en")}
        self.at = {c: self._places(rows, c) for c in ("zh", "en", "before")}

    @staticmethod
    def _places(rows: list[dict], c: str) -> dict[str, np.ndarray]:
        at: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            for t in r[c] or ():
                at.setdefault(t, []).append(i)
        return {t: np.array(x) for t, x in at.items()}

    def alike(self, row: dict, span: int, percent: int) -> np.ndarray:
        """pos of the other rows less than `span` from a row that are alike in a language and share no token of `before`."""
        found = np.zeros(len(self.pos), bool)
        for c in ("zh", "en"):
            held = [x for t in row[c] or () if (x := self.at[c].get(t)) is not None]
            if held:
                shared = np.zeros(len(self.pos), np.int64)
                for x in held:
                    shared[x] += 1
                found |= (shared > 0) & (100 * shared >= percent * (len(row[c]) + self.sizes[c] - shared))
        for t in row["before"] or ():
            if (x := self.at["before"].get(t)) is not None:
                found[x] = False
        return self.pos[found & (np.abs(self.s - row["s"]) < span) & (self.pos != row["pos"])]


def _meet(left: DataFrame, right: DataFrame, span: int, percent: int, paired: bool) -> DataFrame:
    """pos, other of rows that meet under a key `k` and are alike; or pos, n: how many they are, where any is.

    Rows are k, pos, s, before, zh, en. The right rows of a key are dealt into parts of about PART
    rows, each part meets a copy of the key's left rows. A task holds one part; the left rows
    stream by, and pairs are handed on as they are found. A pair under several keys is
    found once for each, unless `before` tells that it was met under another.
    """
    parts = right.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    a = left.join(parts, "k").withColumn("left", F.lit(True)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    b = right.join(left.select("k").distinct(), "k", "left_semi").join(parts, "k").withColumn("left", F.lit(False)).withColumn("part", F.pmod(F.xxhash64("pos"), F.col("parts")).cast("int"))
    columns = [x.split()[0] for x in _MEETING.split(", ")]
    rows = a.select(*columns).unionByName(b.select(*columns))
    schema = "pos long, other long" if paired else "pos long, n long"

    def run(batches):
        key, held, side = None, [], None
        out, n = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if (r["k"], r["part"]) != key:
                    key, held, side = (r["k"], r["part"]), [], None
                if not r["left"]:
                    held.append(r)
                    continue
                if side is None:
                    side, held = _Right(held), []
                found = side.alike(r, span, percent)
                if len(found):
                    out.append((r["pos"], found if paired else np.array([len(found)])))
                    n += len(out[-1][1])
                if n >= PAIRS:
                    yield _pairs(out, schema)
                    out, n = [], 0
        if out:
            yield _pairs(out, schema)

    return rows.repartition("k", "part").sortWithinPartitions("k", "part", "left").mapInArrow(run, schema)


def _pairs(found: list[tuple[int, np.ndarray]], schema: str) -> pa.RecordBatch:
    first = np.repeat(np.array([p for p, _ in found], np.int64), [len(x) for _, x in found])
    return pa.RecordBatch.from_arrays([pa.array(first), pa.array(np.concatenate([x for _, x in found]))], names=[x.split()[0] for x in schema.split(", ")])


def token_classes(left: DataFrame, right: DataFrame, lang: str) -> DataFrame:
    """id, t, left, right: the distinct token sets of one language, which sides have them, and the least pos of each."""
    sides = left.select("pos", F.lit(True).alias("left"), F.lit(False).alias("right"), F.array_sort(lang).alias("t")).unionByName(right.select("pos", F.lit(False).alias("left"), F.lit(True).alias("right"), F.array_sort(lang).alias("t")))
    return sides.filter(F.size("t") > 0).groupBy("t").agg(F.min("pos").alias("id"), F.max("left").alias("left"), F.max("right").alias("right"))


def members(rows: DataFrame, classes: DataFrame, lang: str) -> DataFrame:
    """pos, id of the rows that have tokens."""
    return rows.select("pos", F.array_sort(lang).alias("t")).join(classes.select("t", "id"), "t").select("pos", "id")


def alike_classes(classes: DataFrame, percent: int) -> DataFrame:
    """id, other: token sets of the left and of the right side whose Jaccard is at least `percent` hundredths, themselves included.

    Sets meet under the tokens of their prefixes; a pair counts under the first token that both have there.
    """
    words = classes.select("id", "left", "right", "t", F.explode("t").alias("w"))
    df = words.groupBy("w").agg(F.count(F.lit(1)).alias("f"))
    n = F.size("t")
    first = n - F.ceil(n * percent / 100).cast("int") + 1
    prefix = words.select("id", "w").join(df, "w").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("o"))
    ranked = classes.join(prefix, "id").select("id", "left", "right", "t", F.slice(F.transform("o", lambda x: x["w"]), 1, first).alias("p"))
    ranked = ranked.select("*", F.posexplode("p").alias("i", "k"))
    none = F.array().cast("array<string>")
    rows = ranked.select("left", "right", "k", F.col("id").alias("pos"), F.lit(0).cast("long").alias("s"), F.slice("p", 1, F.col("i")).alias("before"), none.alias("zh"), F.col("t").alias("en"))
    other = _meet(rows.filter("left"), rows.filter("right"), 1, percent, True).select(F.col("pos").alias("id"), "other")
    return other.unionByName(classes.filter("left and right").select("id", F.col("id").alias("other")))


def title_edges(left: DataFrame, right: DataFrame, percent: int = C.SIM_TITLE) -> DataFrame:
    """pos, other: Jaccard of at least `percent` hundredths in one language. All bounds are whole numbers.

    Distinct token sets are compared, then their rows are paired.
    """
    out = None
    for lang in ("zh", "en"):
        classes = token_classes(left, right, lang)
        b = members(right, classes, lang).select(F.col("id").alias("other"), F.col("pos").alias("p2"))
        rows = alike_classes(classes, percent).join(b, "other").join(members(left, classes, lang), "id").select("pos", F.col("p2").alias("other")).filter("pos <> other")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def title_links(left: DataFrame, right: DataFrame, percent: int = C.SIM_TITLE, checkpoint=handover) -> DataFrame:
    """pos, n: of every left row, how many other right rows `title_edges` links it with; no pairs of rows are made.

    Rows alike in either language are those in the one and those in the other, less those in both.
    The latter are counted per pair of token sets: for a set of one language and each set of the
    other, how many rows have it and one like the first.
    """
    like, sets = {}, {}
    for lang in ("zh", "en"):
        sets[lang] = checkpoint(token_classes(left, right, lang))
        like[lang] = checkpoint(alike_classes(sets[lang], percent)).withColumnRenamed("other", f"{lang}2").withColumnRenamed("id", lang)

    def placed(rows):
        for lang in ("zh", "en"):
            rows = rows.join(members(rows, sets[lang], lang).withColumnRenamed("id", f"_{lang}"), "pos", "left")
        return rows.select("pos", F.col("_zh").alias("zh"), F.col("_en").alias("en"))

    a, b = checkpoint(placed(left.select("pos", "zh", "en"))), placed(right.select("pos", "zh", "en"))
    own = b.select("pos").join(left.select("pos"), "pos").withColumn("own", F.lit(1))  # rows of both sides are alike to themselves, if they have tokens
    b = checkpoint(b.groupBy("zh", "en").agg(F.count(F.lit(1)).alias("n")))
    kinds = a.select("zh", "en").distinct()
    one = {lang: like[lang].join(b.groupBy(F.col(lang).alias(f"{lang}2")).agg(F.sum("n").alias("n")), f"{lang}2").groupBy(lang).agg(F.sum("n").alias(f"n_{lang}")) for lang in ("zh", "en")}
    near = like["en"].join(b.withColumnsRenamed({"zh": "zh2", "en": "en2"}), "en2").groupBy("en", "zh2").agg(F.sum("n").alias("n"))
    both = kinds.join(like["zh"], "zh").join(near, ["en", "zh2"]).groupBy("zh", "en").agg(F.sum("n").alias("n_both"))
    whole = kinds.join(one["zh"], "zh", "left").join(one["en"], "en", "left").join(both, ["zh", "en"], "left")
    n = F.coalesce("n_zh", F.lit(0)) + F.coalesce("n_en", F.lit(0)) - F.coalesce("n_both", F.lit(0))
    whole = whole.select(F.col("zh").alias("z"), F.col("en").alias("e"), n.alias("n"))
    rows = a.join(whole, F.col("zh").eqNullSafe(F.col("z")) & F.col("en").eqNullSafe(F.col("e"))).join(own, "pos", "left")
    self_ = F.when(F.col("own").isNotNull() & (F.col("zh").isNotNull() | F.col("en").isNotNull()), 1).otherwise(0)
    return rows.select("pos", (F.col("n") - self_).alias("n"))


def _host_meeting(left: DataFrame, right: DataFrame, hours: int, percent: int, paired: bool) -> DataFrame:
    """Rows of a host meet under the six hours of the right one; the left ones come to the spans beside theirs too."""
    span = hours * 3600
    none = F.array().cast("array<string>")
    timed = lambda df: df.filter("dt is not null and host <> ''").select("host", "pos", F.unix_timestamp("dt").alias("s"), none.alias("before"), "zh", "en").withColumn("at", F.floor(F.col("s") / span))
    keyed = lambda df: df.withColumn("k", F.concat_ws(" ", "host", "at")).drop("host", "at")
    return _meet(keyed(timed(left).withColumn("at", F.explode(F.sequence(F.col("at") - 1, F.col("at") + 1)))), keyed(timed(right)), span, percent, paired)


def host_edges(left: DataFrame, right: DataFrame, hours: int = C.HOST_HOURS, percent: int = C.SIM_HOST) -> DataFrame:
    """pos, other: same host, both dated, less than `hours` apart, Jaccard of at least `percent` hundredths.

    Each pair is found once, in the span of its right row, so pairs are neither kept nor dealt again.
    """
    return _host_meeting(left, right, hours, percent, True)


def host_links(left: DataFrame, right: DataFrame, hours: int = C.HOST_HOURS, percent: int = C.SIM_HOST) -> DataFrame:
    """pos, n: how many rows `host_edges` links a left row with; rows without any are left out."""
    return _host_meeting(left, right, hours, percent, False).groupBy("pos").agg(F.sum("n").alias("n"))


REASONS = {"url": 0, "title": 1, "host_time": 2}


def edges(incoming: DataFrame, base: DataFrame) -> DataFrame:
    """pos, other, reason (least rank) between incoming rows and base or incoming rows."""
    return edges_between(incoming, base.unionByName(incoming))


def edges_between(left: DataFrame, right: DataFrame) -> DataFrame:
    """pos, other, reason (least rank) between left and right rows."""
    found = None
    for f, reason in ((url_edges, 0), (title_edges, 1), (host_edges, 2)):
        part = f(left, right).withColumn("reason", F.lit(reason))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("pos", "other").agg(F.min("reason").alias("reason"))


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, checkpoint) -> DataFrame:
    """pos, component (its least pos) of all rows in `edges` (pos, other), by large and small stars.

    Each round links what lies around a row to the least row around it: first the greater ones,
    then the lesser ones. A chain of n rows takes about log n rounds. No row gathers its
    neighbours: the least one is an aggregate, joined back.
    """
    now = checkpoint(edges.select(F.greatest("pos", "other").alias("u"), F.least("pos", "other").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        around = _neighbours(now)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        now = checkpoint(small)
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == mark:
            break
        mark = new
    least = now.groupBy(F.col("u").alias("pos")).agg(F.min("v").alias("component"))
    return least.unionByName(least.select("component").distinct().select(F.col("component").alias("pos"), "component"))


def _greedy(better: DataFrame) -> DataFrame:
    """pos of the rows that go, of better (component, pos, other, r1: conflicts of pos, of rank r1, with better rows).

    A component's conflicts stream by in order of r1: one of them drops a row if the better row
    was not dropped itself. Only the dropped rows of one component are held.
    """

    def run(batches):
        component, dropped, last = None, set(), None
        for batch in batches:
            out = []
            for c, pos, other in zip(*(x.to_pylist() for x in batch.columns)):
                if c != component:
                    component, dropped, last = c, set(), None
                if pos != last and other not in dropped:
                    dropped.add(pos)
                    out.append(pos)
                    last = pos
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["pos"])

    return better.repartition("component").sortWithinPartitions("component", "r1").select("component", "pos", "other").mapInArrow(run, "pos long")


def _by_rounds(better: DataFrame, checkpoint) -> DataFrame:
    """pos of the rows that go, in rounds: keep what has no undecided better neighbour, drop the neighbours of what is kept."""
    rows = better.select("pos").unionByName(better.select(F.col("other").alias("pos"))).distinct()
    state = checkpoint(rows.withColumn("state", F.lit("open")))
    while state.filter("state = 'open'").take(1):
        of_other = state.select(F.col("pos").alias("other"), F.col("state").alias("s2"))
        sums = better.join(of_other, "other").groupBy("pos").agg(F.max((F.col("s2") == "kept").cast("int")).alias("kept"), F.max((F.col("s2") == "open").cast("int")).alias("open"))
        new = F.when(F.col("state") != "open", F.col("state")).when(F.col("kept") == 1, "dropped").when(F.coalesce("open", F.lit(0)) == 0, "kept").otherwise("open")
        state = checkpoint(state.join(sums, "pos", "left").select("pos", new.alias("state")))
    return state.filter("state = 'dropped'").select("pos")


def resolve(ranked: DataFrame, links: DataFrame, checkpoint, most: int = 2_000_000) -> DataFrame:
    """pos, reason (null: kept). Greedy by rank: a row goes if it conflicts with the base or with a better row that is kept.

    The rule is applied in order of rank within each connected component of the conflicts among
    incoming rows, so long chains take one pass. A component of more than `most` conflicts is
    decided in rounds over all tasks. `ranked` is pos, rank (unique) of the incoming rows;
    `checkpoint` writes a table and reads it back.
    """
    inner = links.join(ranked.select("pos", F.col("rank").alias("r1")), "pos").join(ranked.select(F.col("pos").alias("other"), F.col("rank").alias("r2")), "other", "left")
    links = checkpoint(inner)
    hit = links.filter("r2 is null").select("pos").distinct()
    better = links.filter("r2 < r1").select("pos", "other", "reason", "r1", "r2")
    live = checkpoint(better.join(hit, "pos", "left_anti").join(hit.select(F.col("pos").alias("other")), "other", "left_anti"))
    placed = checkpoint(live.join(components(live.select("pos", "other"), checkpoint), "pos").select("component", "pos", "other", "r1"))
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("component")
    gone = _greedy(placed.join(sizes, "component", "left_anti"))
    if sizes.take(1):
        gone = gone.unionByName(_by_rounds(checkpoint(placed.join(sizes, "component", "left_semi")), checkpoint))
    gone = checkpoint(gone.unionByName(hit))
    lost = gone.select(F.col("pos").alias("other"))
    against = links.filter("r2 is null").select("pos", "reason").unionByName(better.join(lost, "other", "left_anti").select("pos", "reason"))
    why = against.join(gone, "pos", "left_semi").groupBy("pos").agg(F.min("reason").alias("reason"))
    return ranked.select("pos").join(why, "pos", "left").select("pos", "reason")


def hits(left: DataFrame, right: DataFrame) -> DataFrame:
    """pos, reason (least rank) of the left rows that conflict with any right row but themselves. No pairs of rows are made."""
    found = left.filter("canon <> ''").select("pos", "canon").join(right.select("canon").distinct(), "canon", "left_semi").select("pos", F.lit(0).alias("reason"))
    for lang in ("zh", "en"):
        classes = token_classes(left, right, lang)
        met = alike_classes(classes, C.SIM_TITLE).select("id").distinct()
        found = found.unionByName(members(left, classes, lang).join(met, "id", "left_semi").select("pos", F.lit(1).alias("reason")))
    found = found.unionByName(host_links(left, right).select("pos", F.lit(2).alias("reason")))
    return found.groupBy("pos").agg(F.min("reason").alias("reason"))


def deduplicate(incoming: DataFrame, base: DataFrame, ranked: DataFrame, checkpoint=handover, first: int = 2000) -> DataFrame:
    """pos, reason (null: kept): `resolve` over all edges, without making them all.

    Rows that conflict with the base go first. The others are resolved in order of rank, `first`
    rows and then four times as many each time; what conflicts with the rows kept so
    far goes before the next ones are paired, so a large group of rows that are all
    alike is paired for its best rows only. `base` and `incoming` have no row in common.
    """
    hit = checkpoint(hits(incoming, base))
    rows = checkpoint(incoming.join(ranked.select("pos", "rank"), "pos").join(hit, "pos", "left_anti"))
    kept, most = None, first
    while True:
        best = rows.select("rank").orderBy("rank").limit(most)
        end = checkpoint(best.agg(F.max("rank").alias("end"), F.count(F.lit(1)).alias("n")))
        n = end.first()["n"]
        cut = rows.crossJoin(F.broadcast(end.select("end")))
        batch = (rows if n < most else cut.filter("rank <= end").drop("end"))
        fate = resolve(batch.select("pos", "rank"), checkpoint(edges(batch, batch.limit(0))), checkpoint)
        new = checkpoint(batch.join(fate.filter("reason is null").select("pos"), "pos", "left_semi"))
        kept = new if kept is None else kept.unionByName(new)
        if n < most:
            break
        rest = checkpoint(cut.filter("rank > end").drop("end"))
        rows, most = checkpoint(rest.join(hits(rest, new).select("pos"), "pos", "left_anti")), 4 * most
    links = edges_between(incoming, kept)
    r1, r2 = ranked.select("pos", F.col("rank").alias("r1")), kept.select(F.col("pos").alias("other"), F.col("rank").alias("r2"))
    why = links.join(r1, "pos").join(r2, "other").filter("r2 < r1").select("pos", "reason").unionByName(hit)
    return ranked.select("pos").join(why.groupBy("pos").agg(F.min("reason").alias("reason")), "pos", "left")


def drop_counts(resolved: DataFrame) -> DataFrame:
    """Drops per reason, zeros included."""
    spark = resolved.sparkSession
    names = spark.createDataFrame([(v, k) for k, v in REASONS.items()], "reason int, name string")
    n = resolved.filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return names.join(n, "reason", "left").select(F.col("name").alias("reason"), F.coalesce("n", F.lit(0)).alias("n"))
