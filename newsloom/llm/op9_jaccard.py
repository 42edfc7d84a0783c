"""Exact n-gram Jaccard join with a token-group matrix.

A document's tokens are the 64-bit hashes of its distinct five-word shingles.
Two documents link when 100 * common >= 80 * united.

1. Postings. Tokens (48 bits) leave the scan as sorted, packed blobs per hash range
   ("bucket"), one row per range and scan chunk. Each chunk tells of a token how many
   of its documents have it; the documents themselves travel along only where they are
   `LISTED` at most, else their list goes straight to the chunk's own row. So a token
   that most documents have costs one entry a chunk. A task of a range counts in how
   many sets each token occurs (df) and sends back, to the chunk that holds them, the
   tokens with df > 1: every document learns which of its tokens are shared, and how
   often, from counts over all documents.
2. A document with set size n can only link if two sets meet among its
   p = n - ceil(0.8 n) + 1 rarest tokens (one global order: df, hash). If p or more
   of its tokens are its own (df = 1), it is done: no partner exists. Most
   documents end here. Overlaps need only shared tokens.
3. Groups. The rest is partitioned into groups of similar documents (same least
   hash among the document's rarer shared tokens); large groups are dealt into
   blocks of `block` documents. Inside a block, documents are compared with the
   pivots so far, one of each component that they meet being enough, never pair by
   pair; a document that links to several pivots unites their components. Pivots meet
   again across blocks and groups, under their group's key and under a second one.
4. Token-group matrix. Prefix tokens whose documents are all in one component are
   dropped; the rest gives (token, group) entries with the group's size range. A
   document probes it with its prefix tokens and gets the groups it might link to,
   where its component is not the one with most documents of that token and where the
   places of the token in both leave room for overlap enough. A token of more than
   8 `block` documents is dealt into parts by the probing document, each of which
   meets all groups of the token;
   the overlap with the union of all tokens of such a group bounds the overlap with
   each member, and only groups whose bound suffices are opened. Pairs already in
   one component are skipped: they can't change the result.
5. Links between components are united by rounds of least labels.

Documents with equal sets (copies) are one class from the start: class sizes never
enter the work. Null text is empty; texts without words link with nothing; fewer
than five words are one shingle. Rows that share a doc_id are classed row by row;
a null doc_id is never a representative of others (its class's id stays null if
all are null). Empty table: no rows. Other columns are ignored, but for those named
in `carry`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROLL, batched, free_name, give_back, handover, hash_spans, mix, partitions, record_batch, slices, table, text_buffers

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a buffer."""
    n = len(raw)
    space = _SPACE[raw]
    begin = ~space
    begin[1:] &= space[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begin[inner] |= ~space[inner]
    starts = np.flatnonzero(begin)
    after = np.append(space, True)
    after[inner] = True
    ends = np.flatnonzero(~space & after[1:]) + 1
    words = hash_spans(_LOW[raw], starts, ends)
    first = np.searchsorted(starts, offsets)
    if len(words) >= k:
        rolled = np.zeros(len(words) - k + 1, np.uint64)
        for i in range(k):
            rolled = rolled * ROLL + words[i : len(words) - k + 1 + i]
        rolled = mix(rolled ^ np.uint64(k))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for i in range(a, b):
                h = h * ROLL + words[i : i + 1]
            out.append(mix(h ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def least_overlap(n):
    """ceil(0.8 n)."""
    return -(-4 * n // 5)


def prefix_length(n):
    return n - least_overlap(n) + 1


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= 80 * (a + b - common)


def sets_of(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, set_key (null: no words), n and the columns `carry` of every row."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(*text_buffers(batch.column(1)))
                keys = pa.array([set_key(x) if len(x) else None for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), keys, pa.array([len(x) for x in sets], pa.int64()), *batch.columns[2:]], names=["doc_id", "set_key", "n", *carry])

    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *carry)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("set_key", T.BinaryType()), T.StructField("n", T.LongType()), *(base.schema[c] for c in carry)])
    return base.transform(batched, run, schema)


DROPPED = np.uint64(16)  # low bits of a hash that the postings go without: 48 bits stay
PLANES = 6


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending 48-bit numbers as byte planes of their gaps: the upper planes are nearly empty and compress away."""
    return np.ascontiguousarray(np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PLANES].T).tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    gaps = np.zeros((len(raw) // PLANES, 8), np.uint8)
    gaps[:, :PLANES] = np.frombuffer(raw, np.uint8).reshape(PLANES, -1).T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


#: A chunk with more documents than this per token keeps their list to itself.
LISTED = 8
#: Of a chunk and bucket: tokens ascending, documents per token (counts), the listed documents (docs, token by token).
#: Of a chunk (tokens null): its directory of sets, and the tokens, counts and docs that it kept to itself.
POSTED = "bucket int, chunk long, tokens binary, docs binary, counts binary, df binary, directory binary"


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[begin[i] : begin[i] + size[i]] of all i in a row."""
    ends = np.cumsum(size)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]


def postings(docs: DataFrame, buckets: int, chunk_tokens: int = 500_000) -> DataFrame:
    """Rows of a chunk and bucket, and one of each chunk (schema POSTED)."""

    def run(batches):
        part, chunk, seen = TaskContext.get().partitionId(), 0, set()
        sets, directory, size = [], [], 0

        def rows():
            token = np.concatenate(sets) >> DROPPED
            doc = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
            order = np.argsort(token, kind="stable")
            token, doc = token[order], doc[order]
            begin = np.flatnonzero(np.diff(token, prepend=token[0] + np.uint64(1)))
            counts = np.diff(begin, append=len(token))
            distinct = token[begin]
            cold = counts <= LISTED
            edges = np.searchsorted(bucket_of(distinct, buckets), np.arange(buckets + 1))
            me = (part << 32) | chunk
            out = []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                x, y = edges[b], edges[b + 1]
                listed = gathered(doc, begin[x:y], np.where(cold[x:y], counts[x:y], 0))
                out.append((b, me, pack_sorted(distinct[x:y]), listed.tobytes(), counts[x:y].astype("<u2").tobytes(), None, None))
            own = [distinct[~cold].tobytes(), gathered(doc, begin[~cold], counts[~cold]).tobytes(), counts[~cold].astype("<u4").tobytes()]
            out.append((me % buckets, me, None, own[1], own[2], own[0], b"".join(directory)))
            return record_batch(out, POSTED)

        for whole in batches:
            for batch in slices(whole, "text"):
                for x in shingle_sets(*text_buffers(batch.column(0))):
                    if not len(x):
                        continue
                    key = set_key(x)
                    if key in seen:  # a copy within this task
                        continue
                    if len(seen) < 500_000:
                        seen.add(key)
                    sets.append(x)
                    directory.append(key + np.array([len(x)], "<i8").tobytes())
                    size += len(x)
                    if size >= chunk_tokens or len(sets) == 65_535:
                        yield rows()
                        sets, directory, size, chunk = [], [], 0, chunk + 1
        if sets:
            yield rows()

    return docs.select(F.col("text").cast("string")).transform(batched, run, POSTED)


def shared_tokens(posted: DataFrame) -> DataFrame:
    """Per bucket: df of its tokens; back to each chunk those with df > 1. The chunks' own rows pass through."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        full = [r for r in rows if r["tokens"] is not None]
        out = [tuple(r.values()) for r in rows if r["tokens"] is None]
        if full:
            tokens = [unpack_sorted(r["tokens"]) for r in full]
            counts = [np.frombuffer(r["counts"], "<u2") for r in full]
            values, where = np.unique(np.concatenate(tokens), return_inverse=True)
            df = np.bincount(where, weights=np.concatenate(counts), minlength=len(values)).astype("<u4")
            shared = df > 1
            values, df = values[shared], df[shared]
            for r, x, c in zip(full, tokens, counts):
                if not len(values):
                    break
                at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                hit = values[at] == x
                if hit.any():
                    sizes = np.where(c <= LISTED, c, 0).astype(np.int64)
                    docs = gathered(np.frombuffer(r["docs"], np.uint16), (np.cumsum(sizes) - sizes)[hit], sizes[hit])
                    out.append((r["bucket"], r["chunk"], pack_sorted(x[hit]), docs.tobytes(), c[hit].tobytes(), df[at[hit]].tobytes(), None))
        table = pa.Table.from_batches([record_batch(out, POSTED)])
        give_back()
        return table

    return posted.groupBy("bucket").applyInArrow(run, POSTED)


MEMBER = "set_key binary, n long, tokens binary, prefix array<long>, group_key long, second_key long"


def candidates(shared: DataFrame) -> DataFrame:
    """Documents that may have a partner. tokens: shared ones, ascending; prefix: those of them to probe with."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = next((r for r in rows if r["tokens"] is None), None)
        full = [r for r in rows if r["tokens"] is not None]
        out = []
        if full and own:
            token, doc, df = [], [], []
            kept = np.frombuffer(own["df"], "<u8")  # tokens whose documents the chunk kept to itself
            kept_size = np.frombuffer(own["counts"], "<u4").astype(np.int64)
            kept_begin, kept_docs = np.cumsum(kept_size) - kept_size, np.frombuffer(own["docs"], np.uint16)
            for r in full:
                x, c, f = unpack_sorted(r["tokens"]), np.frombuffer(r["counts"], "<u2"), np.frombuffer(r["df"], "<u4")
                cold = c <= LISTED
                token.append(np.repeat(x[cold], c[cold]))
                df.append(np.repeat(f[cold], c[cold]))
                doc.append(np.frombuffer(r["docs"], np.uint16))
                if not cold.all():
                    at = np.searchsorted(kept, x[~cold])
                    token.append(np.repeat(x[~cold], kept_size[at]))
                    df.append(np.repeat(f[~cold], kept_size[at]))
                    doc.append(gathered(kept_docs, kept_begin[at], kept_size[at]))
            token, doc, df = np.concatenate(token), np.concatenate(doc), np.concatenate(df)
            order = np.lexsort((token, df, doc))
            token, doc, df = token[order], doc[order], df[order]
            entries = own["directory"]
            edges = np.searchsorted(doc, np.arange(len(entries) // 24 + 1))
            for i in range(len(entries) // 24):
                t, f = token[edges[i] : edges[i + 1]], df[edges[i] : edges[i + 1]]
                n = int(np.frombuffer(entries, "<i8", 1, 24 * i + 16)[0])
                left = prefix_length(n) - (n - len(t))
                if left > 0 and len(t):
                    rare = t[f <= f[len(f) // 2]]
                    keys = [int(x[mix(x).argmin()]) for x in (rare, t)]
                    out.append((entries[24 * i : 24 * i + 16], n, np.sort(t).tobytes(), t[:left].view(np.int64).tolist(), *keys))
        table = pa.Table.from_batches([record_batch(out, MEMBER)])
        give_back()
        return table

    return shared.groupBy("chunk").applyInArrow(run, MEMBER)


def _tokens(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def common_size(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def pivot_components(members: DataFrame, keys: list[str]) -> DataFrame:
    """rep, comp, pivot: inside each key, components of documents and the pivots they link to. comp is the least pivot's rep."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["rep", "n", "tokens"]).to_pylist(), key=lambda r: (r["n"], r["rep"]))
        pivots, root, of = [], [], []  # (n, tokens), parent of a pivot, pivot of each row

        def top(k):
            while root[k] != k:
                k = root[k]
            return k

        for r in rows:
            t, n, met = _tokens(r["tokens"]), r["n"], None
            for k in range(len(pivots) - 1, -1, -1):
                m, u = pivots[k]
                if 5 * m < 4 * n:
                    break  # sizes fall: no smaller pivot can link
                here = top(k)
                if here != met and linked(common_size(t, u), n, m):
                    if met is not None:
                        root[max(met, here)] = min(met, here)
                    met = here if met is None else min(met, here)
            if met is None:
                met = len(pivots)
                pivots.append((n, t))
                root.append(met)
                of.append((met, True))
            else:
                of.append((met, False))
        least: dict[int, int] = {}
        for r, (k, own) in zip(rows, of):
            if own:
                least[top(k)] = min(r["rep"], least.get(top(k), r["rep"]))
        out = [(r["rep"], least[top(k)], own) for r, (k, own) in zip(rows, of)]
        return pa.Table.from_batches([record_batch(out, "rep long, comp long, pivot boolean")])

    return members.groupBy(*keys).applyInArrow(run, "rep long, comp long, pivot boolean")


def open_groups(opened: DataFrame) -> DataFrame:
    """Links (a < b) between components. Rows of a key: members of one group (side 1) and documents that probe it (side 0)."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.select(["side", "rep", "n", "comp", "tokens"]).to_pylist()
        held = sorted(((r["n"], r["comp"], r["rep"], _tokens(r["tokens"])) for r in rows if r["side"]), key=lambda r: r[:3])
        union = np.unique(np.concatenate([h[3] for h in held])) if held else np.zeros(0, np.uint64)
        sizes = np.array([h[0] for h in held])
        found = set()
        for r in rows:
            if r["side"] or not held:
                continue
            n, comp, t = r["n"], r["comp"], _tokens(r["tokens"])
            if common_size(t, union) < least_overlap(n):
                continue  # the group's bound
            for m, other, _, u in held[np.searchsorted(sizes, least_overlap(n)) : np.searchsorted(sizes, 5 * n // 4, "right")]:
                link = (min(comp, other), max(comp, other))
                if comp != other and link not in found and linked(common_size(t, u), n, m):
                    found.add(link)
        return pa.Table.from_batches([record_batch(sorted(found), "a long, b long")])

    return opened.groupBy("gid", "part").applyInArrow(run, "a long, b long")


def least_labels(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable over the edges (a, b), by rounds of large and small stars."""
    pairs = handover(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        new = handover(small.filter("u <> v").distinct(), "links")
        if new.count() == pairs.count() and not new.join(pairs, ["u", "v"], "left_anti").take(1):
            return new.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        pairs = new


def dealt(rows: DataFrame, key: str, block: int) -> DataFrame:
    """rows (rep, key, ...) with blk: blocks of about `block` rows of each key. Only keys with more rows than that are joined."""
    large = handover(rows.groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block), "sizes")
    return rows.join(large, key, "left").withColumn("blk", F.coalesce(F.pmod(F.xxhash64("rep"), F.ceil(F.col("c") / block)), F.lit(0).cast("long"))).drop("c")


def first_components(members: DataFrame, block: int) -> DataFrame:
    """rep, gid, comp: the block of every document, and its component after all blocks and the meetings of their pivots."""
    blocks = handover(dealt(members.select("rep", "group_key"), "group_key", block), "blocks")
    inside = handover(pivot_components(members.join(blocks.select("rep", "blk"), "rep"), ["group_key", "blk"]), "inside")
    pivots = handover(members.select("rep", "n", "tokens", "group_key", "second_key").join(inside.filter("pivot").select("rep"), "rep", "left_semi"), "pivots")
    links = None
    for key in ("group_key", "second_key"):
        met = pivot_components(dealt(pivots.select("rep", "n", "tokens", key), key, block), [key, "blk"]).filter("rep <> comp").select(F.col("rep").alias("a"), F.col("comp").alias("b"))
        links = met if links is None else links.unionByName(met)
    own = inside.filter("pivot and rep <> comp").select(F.col("rep").alias("a"), F.col("comp").alias("b"))
    roots = least_labels(links.unionByName(own)).withColumnRenamed("node", "comp")
    return blocks.join(inside, "rep").join(roots, "comp", "left").select("rep", F.xxhash64("group_key", "blk").alias("gid"), F.coalesce("root", "comp").alias("comp"))


def jaccard_components(docs: DataFrame, block: int = 512, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id and the columns `carry` of every row."""
    spark = docs.sparkSession
    sets = handover(sets_of(docs, carry), "sets")
    total = sets.agg(F.sum("n").alias("n")).first().n or 0
    buckets = max(partitions(spark), -(-total // 1_500_000))
    reps = sets.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))

    found = candidates(shared_tokens(postings(docs, buckets)))
    found = found.groupBy("set_key").agg(F.first(F.struct("n", "tokens", "prefix", "group_key", "second_key")).alias("m")).select("set_key", "m.*")
    members = handover(found.join(reps.select("set_key", "rep"), "set_key").drop("set_key"), "members")
    labels = handover(first_components(members, block), "labels")

    # place of a token in its document's order, its own tokens first; as first common one it leaves room for partners up to `reach`
    posts = members.select("rep", "n", (F.col("n") - F.octet_length("tokens") / 8).alias("own"), F.posexplode("prefix").alias("place", "token"))
    reach = F.floor((5 * F.col("n") - 9 * (F.col("own") + F.col("place"))) / 4)
    posts = posts.select("rep", "n", "token", reach.alias("reach")).join(labels, "rep")
    of_comp = posts.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    parts = F.ceil(F.sum("c") / (8 * block))  # a token of many documents is probed in so many parts
    live = of_comp.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("major"), parts.alias("parts"), F.count(F.lit(1)).alias("comps"))
    live = live.filter("comps > 1").drop("comps")
    posts = handover(posts.join(live, "token").withColumn("minor", F.col("comp") != F.col("major")), "posts")
    ranges = [F.min("n").alias("least"), F.max("n").alias("most"), F.max("reach").alias("widest"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("minor").alias("minors")]
    matrix = posts.groupBy("token", "gid").agg(*ranges, F.max("parts").alias("parts"))
    matrix = matrix.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    # the component with most documents of a token need not probe: the others probe its groups, above their size too
    near = "least <= reach and n <= widest and 5 * most >= 4 * n and (least <= n or not minors) and not (lo = comp and hi = comp)"
    probes = posts.filter("minor").select("token", F.pmod(F.xxhash64("rep"), "parts").alias("part"), "rep", "n", "comp", "reach")
    probes = probes.join(matrix, ["token", "part"]).filter(near)
    probes = handover(probes.select("rep", "gid").distinct(), "probes")
    sizes = probes.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / (2 * block)).alias("parts"))
    asked = probes.join(sizes, "gid").select("gid", F.pmod(F.xxhash64("rep"), "parts").alias("part"), "rep")
    whole = members.select("rep", "n", "tokens").join(labels, "rep")
    queries = asked.join(whole.drop("gid"), "rep").withColumn("side", F.lit(0))
    held = whole.join(sizes, "gid").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("side", F.lit(1))
    columns = ["gid", "part", "side", "rep", "n", "comp", "tokens"]
    links = open_groups(queries.select(columns).unionByName(held.select(columns)))

    roots = least_labels(links)
    ends = labels.join(roots, F.col("comp") == F.col("node"), "left").select("rep", F.coalesce("root", "comp").alias("root"))
    ends = ends.join(ends.groupBy("root").agg(F.min("rep").alias("component")), "root").filter("component <> rep").select("rep", "component")
    classes = reps.join(ends, "rep", "left").filter("copies > 1 or component is not null").select("set_key", F.coalesce("component", "rep").alias("component"))
    return sets.join(classes, "set_key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), *carry)


def distinct_documents(docs: DataFrame, block: int = 512) -> DataFrame:
    """One whole row of each component, with all columns of docs: the least doc_id (null ids last).

    Rows are told apart by their place in the scan, whatever their ids, so docs should
    be a table; a row only goes if the hash of its text agrees as well.
    """
    row, mark = free_name("row", docs.columns), free_name("mark", docs.columns)
    placed = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(mark, F.xxhash64("text"))
    named = placed.select(F.col(row).alias("doc_id"), F.col("text"), F.col("doc_id").cast("long").alias("own_id"), F.col(mark).alias("mark"))
    found = handover(jaccard_components(named, block, ("own_id", "mark")), "components")
    order = F.struct(F.col("own_id").isNull().alias("no_id"), "own_id", "doc_id")
    kept = found.groupBy("component_id").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("component_id", F.col("best.doc_id").alias("best"))
    gone = handover(found.join(kept, "component_id").filter("doc_id <> best").select(F.col("doc_id").alias(row), F.col("mark").alias(mark)), "near")
    return placed.join(gone, [row, mark], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
