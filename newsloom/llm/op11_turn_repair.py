"""Conversation structure repair by a DP over the turns that are retained.

A conversation's turns are put in order of turn (nulls first), role, text. Each gets its
first fault: blank (nothing but white space), duplicate (role and text seen earlier),
truncated (its last character but white space ends no sentence). Turns are kept, reroled
to user or assistant, or deleted, and empty turns inserted, so that the initials of the
roles read `(s?(ua)+)?`; blank and duplicate turns have to go. The cheapest edits win, of
equally cheap ones those whose audit (initials D, I, K, R in order) is least.

The DP chooses the retained turns only, from the last to the first. What a retained turn
costs with all behind it is its own cost and the least, over the next retained turn and
its state (s, u, a, or the end), of: turns deleted between (a difference of prefix sums),
inserts (a fixed number for a pair of states) and what that one costs. Everything that
depends on the next turn alone is kept as a running minimum per state, so a conversation
takes linear time. Ties go to the turn farthest off (more D), then to more inserts, then
to K before R: the least audit, since equally cheap edits of the same turns can't have an
audit that begins with another's.

Shuffles: one, by conversation, of the rows and of short rows without texts. A partition is
sorted so that a conversation's short rows come first: their faults and roles are the DP's
input (about 1 KB a turn in memory), then its texts stream by and are written as they
come. Texts are never held together. All edits of a conversation come
from one task, since each depends on all turns behind it.

Nulls: a null role or text is one space; null turns come first; rows with a null conv_id
are one conversation. A role without characters has no initial: such a turn can't be kept.
Repeated rows are duplicates. Empty table: no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SQL_CRC, batched, record_batch, sql_crc32, table

# Costs of the edits, and what a truncated turn costs that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# White space, and the ends of sentences.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: Initials inserted between two states; ^ and $ are begin and end. A pair that is missing can't be mended by inserts.
BETWEEN = {
    "^": {"s": "", "u": "", "a": "u", "$": ""},
    "s": {"u": "", "a": "u", "$": "ua"},
    "u": {"u": "a", "a": "", "$": "a"},
    "a": {"u": "", "a": "u", "$": ""},
}
ROLE = {"u": "user", "a": "assistant"}

EDITS = "conv_id long, place long, turn long, was string, role string, text string, fault string, edit string"
DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def fault_of(text: str) -> str:
    """B blank, T truncated, or nothing: `-`."""
    last = text.rstrip(SPACE)[-1:]
    return "B" if not last else "-" if last in ENDS else "T"


def plan(initials: list[str], faults: list[str]) -> tuple[int, list[tuple[str, str]]]:
    """Cost, and the edits in order as (edit, initial of the role that results). A fault is one of B, D (both have to go), T, -."""
    n = len(initials)
    deleted = DELETE  # every turn costs as much, so the prefix sum of deletions is a product
    least: dict[str, tuple[int, int, str]] = {"$": (n * deleted, n, "$")}  # state -> (what it costs from there, with the sum before it; turn; edit)
    behind: list[dict[str, tuple[int, int, str, str]]] = [{}] * (n + 1)  # of a turn and its state: the best next (cost, turn, state, edit)

    def best(state: str) -> tuple[int, int, str, str]:
        found = None
        for to, between in BETWEEN[state].items():
            if to in least:
                cost, turn, edit = least[to]
                key = (cost + INSERT * len(between), -turn, -len(between), edit)
                if found is None or key < found[0]:
                    found = (key, to)
        (cost, turn, _, edit), to = found
        return cost, -turn, to, edit

    for k in range(n - 1, -1, -1):
        if faults[k] in "BD":
            continue
        now, extra = {}, TRUNCATED * (faults[k] == "T")
        for state in dict.fromkeys([initials[k], "u", "a"]):
            if state not in ("s", "u", "a"):
                continue
            kept = state == initials[k]
            nxt = best(state)
            now[state] = (nxt[0] - (k + 1) * deleted + extra + (0 if kept else REROLE), "K" if kept else "R", nxt)
        behind[k] = {s: x[2] for s, x in now.items()}
        for state, (cost, edit, _) in now.items():
            there = cost + k * deleted
            if state not in least or there < least[state][0]:  # of equal ones the farther turn stays
                least[state] = (there, k, edit)

    at, state, step, out = -1, "^", best("^"), []
    total = step[0]
    while True:
        _, turn, to, edit = step
        out += [("D", "")] * (turn - at - 1) + [("I", x) for x in BETWEEN[state][to]]
        if to == "$":
            return total, out
        out.append((edit, to))
        at, state, step = turn, to, behind[turn][to]


def _grouped(batches):
    """(conv_id, its rows one after the other); a conversation's rows have to be taken before the next is asked for."""
    rows = (dict(zip(batch.schema.names, r)) for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    row = next(rows, None)

    def of(conv):
        nonlocal row
        while row is not None and row["conv_id"] == conv:
            now, row = row, next(rows, None)
            yield now

    while row is not None:
        yield row["conv_id"], of(row["conv_id"])


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def edits(conversations: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """A row per edit, in order within a conversation: place in the repaired conversation (null: deleted), turn, was (role before), role, text, fault, edit.

    Inserted turns have a null `was`. Conversations of `also` (conv_id) that have no rows give one row without an edit.
    Rows of a conversation lie together and in order in one partition.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled("role").alias("role"), _filled("text").alias("text"))
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = F.when(last == "", "B").when(last.isin(list(ENDS)), "-").otherwise("T")
    # the order of texts of one turn is that of their first characters, then of their digests; the same in both copies
    order = [F.substring("text", 1, 64).alias("head"), F.unhex(F.md5(F.concat_ws("\n", F.char_length("role").cast("string"), "role", "text").cast("binary"))).alias("digest")]
    none = F.lit(None).cast("string")
    short = rows.select("conv_id", F.lit(0).alias("kind"), "turn", "role", *order, none.alias("text"), fault.alias("fault"))
    long = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", *order, "text", none.alias("fault"))
    both = short.unionByName(long)
    if also is not None:
        null = {c: F.lit(None).cast(t).alias(c) for c, t in both.dtypes}
        both = both.unionByName(also.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", F.lit(-1).alias("kind"), *[x for c, x in null.items() if c not in ("conv_id", "kind")]))
    placed = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "head", "digest").drop("head")

    def run(batches):
        out, size = [], 0
        for conv, turns in _grouped(batches):
            initials, faults, seen, script, any_row = [], [], set(), None, False
            place = done = at = 0
            for row in turns:
                if row["kind"] < 0:
                    continue
                any_row = True
                if row["kind"] == 0:
                    initials.append(row["role"][:1])
                    again = row["digest"] in seen
                    seen.add(row["digest"])
                    faults.append("D" if again and row["fault"] != "B" else row["fault"])
                    continue
                if script is None:
                    script = plan(initials, faults)[1]
                while script[done][0] == "I":
                    out.append((conv, place, None, None, ROLE[script[done][1]], "", None, "I"))
                    place, done = place + 1, done + 1
                edit, to = script[done]
                role = ROLE[to] if edit == "R" else row["role"]
                out.append((conv, None if edit == "D" else place, row["turn"], row["role"], role, row["text"], faults[at], edit))
                place, done, at, size = place + (edit != "D"), done + 1, at + 1, size + len(row["text"])
                if size > 1 << 20 or len(out) > 1000:
                    yield record_batch(out, EDITS)
                    out, size = [], 0
            for _, to in (script or [])[done:]:
                out.append((conv, place, None, None, ROLE[to], "", None, "I"))
                place += 1
            if not any_row:
                out.append((conv, None, None, None, None, None, None, None))
        yield record_batch(out, EDITS)

    return placed.transform(batched, run, EDITS)


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role, text of the repaired conversations."""
    return edits(conversations).filter("edit <> 'D'").select("conv_id", F.col("place").alias("turn"), "role", "text")


def digest(script: DataFrame) -> DataFrame:
    """The contract's columns from the rows of edits(), read as they lie: no shuffle, one row in memory at a time."""

    def run(batches):
        out = []
        for conv, rows in _grouped(batches):
            n, cost, audit, illegal, sha, first, before = {"B": 0, "D": 0, "T": 0, "-": 0}, 0, [], 0, hashlib.sha256(), True, None
            low = high = None
            turns = 0
            for r in rows:
                if r["edit"] is None:
                    continue
                audit.append(r["edit"])
                cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[r["edit"]] + (TRUNCATED if r["fault"] == "T" and r["edit"] != "D" else 0)
                if r["edit"] != "I":
                    n[r["fault"]] += 1
                    illegal += before is not None and before[:1] + r["was"][:1] not in ("su", "ua", "au")
                    before = r["was"]
                    if (t := r["turn"]) is not None:
                        turns += t != high
                        low, high = t if low is None else low, t
                if r["edit"] != "D":
                    sha.update((("" if first else "\n") + r["role"] + ":" + r["text"]).encode())
                    first = False
            gaps = 0 if low is None else high - low + 1 - turns
            out.append((conv, gaps, n["B"], n["D"], n["T"], illegal, cost, "".join(audit), sha.hexdigest()))
        yield record_batch(out, DIGEST)

    return script.transform(batched, run, DIGEST)


def damage(conversations: DataFrame) -> DataFrame:
    """The query's faults, told by the crc32 of `conv_id:turn` mod 20; adds `n` copies per row (0: dropped)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled("role").alias("role"), _filled("text").alias("text"))
    rows = rows.withColumn("by", F.crc32(F.concat_ws(":", _filled("conv_id"), _filled("turn")).cast("binary")) % 20)
    text = F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("by") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("by") == 0, 0).when(F.col("by") == 3, 2).otherwise(1).alias("n"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = damage(table(spark, sf_dir, "conversations"))
    rows = broken.filter("n > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return digest(edits(rows, also=broken.select("conv_id")))


def _add(x: str, cost: str, token: str) -> str:
    """SQL: edits so far (six digits of cost, then pairs of edit and role) and one more."""
    return f"lpad(CAST(CAST(left({x}, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || substr({x}, 7) || '{token}'"


_BLANK = r"\x20\x09-\x0D"
_INSERTED = f"SELECT *, least(u, {_add('z', '3', 'Iu')}, {_add('s', '3', 'Iu')}, {_add('a', '3', 'Iu')}) AS u1"
_BOTH = f"SELECT *, least(a, {_add('u1', '3', 'Ia')}) AS a1"
SQL = rf"""
WITH RECURSIVE {SQL_CRC},
told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {sql_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS mark FROM conversations, crc),
broken AS (SELECT conv_id, turn, CASE WHEN mark = 4 THEN 'user' ELSE role END AS role, CASE mark WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE mark WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM told),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
  left(role, 1) AS c, regexp_extract(text, '([^{_BLANK}])[{_BLANK}]*$', 1) AS last FROM broken),
r AS (SELECT *, CASE WHEN last = '' THEN 'B' WHEN again > 1 THEN 'D' WHEN last IN ('.', '!', '?') THEN '-' ELSE 'T' END AS fault, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM placed),
ids AS (SELECT DISTINCT conv_id FROM conversations),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'B') AS blank, count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
  count(*) FILTER (i > 1 AND p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS z, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM ids
  UNION ALL
  SELECT b.conv_id, r.i, {_add('z', '4', 'D-')},
    least({_add('s', '4', 'D-')}, CASE WHEN r.c = 's' AND stays THEN {_add('z', 'more', 'Ks')} END),
    least({_add('u1', '4', 'D-')}, CASE WHEN r.c = 'u' AND stays THEN {_add('least(z, s, a1)', 'more', 'Ku')} END, CASE WHEN stays THEN {_add('least(z, s, a1)', '3 + more', 'Ru')} END),
    least({_add('a1', '4', 'D-')}, CASE WHEN r.c = 'a' AND stays THEN {_add('u1', 'more', 'Ka')} END, CASE WHEN stays THEN {_add('u1', '3 + more', 'Ra')} END)
  FROM ({_BOTH} FROM ({_INSERTED} FROM steps)) b JOIN (SELECT *, fault IN ('-', 'T') AS stays, CASE WHEN fault = 'T' THEN 3 ELSE 0 END AS more FROM r) r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
),
ends AS (SELECT b.conv_id, least(z, a1) AS best FROM ({_BOTH} FROM ({_INSERTED} FROM steps)) b LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM b.conv_id WHERE b.i = coalesce(sums.n, 0)),
edits AS (SELECT conv_id, best, k, substr(best, 7 + 2 * k, 1) AS e, substr(best, 8 + 2 * k, 1) AS role FROM (SELECT conv_id, best, unnest(range((length(best) - 6) // 2)) AS k FROM ends)),
spots AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i, CASE role WHEN 'u' THEN 'user:' ELSE 'assistant:' END AS called FROM edits),
said AS (SELECT spots.conv_id, string_agg(spots.e, '' ORDER BY k) AS audit, string_agg(CASE spots.e WHEN 'I' THEN called WHEN 'R' THEN called || r.text ELSE r.role || ':' || r.text END, chr(10) ORDER BY k) FILTER (spots.e <> 'D') AS text
  FROM spots LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM spots.conv_id AND r.i = spots.i GROUP BY spots.conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(best, 6) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(said.text, '')) AS repaired_sha256
FROM ends LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ends.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM ends.conv_id
"""
