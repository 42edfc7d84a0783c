"""Turn repair and spelling variants against brute force, and odd rows."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

DATA = "/root/testdata/sf0.001"
CHATS = "conv_id long, turn long, role string, text string, extra string"


def rows(df):
    return [r.asDict() for r in df.collect()]


def cheapest(initials, faults):
    """(cost, audit, roles): every sequence of edits in order of cost and audit, until one reads as it must."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, roles
        for role in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, roles + role))
            if i < len(initials) and faults[i] not in "BD":
                heapq.heappush(heap, (cost + 3 + 3 * (faults[i] == "T"), audit + "R", i + 1, roles + role))
        if i < len(initials):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles))
            if faults[i] not in "BD" and initials[i]:
                heapq.heappush(heap, (cost + 3 * (faults[i] == "T"), audit + "K", i + 1, roles + initials[i]))


def test_plan_is_the_cheapest_and_its_audit_the_least():
    from newsloom.llm.op11_turn_repair import plan

    rnd = random.Random(3)
    for k in range(700):
        n = rnd.randint(0, 4 if k % 10 else 5)
        initials = [rnd.choice(["s", "u", "a", "u", "a", "t", ""]) for _ in range(n)]
        faults = [rnd.choice("---TTBD") for _ in range(n)]
        cost, script = plan(initials, faults)
        want = cheapest(initials, faults)
        assert (cost, "".join(e for e, _ in script), "".join(r for _, r in script)) == want, (initials, faults)


def damaged(chats):
    """The contract's damage, row by row: conv_id -> rows in order."""
    out = {}
    for conv, turn, role, text in chats:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        by = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if by == 1 else re.sub("[.!?]", "", text) if by == 2 else text
        kept += [(turn, "user" if by == 4 else role, text)] * (0 if by == 0 else 2 if by == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, x in out.items()}


def by_hand(chats):
    for conv, turns in damaged(chats).items():
        faults, seen = [], set()
        for _, role, text in turns:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("B" if not last else "D" if (role, text) in seen else "-" if last in ".!?" else "T")
            seen.add((role, text))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        known = {t for t, _, _ in turns if t is not None}
        yield {
            "conv_id": conv, "gaps": max(known) - min(known) + 1 - len(known) if known else 0, "blank": faults.count("B"), "duplicate": faults.count("D"),
            "truncated": faults.count("T"), "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "turns": turns, "faults": faults,
        }


def repaired_text(turns, audit, roles):
    said, turns, roles = [], iter(turns), iter(roles)
    for e in audit:
        role = "" if e == "D" else {"u": "user", "a": "assistant"}.get(next(roles), "")
        if e == "I":
            said.append(role + ":")
        else:
            _, own, text = next(turns)
            if e != "D":
                said.append((role if e == "R" else own) + ":" + text)
    return "\n".join(said)


def test_turn_repair_against_brute_force(spark):
    from pyspark.sql import functions as F

    from newsloom.llm import op11_turn_repair as m

    rnd = random.Random(8)
    chats = [(c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", "system", "tool", None]), rnd.choice(["Yes.", "no", " ", "", None, "Why? ", "same\n", "same\n", "it is!\t"])) for c in [*range(60), None] for t in range(rnd.randint(1, 5))]
    table = spark.createDataFrame([(*r, "x") for r in chats], CHATS)
    broken = m.damage(table)
    also = broken.select("conv_id")
    lost = broken.filter("n > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = {r["conv_id"]: r for r in rows(m.digest(m.edits(lost, also)))}
    assert len(got) == 61
    for want in by_hand(chats):
        r = got[want["conv_id"]]
        turns, faults = want.pop("turns"), want.pop("faults")
        cost, audit, roles = cheapest([t[1][:1] for t in turns], faults)
        assert {k: r[k] for k in want} == want
        assert (r["cost"], r["audit"]) == (cost, audit)
        assert r["repaired_sha256"] == hashlib.sha256(repaired_text(turns, audit, roles).encode()).hexdigest()
    mended = {}
    for r in rows(m.repaired(lost).orderBy("conv_id", "turn")):
        mended.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert all(re.fullmatch("s?(ua)+", "".join(x)) for x in mended.values())


def test_turn_repair_of_odd_tables(spark):
    from newsloom.llm import op11_turn_repair as m

    none = spark.createDataFrame([], CHATS)
    assert m.edits(none).count() == 0 and m.digest(m.edits(none)).count() == 0
    long = spark.range(3000).selectExpr("7L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat(repeat('word ', 200), id, '.') as text")
    r = rows(m.digest(m.edits(long)))[0]
    assert r["illegal"] == 1000 and r["gaps"] == 0 and r["cost"] == 3000 and len(r["audit"].replace("I", "")) == 3000
    only = m.digest(m.edits(none, spark.createDataFrame([(4,), (4,), (None,)], "conv_id long")))
    assert sorted((str(r["conv_id"]), r["cost"], r["audit"], r["repaired_sha256"]) for r in rows(only)) == [("4", 0, "", hashlib.sha256(b"").hexdigest()), ("None", 0, "", hashlib.sha256(b"").hexdigest())]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    """word -> (form, root, n, n_near, form_n), by comparing all words."""
    out = {}
    for w, n in counts.items():
        by = [x for x in counts if near(w, x)]
        best = min(by, key=lambda x: (-counts[x], x), default=None)
        out[w] = [best if best and counts[best] >= 10 * n else None, None, n, len(by), None]
    for w, x in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        x[1], x[4] = root, counts[x[0]] if x[0] else None
    return {w: tuple(x) for w, x in out.items()}


def test_spelling_variants_against_brute_force(spark):
    from newsloom.llm.op12_spelling import variants

    rnd = random.Random(4)
    counts = {}
    for _ in range(25):  # families of words that are a few edits apart, of few letters, so that bigrams repeat
        base = "".join(rnd.choice("abné") for _ in range(rnd.randint(7, 13)))
        for n in (40000, 1500, 60, 3):
            for _ in range(8):
                counts.setdefault(base, rnd.randint(n, 2 * n))
                i = rnd.randrange(len(base))
                base = rnd.choice([base[:i] + base[i + 1 :], base[:i] + rnd.choice("abné") + base[i:], base[:i] + rnd.choice("abné") + base[i + 1 :]])
                base = base if len(base) >= 7 else base + "abn"
    counts |= {"a" * 300: 40, "a" * 301: 4, "a" * 299: 3}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows(variants(table))}
    want = grouped(counts)
    assert got == want
    assert sum(x[3] for x in want.values()) > 500 and any(x[0] and x[0] != x[1] for x in want.values())


def counted(docs):
    counts = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[word] = counts.get(word, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_spelling_on_documents(spark):
    from newsloom.llm.op12_spelling import op12_spelling, variants, word_counts

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows(op12_spelling(spark, DATA))}
    assert got == grouped(counted(docs)) and sum(x[0] is not None for x in got.values()) > 5
    odd = [(1, None, "x"), (2, "", "x"), (None, "Étoile×étoile ÉTOILES ÉTOILES étoiles ÉTOILES", "x"), (3, "abcdefgh " * 5000, "x"), (3, "abcdefgh " * 5000, "x"), (4, "ab 12 ---", "x")]
    table = spark.createDataFrame(odd, "doc_id long, text string, word string")
    words = word_counts(table, spoil=True)
    assert {r["word"]: r["n"] for r in rows(words)} == counted([x[:2] for x in odd])
    assert word_counts(table.limit(2)).count() == 0 and variants(word_counts(table.limit(2))).count() == 0
