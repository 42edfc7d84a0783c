"""Training-data operators: brute force on small tables, and the odd rows each must bear."""

import hashlib
import re
import zlib

import numpy as np
import pytest

ODD = [(1, "A b c d e f g h i j k l m n", "en", "src0", 27, "x"), (2, "a B c d e f g h i j k l m n", "en", "src0", 27, "y"), (3, None, None, None, None, None), (4, "", "de", "src1", 0, "z"), (5, "word " * 30_000, "en", "src2", 150_000, "q"),
       (6, "two words", "en", "src2", 9, "q"), (6, "two words", "en", "src2", 9, "q"), (None, "no id here", "en", "src3", 10, "q"), (8, "a b c d e f g h i j k l m o", "fr", "src3", 27, "q"), (9, "l1\nl2 is here\nl3\n" + "x y " * 30, "fr", "src3", 9, "q"),
       (10, "start\nl2 is here\nl3\n" + "x y " * 30 + "\nend", "es", "src3", 9, "q")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def low(t):
    return (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_dedup(spark, docs, empty):
    from newsloom.llm.op3_exact_dedup import distinct_texts, exact_dedup

    for most in (None, 1):  # with 1 every repeated text is hot
        got = rows(exact_dedup(docs, most=most))
        assert len(got) == len(ODD)
        for r in got:
            same = [x[0] for x in ODD if hashlib.sha256(low(x[1]).encode()).hexdigest() == r["text_sha256"]]
            assert r["group_size"] == len(same) and r["doc_id"] in same
            assert r["keep_id"] == max((x for x in same if x is not None), default=None)
            assert not r["kept"] or r["doc_id"] == r["keep_id"]
        texts = {low(x[1]) for x in ODD}
        assert sum(r["kept"] for r in got) == len(texts)
        left = rows(distinct_texts(docs, most=most))
        assert sorted(low(r["text"]) for r in left) == sorted(texts) and {r["doc_id"] for r in left} == {2, 4, 5, 6, None, 8, 9, 10}
        assert all(tuple(r.values()) in ODD for r in left)
    assert exact_dedup(empty).count() == 0 and distinct_texts(empty).count() == 0
    plan = exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Sort [") == 1


def test_exact_dedup_spreads_a_hot_text(spark):
    from newsloom.llm.op3_exact_dedup import distinct_texts, exact_dedup

    df = spark.range(400).selectExpr("id as doc_id", "if(id % 2 = 0, 'Same', concat('t', id)) as text")
    got = rows(exact_dedup(df))
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] % 2 == 0} == {(398, 200)} and len(got) == 400
    assert [r["doc_id"] for r in got if r["kept"] and r["doc_id"] % 2 == 0] == [398]
    assert {r["keep_id"] for r in rows(exact_dedup(df, keep="min")) if r["doc_id"] % 2 == 0} == {0}
    assert distinct_texts(df).count() == 201


def test_jaccard(docs, empty, spark):
    from newsloom.llm.op9_jaccard import jaccard_components

    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in rows(jaccard_components(docs)))
    assert (1, 10, 1) in got and (2, 10, 1) in got and (8, 10, 1) in got  # 9 of 11 shingles
    assert (3, 0, 3) in got and (4, 0, 4) in got and got.count((6, 1, 6)) == 2
    assert jaccard_components(empty).count() == 0


def test_jaccard_against_brute_force(spark):
    import random

    from newsloom.llm.op9_jaccard import jaccard_components

    rnd = random.Random(5)
    texts = []
    for _ in range(25):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 8, 40, 120]))]
        for _ in range(rnd.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = f"w{rnd.randrange(400)}"
            texts.append(" ".join(copy))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)})
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (512, 4):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, block=block).collect()}
        assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_decontamination_shards_agree(spark, docs, empty):
    from newsloom.llm import op4_decontamination as m

    bench = spark.createDataFrame([("1", "c d E f g h i j k l m"), ("2", "two words"), ("3", None), (None, "no id"), ("5", "")], "item_id string, text string")
    one = sorted(map(str, rows(m.digest(m.contamination(docs, bench)))))
    assert one == sorted(map(str, rows(m.digest(m.contamination(docs, bench, shard_words=3)))))
    by = {r["doc_id"]: r for r in rows(m.digest(m.contamination(docs, bench)))}
    assert by[1]["n_hit"] == 11 and by[6]["n_hit"] == 2 and by[None]["n_hit"] == 2 and by[None]["n_items"] == 0 and not by[3]["contaminated"]
    assert m.contamination(empty, bench).count() == 0
    cut = {r["doc_id"]: r for r in rows(m.decontaminate(docs, bench, max_coverage=0.9))}
    assert cut[1]["text"] == "A b  n" and cut[1]["n_chars"] == 6 and 6 not in cut and cut[5]["text"] == ODD[4][1] and set(cut[1]) == set(SCHEMA.replace(",", "").split()[::2])


def test_decontamination_cuts_once_over_all_shards(spark):
    import random

    from newsloom.llm import op4_decontamination as m

    rnd = random.Random(7)
    items = [[f"w{rnd.randrange(30)}" for _ in range(rnd.choice([2, 3, 5, 6]))] for _ in range(12)]
    bench = spark.createDataFrame([(str(k), " ".join(x)) for k, x in enumerate(items)], "item_id string, text string")
    texts = []
    for _ in range(80):
        words = [f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(0, 12))]
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(items)
        texts.append(words)
    want = {}
    for d, words in enumerate(texts):
        hit = set()
        for x in items:
            n = min(4, len(x))
            for g in {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}:
                hit |= {j for i in range(len(words) - n + 1) if tuple(words[i : i + n]) == g for j in range(i, i + n)}
        if len(hit) <= 0.5 * len(words):
            want[d] = [w for j, w in enumerate(words) if j not in hit]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")
    for shard in (2_000_000, 20, 12):
        assert {r.doc_id: m.words_of(r.text) for r in m.decontaminate(df, bench, window=4, shard_words=shard).collect()} == want
    assert 0 < len(want) < len(texts)


def test_token_codes_and_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    from newsloom.llm import op2_token_codes as c
    from newsloom.llm import op5_packing as p
    from newsloom.llm.tokens import vocabulary_path

    t = Tokenizer.from_file(vocabulary_path())
    want = {}
    for d, text, *_ in ODD:
        want.setdefault(d, []).append(np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    got = rows(c.read_codes(c.write_codes(docs, segment_tokens=500)))
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((d or -1, len(x), zlib.crc32(x.tobytes())) for d, xs in want.items() for x in xs)
    got.sort(key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda x: (x is not None, x))
    pieces = rows(p.pack(docs, max_len=64, pool_bytes=1 << 16, keep_ids=True))
    assert sum(r["length"] for r in pieces) == at
    seqs = {}
    for r in pieces:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        end = 0
        for offset, n in sorted(s):
            assert offset == end
            end += n
        assert end <= 64
    assert p.pack(empty).count() == 0 and c.read_codes(c.write_codes(empty)).count() == 0


def test_encoder_survives_equal_hashes(monkeypatch):
    from newsloom.llm import tokens as m

    texts = ["the cat sat on a mat", "dog or a hen", "", None, "Ünder 12 §x"]
    want = m.Encoder(m.vocabulary_path()).encode(texts)
    monkeypatch.setattr(m, "hash_spans", lambda raw, a, b: (b - a).astype(np.uint64))  # every length is one hash
    assert m.Encoder(m.vocabulary_path()).encode(texts) == want


def test_token_at(spark, docs):
    from newsloom.llm import op2_token_codes as c

    codes = c.write_codes(docs, segment_tokens=500)
    parts = {}
    for r in codes.orderBy("part", "segment").collect():
        parts.setdefault(r.part, []).extend(c.Codes(bytes(r.codes)).ids().tolist())
    ids = [x for _, part in sorted(parts.items()) for x in part]
    asked = spark.createDataFrame([(k,) for k in [0, 1, len(ids) - 1, len(ids), *range(5, len(ids), 97)]], "position long")
    assert {r.position: r.id for r in c.token_at(codes, asked).collect()} == {r.position: ids[r.position] for r in asked.collect() if r.position < len(ids)}


def test_codes_random_access():
    from newsloom.llm.op2_token_codes import Codes, encode_codes

    ids = np.random.default_rng(1).integers(0, 1 << 20, 3000).astype(np.uint32)
    ids[:5] = [0, 255, 256, 65_535, 65_536]
    code = Codes(encode_codes(ids))
    assert (code.ids() == ids).all() and [code[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert Codes(encode_codes(ids[:0])).ids().size == 0


def test_toxicity(spark, docs, empty):
    from newsloom.llm import op1_toxicity as m

    text = [(i, ("plain words of a calm text number %d" % i) + (" you idiot" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(300)]
    corpus = spark.createDataFrame([(i, t) for i, t, _ in text], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in text] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    model = m.train(corpus, labels)
    hard = spark.createDataFrame([(1, "you 1d10t there"), (2, "you i d i o t"), (3, "you idioooot"), (4, "plain calm text"), (5, None), (6, "")], "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in m.score(hard, model).collect()}
    assert got[2] > 0.5 and got[3] > 0.5 and max(got[4], got[5], got[6]) < 0.5
    assert m.toxicity(empty, labels).count() == 0 and m.toxicity(docs, labels.filter("false")).count() == len(ODD)


def test_line_dedup(spark, docs, empty):
    from newsloom.llm.op6_line_dedup import line_dedup

    got = {r["doc_id"]: r for r in rows(line_dedup(docs))}
    assert got[9]["n_removed"] == 0 and got[10]["n_removed"] == 3 and got[10]["text"] == "start\nend" and got[3]["text"] is None
    assert line_dedup(empty).count() == 0


def test_toxicity_of_spelled_out_words(spark):
    from newsloom.llm import op1_toxicity as m

    bad = ["idiot", "moron", "scum", "stupid", "ass"]
    text = [(i, f"plain words of a calm text as I think you {bad[i // 5 % 5] if i % 5 == 0 else 'friend'} there", int(i % 5 == 0)) for i in range(1500)]
    corpus = spark.createDataFrame([(i, t) for i, t, _ in text], "doc_id long, text string")
    model = m.train(corpus, spark.createDataFrame([(i, y) for i, _, y in text], "doc_id long, toxic int"))
    hard = ["you 1d10t there", "are a m o r o n today", "i d i o t I think", "i d i o t. Then", 'said "i d i o t" to', "s c u m, all", "$ t u p ! d", "i  d  i  o  t", "i\nd\ni\no\nt", "i d  i o\nt", "a s s", "m, o, r, o, n", "1 d 1 0 7", "i d i o t   m o r o n"]
    calm = ["plain calm text", "a b c", "1 2 3 4", "words of a I think", "- - - -", "it's a b c", "x y z " * 9, "ç " * 5000]
    features = m.Features(model.cost, model.weights)
    assert [t for t in hard if model.score(features, t) < 0.5] == []
    assert [t for t in calm if model.score(features, t) >= 0.5] == []


def test_viterbi_finds_the_cheapest_of_all_readings():
    import itertools

    from newsloom.llm import op1_toxicity as m

    cost = m.costs(np.random.default_rng(2).integers(0, 60, m.CLASSES**3).astype(float))
    decoder = m.Decoder(cost)

    def price(options, readings):
        text, total = "".join(r for r, _ in readings), sum(p for _, p in readings)
        x = y = 0
        for ch in text:
            z = m.letter_class(ch)
            total += cost[x][y][z]
            x, y = y, z
        return total + cost[x][y][0], text

    for token in ("1d10t", "3v1l", "b@@d", "id11oot!", "a*s", "sc0m$"):
        options = decoder.lattice(token)
        best = min(price(options, x) for x in itertools.product(*options))
        assert abs(price(options, [(decoder.decode(token), 0)])[0] - cost_of(cost, m, best[1])) < 1e-9 or decoder.decode(token) == best[1], token
    for token in ("b a d", "i  d  i  o  t", "h e l l o!", "$ c u m"):
        options = decoder.spelled(token)
        best = min(price(options, x) for x in itertools.product(*options))
        assert decoder.decode(token, spelled=True) == best[1], token


def cost_of(cost, m, text):
    x = y = 0
    total = 0.0
    for ch in text:
        z = m.letter_class(ch)
        total += cost[x][y][z]
        x, y = y, z
    return total + cost[x][y][0]


def test_obfuscated_words_are_restored(spark):
    from newsloom.llm import op1_toxicity as m

    said = "such an evil idiot says hello and is bad to a moron in the village of bald old men who hold hello signs "
    cost = m.costs(m.trigram_counts(spark.createDataFrame([(said * 50,)], "text string")))
    words = lambda text: [w for t in sorted(m.tokens_of(text), key=len)[-1:] for w in m.Decoder(cost).words(t)]
    for text, want in (("b a d", "bad"), ("i  d  i  o  t", "idiot"), ("h e l l o!", "hello"), ("3v1l", "evil"), ("1d10t", "idiot"), ("idiooooot", "idiot"), ("m-o-r-o-n", "moron")):
        assert want in words(text), (text, words(text))


def test_labels_given_twice(spark):
    from newsloom.llm import op1_toxicity as t
    from newsloom.llm import op10_quality as q

    corpus = spark.createDataFrame([(i, "you scum you" if i % 2 else "calm words here", "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    twice = spark.createDataFrame([(i, y, 1 - y) for i in range(200) for y in ({0, i % 2})], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r.predicted for r in t.toxicity(corpus, twice).collect()}
    assert got == {i: i % 2 for i in range(200)}
    assert {r.doc_id: r.kept for r in q.quality(corpus, twice).collect()} == {i: i % 2 == 0 for i in range(200)}


def removed_by_hand(texts, min_lines, min_words):
    """Per text the lines that lie in a run that occurs before, by listing all runs."""
    places, gone = set(), []
    for text in texts:
        lines, out = [x.strip().lower() for x in text.split("\n") if x.strip()], set()
        for i in range(len(lines)):
            for n in range(1, min_lines + 1):
                run = tuple(lines[i : i + n])
                if len(run) == n and (n == min_lines or sum(len(x.split()) for x in run) >= min_words):
                    out |= set(range(i, i + n)) if run in places else set()
                    places.add(run)
        gone.append(out)
    return gone


def test_line_dedup_against_brute_force(spark):
    import random

    from newsloom.llm.op6_line_dedup import line_dedup, repeated_runs

    # both lines of the run that 4 repeats of 3 stand first with other neighbours
    texts = ["x0\nlicence\nx1", "w0\nhead\nw1", "y0\nhead\nlicence\ny1", "z0\nHEAD\n\n licence \nz1"]
    got = {r.doc_id: r.n_removed for r in line_dedup(spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 2}
    rnd = random.Random(3)
    pool = [f"line {k}" for k in range(40)] + [f"long {k} " + "w " * 60 for k in range(4)] + ["filler"] * 8
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 12))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for limits in ({}, {"min_lines": 3, "min_words": 50}, {"min_lines": 1, "window": 1}, {"window": 4}):
        found = {r.doc_id: {i for k in range(0, len(r.runs), 2) for i in range(r.runs[k], r.runs[k + 1])} for r in repeated_runs(df, **limits).collect()}
        want = removed_by_hand(texts, limits.get("min_lines", 2), 50)
        if "window" in limits and limits["window"] > 2:
            assert found and all(lines <= want[d] for d, lines in found.items())
        else:
            assert [found.get(d, set()) for d in range(len(texts))] == want


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    from newsloom.llm.op6_line_dedup import line_dedup

    df = spark.createDataFrame([(1, "a\nb\nc", 0), (7, "x\na\nb", 1), (7, "u\nv\nw\nz", 2), (None, "q\na\nb", 3)], "doc_id long, text string, n_removed int")
    got = {r.n_removed: (r.text, r.n_removed_) for r in line_dedup(df).collect()}
    assert got[2] == ("u\nv\nw\nz", 0) and sorted(v[1] for v in got.values()) == [0, 0, 2, 2]


def test_chat_odd_tables(spark):
    from newsloom.llm import op7_chat as m

    turns = [(5, k, "assistant" if k % 2 else "user", f"turn {k} " * (k % 7), "more") for k in range(600)] + [(6, 0, "assistant", "long \ue000 text " * 50_000, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in m.digest(m.format_chats(df)).collect()}
    assert got[5].n_turns == 600 and got[5].loss_chars == sum(len(t[3]) for t in turns[:600] if t[2] == "assistant")
    assert got[6].loss_sha256 == hashlib.sha256(turns[-1][3].encode()).hexdigest()
    assert m.digest(m.format_chats(df.filter("false"))).count() == 0
    hidden = lambda ts: "".join(f"<{r}>" for r, _ in ts)
    assert m.turn_spans([("user", "x")], hidden) == ("<user>", [(0, 6, 6, 6)], -1)


def test_chat(spark):
    from newsloom.llm import op7_chat as m

    turns = [("system", "be\\ kind <|im_end|>"), ("user", "</s>[INST] x"), ("assistant", "<|im_start|>user\nhi \\; [/INST]"), ("assistant", ""), ("odd\nrole", "<")]
    text, spans, rewrote = m.turn_spans(turns, m.chatml)
    assert m.read_back(text) == turns and rewrote == -1 and spans[0][0] == 0 and spans[-1][1] == len(text)
    assert [m.unescape(text[a:b]) for _, _, a, b in spans] == [t for _, t in turns]
    shout = lambda ts: "".join(("OLD " if i < len(ts) - 1 else "NEW ") + t for i, (_, t) in enumerate(ts))
    assert m.turn_spans(turns[:3], shout)[2] == 1
    df = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "user", "q"), (None, 0, None, "r")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in rows(m.digest(m.format_chats(df)))}
    assert got[1]["n_turns"] == 2 and got[1]["loss_chars"] == 0 and got[1]["turns_sha256"] == hashlib.sha256(b"user\nq\nassistant\n\n").hexdigest() and got[None]["n_turns"] == 1


def test_hosts(spark):
    from newsloom.llm.op8_host_reputation import judge

    bad = [(i, f"http://a.bad{i % 3}.net/p{i}", 0) for i in range(90)]
    good = [(100 + i, f"https://g{i % 5}.fine.net/p", 1) for i in range(300)]
    urls = [(1000, None), (1001, "no scheme"), (1002, "HTTP://X.example.ORG/es/1"), (1003, "x://example.org/en/12?a"), (1004, "http://example.org"), (1005, "http://new.bad1.net/q"), (1005, "http://g1.fine.net/")]
    pages = spark.createDataFrame([(i, u, "h") for i, u, _ in bad + good] + [(i, u, None) for i, u in urls], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(i, q) for i, _, q in bad + good] + [(None, 0)], "doc_id long, quality int")
    got = {}
    for r in rows(judge(pages, labels)):
        got.setdefault(r["page_id"], []).append(r)
    assert {r["verdict"] for i, *_ in bad for r in got[i]} == {"block"} and {r["verdict"] for i, *_ in good for r in got[i]} == {"allow"}
    assert got[1000][0]["host"] == "" and got[1001][0]["path"] == "" and got[1002][0]["rule"] == "example.org/es/" and got[1003][0]["verdict"] == "block" and got[1004][0]["rule"] is None and len(got[1005]) == 2
    assert judge(pages.filter("false"), labels).count() == 0


def test_quality(spark, docs, empty):
    from newsloom.llm.op10_quality import quality

    junk = [(i, "BUY NOW!! $$$ " * 20, "en", "s1", 0) if i % 2 else (i, f"a calm sentence about subject number {i}. " * 5, "fr", "s2", 1) for i in range(200)]
    corpus = spark.createDataFrame([x[:4] for x in junk], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(x[0], x[4]) for x in junk[:120]], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in rows(quality(corpus, labels))}
    assert got == {x[0]: bool(x[4]) for x in junk}
    assert quality(docs, labels).count() == len(ODD) and quality(empty, labels).count() == 0 and quality(docs, labels.filter("false")).count() == len(ODD)


def co_trained_by_hand(labelled, pool, rounds, each, sure):
    """The rounds again, over lists and with a sort of the whole pool."""
    from newsloom.llm import op10_quality as q

    own, rest = [x for k, x in enumerate(labelled) if k % 5 != 4], [x for k, x in enumerate(labelled) if k % 5 == 4]
    data = [[(x[c], x["y"]) for x in own] for c in "ab"]
    fit = lambda: [q.learn(v, [x for x, _ in data[v]], [y for _, y in data[v]]) for v in (0, 1)]
    models, said = fit(), [set(), set()]
    chance = lambda v, x: float(q.sigmoid(models[v][0][np.frombuffer(x["ab"[v]], "<u2")].sum() + models[v][1]))
    for _ in range(rounds):
        more = [[], []]
        for v in (0, 1):
            for label in (0, 1):
                scored = [(-(chance(v, x) if label else 1 - chance(v, x)), x["row"], x) for x in pool if x["row"] not in said[v]]
                chosen = sorted((c, r) for c, r, _ in scored if -c >= sure)[:each]
                by_row = {x["row"]: x for x in pool}
                more[v] += [(by_row[r], label) for _, r in chosen]
        for v in (0, 1):
            data[1 - v] += [(x["ab"[1 - v]], label) for x, label in more[v]]
            said[v] |= {x["row"] for x, _ in more[v]}
        models = fit()
    return models, said, rest


def test_co_training_against_brute_force(spark):
    import random

    from newsloom.llm import op10_quality as q

    rnd = random.Random(4)
    words = [[f"bad{k}" for k in range(30)], [f"good{k}" for k in range(30)], [f"any{k}" for k in range(30)]]
    corpus, labels = [], []
    for i in range(400):
        y = i % 2
        text = " ".join(rnd.choice(words[rnd.choice([y, y, 2])]) for _ in range(rnd.randrange(1, 12)))
        corpus.append((i, text, rnd.choice("ab" if y else "bc"), f"s{rnd.choice([y, 2])}"))
        labels += [(i, y)] if i < 120 else []
    base = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    picked = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, y int")
    held = [r.asDict() for r in q.features(base, picked).collect()]
    held = [{**r, "a": bytes(r["a"]), "b": bytes(r["b"])} for r in held]
    table = spark.createDataFrame([tuple(r.values()) for r in held], q.FEATURES)
    labelled = sorted((r for r in held if r["y"] is not None), key=lambda r: r["row"])
    pool = [r for r in held if r["pool"]]
    limits = {"rounds": 2, "each": 15, "sure": 0.7}
    model = q.co_train(table.filter("y is not null").orderBy("row").collect(), table.filter("pool"), **limits)
    want, said, _ = co_trained_by_hand(labelled, pool, **limits)
    assert min(map(len, said)) > 15
    for (w, b), (w2, b2) in zip(model.views, want):
        assert np.allclose(w, w2) and abs(b - b2) < 1e-9


def test_beta_tail(spark):
    import math

    from pyspark.sql import functions as F

    from newsloom.llm.op8_host_reputation import chance_above, registered

    cases = [(2, 3), (5, 1), (40, 35), (3, 50), (700, 650)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    for r in df.select("a", "b", chance_above(F.col("a"), F.col("b"), 0.5).alias("p")).collect():
        n, a = int(r.a + r.b - 1), int(r.a)  # whole numbers: a binomial sum
        assert abs(r.p - sum(math.comb(n, j) for j in range(a)) / 2**n) < 1e-6
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "u@x.y.com:80": ("y.com", "com"), "10.0.0.1": ("10.0.0.1", ""), "co.uk": ("co.uk", "co.uk"), "localhost": ("localhost", "localhost"), "": ("", "")}
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", *registered(F.col("h"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == hosts


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables for the stages: labels tell one word as toxic, the benchmark has one item."""
    at = str(tmp_path_factory.mktemp("tables"))
    texts = [(i, f"plain words of a calm text number {i} and others like it" + (" you moron" if i % 4 == 0 else "")) for i in range(400)]
    spark.createDataFrame([(1000 + i, int(i % 4 == 0), 1) for i, _ in texts], "doc_id long, toxic int, quality int").write.parquet(f"{at}/labels.parquet")
    item = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([("b1", item)], "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, texts, item


def test_stages_judge_rows_not_ids(spark, small):
    import corpus_pipeline as cp

    at, texts, item = small
    long = " ".join(f"w{k}" for k in range(60))
    extra = [
        (7, "unique text", 1), (7, "dup", 2), (9, "dup", 3), (6, "same", 4), (6, "same", 5), (None, "DUP", 6), (None, None, 7), (12, "", 8),
        (20, long + " one", 9), (20, long + " other", 10), (None, long + " third", 11), (21, "you m o r o n", 12), (None, f"before {long} {item} after", 13), (22, item, 14),
        (23, "word " * 30_000, 15), (None, "lonely words of no id", 16), (None, "some other words of no id", 17),
    ]
    clash = "doc_id long, text string, score int"
    names = ["toxicity", "row", "mark", "_spans", "n_words", "own_id", "hot", "place", "norm", "front", "h", "spans", "items", "pool", "all_best"]
    table = spark.createDataFrame([(d, t, k, *["x"] * len(names)) for d, t, k in extra + [(1000 + i, t, 100 + i) for i, t in texts]], clash + ", " + ", ".join(f"{n} string" for n in names))
    path = f"{at}/extra.parquet"
    table.write.parquet(path)
    docs = spark.read.parquet(path)
    stages = dict(cp.STAGES)
    left = {}
    for name in ("toxicity", "exact_dedup", "near_dedup", "decontamination"):
        kept = stages[name](spark, docs, at)
        assert kept.columns == docs.columns
        assert stages[name](spark, docs.filter("false"), at).count() == 0
        left[name] = {r.score: r for r in kept.collect()}
    ours = lambda name: {k for k in left[name] if k < 100}
    assert ours("toxicity") == {k for _, _, k in extra} - {12} and len(left["toxicity"]) == len(extra) - 1 + 300
    e = ours("exact_dedup")
    assert {1, 3} <= e and not e & {2, 6} and len(e & {4, 5}) == 1 and len(e & {7, 8}) == 1 and len(e) == len(extra) - 4
    n = ours("near_dedup")
    assert len(n & {2, 3, 6}) == 1 and 2 in n and len(n & {4, 5}) == 1 and len(n & {9, 10, 11}) == 1 and {1, 7, 8, 16, 17} <= n
    d = left["decontamination"]
    assert 14 not in d and d[13].text == f"before {long}  after" and len(d) == docs.count() - 1
    pieces = stages["packing"](spark, docs, at)
    whole = pieces.groupBy("doc_id").sum("length").collect()
    assert sum(r[1] for r in whole) == sum(r.doc_tokens for r in pieces.filter("start = 0").collect()) and pieces.filter("start = 0").count() == docs.count()
    assert stages["packing"](spark, docs.filter("false"), at).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as cp

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        kept = stage(spark, docs, d)
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= docs.count()
        docs = kept
    assert cp.packing(spark, docs, d).count() >= docs.count()


def test_words():
    from newsloom.llm.op4_decontamination import words_of

    assert words_of("Ab-cÉ 9_x") == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low("Ab-cÉ 9_x"))


def test_line_dedup_takes_its_runs_by_picked_lines(monkeypatch):
    import random

    from newsloom.llm import op6_line_dedup as op6

    rnd = random.Random(8)
    for n in range(12):
        hashes = [rnd.randrange(5) for _ in range(n)]
        for window, min_lines in ((1, 1), (2, 2), (2, 3), (3, 3)):
            assert op6.key_runs(hashes, [1] * n, window, min_lines, 50) == [(i, min_lines) for i in range(n - min_lines + 1)]
    monkeypatch.setattr(op6, "selected", lambda hashes, window: {3})
    assert op6.key_runs(list(range(9)), [1] * 9, 2, 2, 50) == [(2, 2), (3, 2)]
