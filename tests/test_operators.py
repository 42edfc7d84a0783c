"""Rules with known answers, and the greedy resolution against a sequential version."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import scalars as S
from newsloom.functions import text as X
from newsloom.operators import dedup as D
from newsloom.operators import history as H
from newsloom.session import handover


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_digest_titles(spark):
    for title, want in (("派早报：OpenAI 发布 Dot 智能体", True), ("做了个日报生成器：把每日新闻自动汇总成周报", False), ("我开源了一个 Agent 早报抓取工具", False), (None, False)):
        assert one(spark, X.is_nonwork(F.lit(title).cast("string"))) is want


def test_decay_and_rounding(spark):
    day = lambda n: F.date_sub(F.lit("2024-02-01").cast("date"), n)
    assert one(spark, S.case_decay(F.lit(8.0), day(21), "2024-02-01")) == 4.0
    assert one(spark, S.case_decay(F.lit(9.4), day(10), "2024-02-01")) < one(spark, S.case_decay(F.lit(8.2), day(0), "2024-02-01"))
    assert one(spark, S.half_even_percent(F.lit(150), 35)) == 52
    assert one(spark, S.half_even_percent(F.lit(170), 35)) == 60
    assert one(spark, S.weighted_total(S.clamp_score(F.lit("11"), F.lit("7"), F.lit("8")), F.lit("cn"))) == 8.6
    assert one(spark, S.clamp_score(F.lit("x"), F.lit("7"), F.lit("8"))) is None


def test_inline_notes(spark):
    for text, want in (("Read it (opens in a new window)", "Read it"), ("a\u2060b Opens in new tab", "ab"), ("见此（在新窗口中打开）", "见此"), ("The door opens in winter", "The door opens in winter")):
        assert one(spark, X.strip_inline_ui(F.lit(text))) == want


def test_token_sets(spark):
    assert one(spark, X.token_set(F.lit("新模型 GPT-6 好"))) == ["新模", "模型", "gpt", "6", "好"]
    assert one(spark, X.canonical_url(F.lit("http://a.b/c/?q=1"))) == "http://a.b/c"
    assert one(spark, X.host_of(F.lit("https://WWW.Ex.com:80/x"))) == "ex.com:80"


def test_retention_bounds(spark):
    rows = [("20231218", False, False), ("2024-01-02", False, False), ("2024-01-01", True, False), ("note", True, True), ("20231001T0810", True, False)]
    files = spark.createDataFrame([(n, "2023-01-01 00:00:00") for n, _, _ in rows], "name string, mtime string").withColumn("mtime", F.col("mtime").cast("timestamp"))
    got = {r.name: (r.removed, r.undated) for r in H.retention(files, "2024-02-01").collect()}
    assert got["2024-01-02"] == (False, False) and got["2024-01-01"] == (True, False) and got["note"] == (True, True) and got["20231001T0810"] == (True, False)


@pytest.mark.parametrize("most", [2_000_000, 5])
def test_greedy_resolution(spark, most):
    rnd = random.Random(3)
    n, base = 40, {1000, 1001}
    links = set()
    for _ in range(60):
        a, b = rnd.randrange(n), rnd.choice([*range(n), *base])
        if a != b:
            r = rnd.randrange(3)
            links.add((a, b, r))
            if b < n:
                links.add((b, a, r))
    best = {}
    for a, b, r in links:
        best[a, b] = min(r, best.get((a, b), 9))
    kept, want = set(base), {}
    for p in range(n):
        why = [best[p, k] for k in kept if (p, k) in best]
        want[p] = min(why) if why else None
        if not why:
            kept.add(p)
    ranked = spark.createDataFrame([(p, p) for p in range(n)], "pos long, rank long")
    edges = spark.createDataFrame([(a, b, r) for (a, b), r in best.items()], "pos long, other long, reason int")
    got = {r.pos: r.reason for r in D.resolve(ranked, edges, handover, most).collect()}
    assert got == want


def test_a_long_chain_of_conflicts_takes_few_tables(spark):
    n, tables = 10_000, []

    def counted(df):
        tables.append(1)
        return handover(df)

    order = list(range(n))
    random.Random(5).shuffle(order)  # of ids along the chain
    ranked = spark.createDataFrame([(p, k) for k, p in enumerate(order)], "pos long, rank long")
    edges = spark.createDataFrame([(a, b, 1) for k in range(n - 1) for a, b in ((order[k], order[k + 1]), (order[k + 1], order[k]))] + [(order[0], -1, 2)], "pos long, other long, reason int")
    got = {r.pos: r.reason for r in D.resolve(ranked, edges, counted).collect()}
    assert [got[p] for p in order] == [2] + [None, 1] * (n // 2 - 1) + [None]
    assert len(tables) < 30


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_host_edges_against_all_pairs(spark, partitions):
    rnd = random.Random(11)
    rows = []
    for pos in range(500):  # one host has half of all rows
        words = rnd.sample([f"w{k}" for k in range(9)] + ["新模", "模型"], rnd.randint(0, 5))
        zh, en = [w for w in words if w[0] != "w"], [w for w in words if w[0] == "w"]
        rows.append((pos, rnd.choice(["busy", "busy", "a", "b", ""]), None if rnd.random() < 0.05 else 1_700_000_000 + rnd.randrange(0, 90 * 3600, 600), zh, en))
    df = spark.createDataFrame(rows, "pos long, host string, s long, zh array<string>, en array<string>").withColumn("dt", F.timestamp_seconds("s")).drop("s")
    left, right = df.filter("pos % 3 = 0"), df.filter("pos % 4 <> 1")
    like = lambda a, b: bool(a and b) and 100 * len(set(a) & set(b)) >= 25 * len(set(a) | set(b))
    want = {(a[0], b[0]) for a in rows if a[0] % 3 == 0 for b in rows if b[0] % 4 != 1 and a[0] != b[0] and a[1] == b[1] != "" and a[2] and b[2] and abs(a[2] - b[2]) < 6 * 3600 and (like(a[3], b[3]) or like(a[4], b[4]))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.pos, r.other) for r in D.host_edges(left, right).collect()}
        assert D.host_edges(left.limit(0), right.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want and len(want) > 500


def test_components(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(230)] + [(1000, 1000 + k) for k in range(1, 300)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.pos: r.component for r in D.components(spark.createDataFrame(pairs, "pos long, other long"), handover).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}


def test_set_bounds_are_whole_numbers(spark):
    a, b = [f"w{k}" for k in range(100)], [f"w{k}" for k in range(55)]
    rows = [(0, a, []), (1, b, []), (2, [*b[:54], "x"], [])]
    t = spark.createDataFrame(rows, "pos long, en array<string>, zh array<string>")
    assert {tuple(r) for r in D.title_edges(t.filter("pos = 0"), t.filter("pos > 0")).collect()} == {(0, 1)}


def test_a_tier_below_the_next_is_told(spark):
    from newsloom.operators import report as R

    rows = [("a", "top", 8.0), ("a", "watch", 9.0), ("b", "top", 9.0), ("b", "watch", 8.0), ("c", "normal", 1.0)]
    got = {r.run_date: r.inverted for r in R.tier_inversion(spark.createDataFrame(rows, "run_date string, level string, total double")).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_html_to_text(spark):
    from newsloom.functions.residue import body_header_strip, strip_tags

    html = "<p>It&#8217;s &copy; &eacute;&nbsp;&middot; a&amp;b</p><script>x</script><br/>Loading&hellip;"
    assert one(spark, strip_tags(F.lit(html))) == "It’s © é · a&b\n \nLoading…"
    assert one(spark, strip_tags(F.lit("Loading… <b>All of the text</b> that stays"))) == "All of the text that stays"
    assert one(spark, strip_tags(F.lit(None).cast("string"))) == ""
    assert one(spark, body_header_strip(F.lit("Title: x\nURL Source: y\nMarkdown Content:\nThe body"))) == "The body"


def test_show_order(spark):
    from newsloom.operators import cases as K

    rows = [("d", None, "2024-02-01"), ("c", 9.7, "2024-01-01"), ("b", 8.4, "2024-02-01"), ("a", 10.0, "2024-01-31")]
    library = spark.createDataFrame(rows, "url string, score double, last_seen string").selectExpr("url", "score", "cast(last_seen as date) last_seen", "cast(last_seen as date) first_seen")
    assert [r.url for r in K.show_order(library, "2024-02-01").collect()] == ["a", "b", "c", "d"]
    assert one(spark, K.coarse_type(F.lit("进阶 Agent"))) == "Agent 工作流"


def test_stored_libraries_and_reports(spark, tmp_path):
    from newsloom.sources import sinks as K

    rows = spark.createDataFrame([("u", "old", 1), ("u", "new", 2), ("", "x", 3), (None, "y", 4)], "url string, title string, pos long")
    assert [tuple(r) for r in K.read_cases(rows).collect()] == [("u", "new", 2)]
    library = spark.createDataFrame([("u", "b"), ("v", "a"), ("w", ""), ("x", "b")], "url string, type string")
    K.write_cases(library, str(tmp_path), 3)
    about = spark.read.json(f"{tmp_path}/about/v=*").first()
    assert (about.n, about.types) == (4, ["a", "b"])


def test_a_path_without_items_fails_unless_special(spark):
    from newsloom.operators import report as R

    rows = [("s", 0, "a", True, 0, 0, False, "a:0"), ("s", 1, "b", True, 3, 90, False, "b:3"), ("t", 0, "c", True, 0, 0, True, "c:0"), ("u", 0, "d", True, 0, 0, False, "d:0"), ("u", 1, "e", False, 5, 99, False, "e:5")]
    a = spark.createDataFrame(rows, "source_id string, path_rank int, host string, ok boolean, n long, desc_median long, special boolean, diag string")
    assert {r.source_id: r.host for r in R.pick_path(a, 0).collect()} == {"s": "b", "t": "c"}
    assert [tuple(r) for r in R.degraded(a, 0).collect()] == [("u", "d:0; e:5")]


def test_hand_over_needs_a_shared_folder():
    import pytest

    from newsloom.session import shared_dir

    class Cluster:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError):
        shared_dir(Cluster)


def test_pins_rolled_over_days_with_gaps(spark, tmp_path):
    import datetime as dt

    rnd = random.Random(2)
    begin = dt.date(2024, 1, 1)
    rows = [(begin + dt.timedelta(days=d), p, f"Title {rnd.randrange(25)}", rnd.choice([None, "", f"题{rnd.randrange(9)}"])) for d in range(45) if d % 7 != 3 for p in range(rnd.randint(1, 6))]
    schema = "run_date date, pos long, title string, title_cn string"
    spark.createDataFrame(rows, schema).write.partitionBy("run_date").parquet(str(tmp_path / "archive"))
    archive = spark.read.schema("pos long, title string, title_cn string, run_date date").parquet(str(tmp_path / "archive"))
    days = [1, 2, 3, 4, 9, 10, 20, 28, 29, 30, 44, 45]  # a run may be left out, for days
    for d in days:
        day = begin + dt.timedelta(days=d)
        got = {r.id: (r.pinned, r.seen, r.pos) for r in H.roll_pins(archive, str(tmp_path / "pins"), str(day), 20).collect()}
        kept = spark.createDataFrame([r for r in rows if day - dt.timedelta(days=20) <= r[0] < day], schema)
        assert got == {r.id: (r.pinned, r.seen, r.pos) for r in H.archive_pins(kept).collect()}, d
    plan = H.archive_pins(archive.filter("run_date >= date'2024-02-13' and run_date < date'2024-02-14'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan and "2024-02-13" in plan


def test_batches_equal_those_of_a_sort(spark):
    from pyspark.sql import Window as W

    from newsloom.operators import report as R

    rnd = random.Random(4)
    rows = [(f"d{rnd.choice([1, 1, 1, 2])}", p, rnd.choice(["新 title", "title"]), rnd.choice(["apps", "media"])) for p in rnd.sample(range(10**6), 500)]
    df = spark.createDataFrame(rows, "run_date string, pos long, title string, lane string").cache()
    rn = F.row_number().over(W.partitionBy("run_date", ~X.has_cjk(F.col("title")), F.col("lane") == "apps").orderBy("pos")) - 1
    want = {(r.run_date, r.pos, r.b, r.i) for r in df.select("run_date", "pos", F.floor(rn / 7).alias("b"), (rn % 7).alias("i")).collect()}
    got = {(r.run_date, r.pos, r.batch, r.i) for r in R.batch_assign(df, 7).collect()}
    assert got == want


def _titled(rnd, n):
    """Rows with few words, hosts and times: groups that are all alike, copies, nulls."""
    words = [f"w{k}" for k in range(8)] + ["新模", "模型", "型上"]
    rows = []
    for pos in range(n):
        own = rnd.sample(words, rnd.randint(0, 4))
        story = ["shared", "story", "told"] if rnd.random() < 0.5 else []
        zh, en = [w for w in own if w[0] != "w"], story + [w for w in own if w[0] == "w"]
        rows.append((pos, rnd.choice(["busy", "busy", "a", ""]), None if rnd.random() < 0.05 else 1_700_000_000 + rnd.randrange(0, 40 * 3600, 600), zh, en, rnd.choice(["", f"u{rnd.randrange(n)}"]), rnd.randrange(5)))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "pos long, host string, s long, zh array<string>, en array<string>, canon string, rel long").withColumn("dt", F.timestamp_seconds("s"))


def _like(a, b, percent):
    return any(x and y and 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y)) for x, y in ((a[3], b[3]), (a[4], b[4])))


def _near(a, b):
    return a[1] == b[1] != "" and a[2] is not None and b[2] is not None and abs(a[2] - b[2]) < 6 * 3600 and _like(a, b, 25)


@pytest.mark.parametrize("part, pairs", [(16384, 1 << 20), (7, 3)])
def test_links_are_counted_without_pairs(spark, monkeypatch, part, pairs):
    monkeypatch.setattr(D, "PART", part)
    monkeypatch.setattr(D, "PAIRS", pairs)
    rows = _titled(random.Random(3), 300)
    df = _frame(spark, rows)
    a, b = df.filter("pos % 3 = 0"), df.filter("pos % 4 <> 1")
    right = [r for r in rows if r[0] % 4 != 1]
    want = {r[0]: sum(x[0] != r[0] and _like(r, x, 55) for x in right) for r in rows if r[0] % 3 == 0}
    near = {r[0]: sum(x[0] != r[0] and _near(r, x) for x in right) for r in rows if r[0] % 3 == 0}
    assert {r.pos: r.n for r in D.title_links(a, b).collect()} == want
    assert {r.pos: r.n for r in D.host_links(a, b).collect()} == {p: n for p, n in near.items() if n}
    assert {tuple(r) for r in D.title_edges(a, b).collect()} == {(r[0], x[0]) for r in rows if r[0] % 3 == 0 for x in right if x[0] != r[0] and _like(r, x, 55)}


@pytest.mark.parametrize("first", [2000, 5])
def test_dedup_without_all_pairs_against_one_row_a_step(spark, first):
    rows = _titled(random.Random(4), 240)
    rows = [(*r[:3], r[3], r[4] if r[0] % 10 == 3 or r[0] % 4 else [f"own{r[0]}"], *r[5:]) for r in rows]
    a, b = [r for r in rows if r[0] % 2], [r for r in rows if r[0] % 12 == 0]
    why = lambda x, y: min([k for k, yes in enumerate((x[5] == y[5] != "", _like(x, y, 55), _near(x, y))) if yes], default=None)
    kept, want = [], {}
    for r in sorted(a, key=lambda r: (-r[6], r[0])):
        met = [k for x in b + kept if (k := why(r, x)) is not None]
        want[r[0]] = min(met, default=None)
        if not met:
            kept.append(r)
    made = []

    def counted(df):
        out = handover(df)
        made.append(out.count())
        return out

    df = _frame(spark, rows)
    x, base = df.filter("pos % 2 = 1"), df.filter("pos % 12 = 0")
    got = {r.pos: r.reason for r in D.deduplicate(x, base, x.select("pos", F.struct((-F.col("rel")).alias("s"), F.col("pos").alias("p")).alias("rank")), counted, first).collect()}
    assert got == want and 0 < len(kept) < len(a) and set(want.values()) == {None, 0, 1, 2}


def test_a_group_of_alike_rows_is_not_paired(spark):
    """3000 notes of one host and hour: nine million links, of which no table may hold a tenth."""
    rows = [(pos, "busy", 1_700_000_000, [], ["weekly", "notes", f"a{pos}", f"b{pos}"], "", 0) for pos in range(3000)]
    x = _frame(spark, rows)
    sizes = []

    def counted(df):
        out = handover(df)
        sizes.append(out.count())
        return out

    got = D.deduplicate(x, x.limit(0), x.select("pos", F.col("pos").alias("rank")), counted, 300).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in got} == {None: 1, 2: 2999} and max(sizes) < 900_000
    assert {r.n for r in D.host_links(x, x).collect()} == {2999}


def test_a_date_is_matched_once(spark):
    """Eleven extractions, each behind its own clean-up, took 43 s for 1.1 million dates."""
    from newsloom.functions.scalars import parse_dt

    dates = spark.createDataFrame([("Thu, 1 Feb 2024 10:00:00 +0800",), ("1 Feb 2024 1:00:60",), ("31 Feb 2024 10:00",), ("3 Jan 123 10:00",), (None,)], "t string")
    df = dates.select(parse_dt(F.col("t")).cast("string").alias("at"))
    assert [r.at for r in df.collect()] == ["2024-02-01 02:00:00", None, None, None, None]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_") < 20


def test_upper_case_letter_by_letter(spark):
    import duckdb

    letters = ["straße", "Éñ", "", "plain"] + [chr(k) for k in range(0x80, 0x10000) if len(chr(k).upper()) > 1]
    want = [duckdb.execute("SELECT upper(?)", [x]).fetchone()[0] for x in letters]
    rows = spark.createDataFrame(list(enumerate([*letters, None])), "i int, t string").select("i", X.upper_by_letter(F.col("t")).alias("u")).orderBy("i").collect()
    assert [r.u for r in rows] == [*want, None]


def test_pages_with_entities_that_do_not_end(spark, tmp_path):
    import duckdb

    from newsloom.jobs import more

    html = ["<p>a &amp<b>b</b> &amp; &copy; &copy 2 &lt;", "&", "x&y;z &#39; &#39 &nbsp", None, ""]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.plain, r.n) for r in more.QUERIES["strip_tags"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = {i: (plain, n) for i, plain, n in c.execute(more.ORACLES["strip_tags"]).fetchall() if html[i] is not None}
    assert {i: got[i] for i in want} == want
