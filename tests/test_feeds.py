"""Parsers, lenient responses, residue and streams on known strings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.functions.residue import clean_web_junk
from newsloom.operators import responses as M
from newsloom.sources import feeds as B
from newsloom.streaming import jobs as T

AS_OF = "2024-02-01 00:00:00"


def bodies(spark, *texts):
    return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "source_id string, body string")


@pytest.mark.parametrize("name", sorted(B.PARSERS))
def test_parsers_survive_odd_bodies(spark, name):
    more = {"as_of": AS_OF} if name in ("listing", "curated") else {}
    odd = bodies(spark, None, "", "no feed", "{", "[]", "{}", "[1]", "<rss></rss>", "<feed/>")
    assert [r for r in B.PARSERS[name](odd, **more).collect() if r.title] == []


def test_model_feeds(spark):
    stealth = '{"data": [{"id": "stealth/space-bunny-alpha", "name": "Space"}, {"id": "mancer/weaver-alpha", "name": "Weaver (alpha)"}, {"id": ""}]}'
    assert [r.title for r in B.parse_stealth_models(bodies(spark, stealth)).collect()] == ["匿名公测模型：Space"]
    repos = '[{"modelId": "a/b", "likes": 42, "tags": ["X", "y"]}, {"modelId": "c/d", "likes": 42, "tags": ["GGUF"]}, {"modelId": "e/f", "likes": 0}]'
    assert [r.desc for r in B.parse_new_models(bodies(spark, repos), ["gguf"]).collect()] == ["点赞 42；标签 x, y"]
    listed = '{"models": [{"id": "new", "listed_at_iso": "2024-01-30T00:00:00Z"}, {"id": "old", "listed_at_iso": "2022-12-27T00:00:00Z"}, {"id": "undated"}]}'
    assert [r.url.rpartition("/")[2] for r in B.parse_model_listing(bodies(spark, listed), AS_OF).orderBy(F.desc_nulls_last("dt")).collect()] == ["new", "undated"]


def test_items_beside_the_channel(spark):
    body = "<rdf><channel><item><title>in</title></item></channel><item><title>beside &amp;#8217;</title><link>http://x</link></item></rdf>"
    assert [(r.title, r.url) for r in B.parse_rss(bodies(spark, body)).collect()] == [("in", ""), ("beside ’", "http://x")]


ROW = '{"i": 0, "title": "标题", "rel": 11, "info": 1, "fresh": 2, "apptype": "tool"}'


@pytest.mark.parametrize("text, n", [(f"[{ROW}]", 1), (f"```json\n[{ROW}]\n```", 1), (f"[{ROW}, {ROW[:20]}", 1), ("[]", 0), ("nothing", 0), (None, 0)])
def test_lenient_array(spark, text, n):
    rows = M.response_rows(spark.createDataFrame([(1, 0, text)], "batch_id long, model_rank int, text string")).collect()
    assert len(rows) == n and all(r.score.rel == 10 and r.apptype == "tool" for r in rows)


def test_bad_score_is_absent_and_few_rows_are_rejected(spark):
    bad = '[{"i": 0, "title": "标", "rel": "x"}, {"i": 9, "title": "标"}]'
    rows = M.response_rows(spark.createDataFrame([(1, 0, bad), (2, 0, bad)], "batch_id long, model_rank int, text string"))
    assert rows.filter("i = 0").first().score is None
    sent = spark.createDataFrame([(1, 0, True), (1, 1, False)] + [(2, k, True) for k in range(6)], "batch_id long, i int, translate boolean")
    verdict = M.acceptance(rows, sent)
    assert {r.batch_id: r.accepted for r in verdict.collect()} == {1: True, 2: False}
    back = {(r.batch_id, r.i): r.title_cn for r in M.join_back(sent, rows, verdict).collect()}
    assert back[1, 0] == "标" and back[1, 1] is None and back[2, 0] is None and len(back) == 8


LONG = " ".join(f"word{k}" for k in range(60))
LOOP = "Share " + "The problem The result How we found the proof " * 2


@pytest.mark.parametrize(
    "text, want",
    [
        (f':last-child]:mb-0"> {LONG}', LONG),
        (f"Loading… {LONG}", LONG),
        (f"Share We begin. {LONG}", f"We begin. {LONG}"),
        (LOOP + LONG, LONG),
        (f"The page shows a Loading state. {LONG}", f"The page shows a Loading state. {LONG}"),
        ("Loading… tiny", "Loading… tiny"),
        (f"{LONG} ⁠(opens in a new window) end", f"{LONG} end"),
        (None, ""),
        ("", ""),
    ],
)
def test_residue(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(clean_web_junk(F.col("t")).alias("t")).first().t == want


def landing(spark, path, rows):
    spark.createDataFrame(rows, "id string, title_cn string, seen_at timestamp").coalesce(1).write.mode("append").parquet(path)


def test_pins_hold_over_batches(spark, tmp_path):
    at = lambda day: dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    path = str(tmp_path / "in")
    landing(spark, path, [("a", "一", at(0)), ("b", "二", at(0))])
    stream = spark.readStream.schema("id string, title_cn string, seen_at timestamp").parquet(path)
    seen = []

    def run():
        q = T.title_pins(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q.foreachBatch(lambda df, k: seen.extend((r.id, r.pinned) for r in df.collect())).start().awaitTermination()

    run()
    landing(spark, path, [("a", "三", at(2))])
    run()
    landing(spark, path, [("c", "四", at(60))])
    run()
    landing(spark, path, [("a", "五", at(61))])
    run()
    assert [x for x in seen if x[0] == "a"] == [("a", "一"), ("a", "一"), ("a", "五")]


def test_pins_of_late_rows(spark, tmp_path):
    """A row 20 days behind the newest is still within the horizon and keeps its wording."""
    at = lambda day: dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    path = str(tmp_path / "in")
    out = []
    for rows in ([("a", "一", at(30))], [("b", "二", at(10)), ("a", "三", at(31))], [("b", "四", at(12))]):
        landing(spark, path, rows)
        stream = spark.readStream.schema("id string, title_cn string, seen_at timestamp").parquet(path)
        q = T.title_pins(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q.foreachBatch(lambda df, k: out.extend((r.id, r.pinned, k) for r in df.collect())).start().awaitTermination()
    got = spark.createDataFrame(out, "id string, pinned string, k long")
    assert {r.id: r.pinned for r in T.latest(got, "id").collect()} == {"a": "一", "b": "二"}


def test_library_grows_over_batches(spark, tmp_path):
    path, lib = str(tmp_path / "in"), str(tmp_path / "lib")
    cols = "url string, pos long, title string, summary string, type string, score double, rel int"
    library = spark.createDataFrame([], "url string, title string, summary string, type string, score double, rel int, first_seen date, last_seen date")
    for k, title in enumerate(["old", ""]):
        spark.createDataFrame([("u", 1, title, "s", "", 7.0, k), (f"v{k}", 2, "t", "", "", 6.5, 5)], cols).coalesce(1).write.mode("append").parquet(path)
        q = T.cases_upsert(spark.readStream.schema(cols).parquet(path), library, lib, "2024-02-01").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q.start().awaitTermination()
    rows = {r.url: r for r in spark.read.parquet(f"{lib}/v=000000000001").collect()}
    assert set(rows) == {"u", "v0", "v1"} and rows["u"].title == "old" and rows["u"].rel == 1


def test_a_restarted_stream_of_mixed_bodies_loses_and_repeats_nothing(spark, tmp_path):
    def land(*rows):
        spark.createDataFrame(rows, "page long, kind string, body string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def drain():
        stream = spark.readStream.schema("page long, kind string, body string").parquet(str(tmp_path / "in"))
        T.ingest_mixed(stream).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).format("parquet").start(str(tmp_path / "out")).awaitTermination()
        return sorted((r.page, r.title) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    rss = "<rss><item><title>r{0}</title></item><item><title>s{0}</title></item></rss>"
    land((1, "json", '[{"title": "j1"}]'), (2, "rss", rss.format(2)), (3, "json", "{"), (4, "rss", None))
    assert drain() == [(1, "j1"), (2, "r2"), (2, "s2")]
    land((5, None, rss.format(5)), (6, "json", '{"items": [{"title": "j6"}]}'))
    assert drain() == drain() == [(1, "j1"), (2, "r2"), (2, "s2"), (5, "r5"), (5, "s5"), (6, "j6")]
