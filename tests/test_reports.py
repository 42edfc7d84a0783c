"""Run reports of several shapes."""

import json

from newsloom.operators import report as R
from newsloom.sources import reports as V

# the shape of a published report, with hosts made up
NOW = {
    "generated_at": "2026-11-21 08:10",
    "counts": {"total": 153, "repeat": 57, "byLevel": {"top": 15, "watch": 54, "normal": 84}},
    "sources": [
        {"id": "one", "ok": True, "via": "hub.example", "n": 6, "raw": 10, "diag": ["one.example:desc中位151<300跳过", "hub.example:OK(10条/desc6410)"]},
        {"id": "two", "ok": False, "via": None, "n": 0, "diag": ["two.example:HTTPError404", "hub.example:ParseError2"]},
        {"id": "_curated", "ok": True, "via": "c.example", "n": 10, "raw": 10, "diag": ["HTTP200"]},
    ],
    "degraded": [{"id": "two", "lane": "apps", "reason": "two.example:HTTPError404"}],
    "later": {"field": [1]},
}
OLD = {"counts": {"total": 4, "stale": 1}, "sources": [{"source_id": "one", "raw": 9, "taken": 4}], "degraded": [{"source_id": "three", "reason": "gone"}]}


def stored(spark, tmp_path, *docs):
    path = str(tmp_path / "reports")
    rows = spark.createDataFrame([(f"2026-11-{k + 1:02d}", x) for k, x in enumerate(docs)], "run_date string, report string")
    V.write_day_reports(rows.selectExpr("cast(run_date as date) as run_date", "report"), path)
    return V.read_reports(spark, path)


def test_shapes_are_read_by_one_scan(spark, tmp_path):
    reports = stored(spark, tmp_path, json.dumps(NOW, ensure_ascii=False, indent=1), json.dumps(OLD), "no json", json.dumps([1]))
    counts = {str(r.run_date)[-2:]: tuple(r)[1:] for r in V.report_counts(reports).collect()}
    assert counts == {"01": (False, "2026-11-21 08:10", 153, 57, 15, 54, 84), "02": (False, None, 4, None, None, None, None), "03": (True, *[None] * 6), "04": (False, *[None] * 6)}
    sources = {(str(r.run_date)[-2:], r.source_id): (r.ok, r.via, r.n, r.raw, r.lane, r.reason) for r in V.report_sources(reports).collect()}
    assert sources == {
        ("01", "one"): (True, "hub.example", 6, 10, None, None), ("01", "two"): (False, None, 0, None, "apps", "two.example:HTTPError404"),
        ("01", "_curated"): (True, "c.example", 10, 10, None, None), ("02", "one"): (True, None, 4, 9, None, None),
    }
    paths = V.report_paths(reports)
    assert sorted((r.source_id, r.path_rank, r.outcome, r.host, r.n, r.desc_median, r.code) for r in paths.collect() if r.source_id != "_curated") == [
        ("one", 0, "short", "one.example", None, 151, None), ("one", 1, "ok", "hub.example", 10, 6410, None), ("two", 0, "error", "two.example", None, None, 404), ("two", 1, "error", "hub.example", None, None, None),
    ]
    best = {r.source_id: (r.ok_paths, r.paths, r.best_host) for r in R.best_path(V.attempts(paths)).collect()}
    assert best["one"] == (1, 2, "hub.example") and best["two"] == (0, 2, None)


def test_a_report_round_trips(spark, tmp_path):
    counts = spark.createDataFrame([("2026-11-01", 153, 57, 15, 54, 84), ("2026-11-02", 0, 0, 0, 0, 0)], "run_date string, total long, repeat long, top long, watch long, normal long")
    sources = spark.createDataFrame([("2026-11-01", s["id"], s["ok"], s["via"], s["n"], s.get("raw"), s["diag"]) for s in NOW["sources"]], "run_date string, id string, ok boolean, via string, n long, raw long, diag array<string>")
    degraded = spark.createDataFrame([("2026-11-01", "two", "apps", "two.example:HTTPError404")], "run_date string, id string, lane string, reason string")
    rows = V.day_reports(counts.selectExpr("cast(run_date as date) as run_date", "* except (run_date)"), *[x.selectExpr("cast(run_date as date) as run_date", "* except (run_date)") for x in (sources, degraded)]).collect()
    assert len(rows) == 1  # a run without items writes nothing
    got = json.loads(rows[0].report)
    want = {k: v for k, v in NOW.items() if k != "later"} | {"generated_at": "2026-11-01 00:00", "sources": sorted(({k: v for k, v in s.items() if v is not None} for s in NOW["sources"]), key=lambda s: s["id"])}
    assert got == want
    assert V.report_counts(stored(spark, tmp_path, rows[0].report)).first().watch == 54
