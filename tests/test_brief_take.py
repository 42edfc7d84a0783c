"""The queries over a whole brief take twenty of a source: Spark and SQL against a plain run over two sources with 25 items in the window."""

from fractions import Fraction

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from newsloom.jobs import registry

DAY, SOURCES = "2024-02-01", ["src8", "src16"]  # of the lane `model`, which looks back 504 hours
#: Dated ids of the last day that are neither stories nor notes, in the window: 25 of each source.
IDS = [d for d in range(0, 900, 3) if d // 30 % 3 != 2 and d % 5 != 3 and d % 53 != 0 and d * 37 % 900 <= 504][:50]
TITLES = {d: f"Release {d}" if d % 4 == 0 else f"Item {d}" for d in IDS}
TEXTS = {d: TITLES[d] + "\n" + "word " * (100 if d % 2 else 1) for d in IDS}


def plain(take):
    """The brief in its order: dicts of pos, total, kw_boost, level."""
    rows = []
    for k in range(len(SOURCES)):
        newest = sorted(IDS[k::2], key=lambda d: (d * 37 % 900, d))[:take]
        for d in newest:
            base = min(100, (45 * (d * 7 % 11) + 30 * (d * 5 % 11) + 25 * (d * 3 % 11) + 55) // 10)
            raised = d % 4 == 0 and base >= 70
            rows.append({"pos": d, "age": d * 37 % 900, "total": min(100, base + 10 * raised) / 10, "kw_boost": raised})
    rows.sort(key=lambda r: (-r["total"], r["pos"]))
    top = min(15, max(4, round(Fraction(12 * len(rows), 100))))
    watch = top + round(Fraction(35 * len(rows), 100))
    for place, r in enumerate(rows):
        r["level"] = "top" if place < top and r["total"] >= 8 else "watch" if place < watch and r["total"] >= 6.5 else "normal"
    return sorted(rows, key=lambda r: (["top", "watch", "normal"].index(r["level"]), -r["total"], r["age"], r["pos"]))


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """Sorted rows of a query, of the columns named, the same by Spark and by its SQL."""
    at, duck = tmp_path_factory.mktemp("brief"), duckdb.connect()
    docs = {"doc_id": IDS, "text": [TEXTS[d] for d in IDS], "lang": ["en"] * 50, "source": SOURCES * 25, "n_chars": [len(TEXTS[d]) for d in IDS]}
    for name, columns in {"documents": docs, "labels": {"doc_id": IDS, "quality": [1] * 50, "toxic": [0] * 50}}.items():
        pq.write_table(pa.table(columns), at / f"{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet'")

    def run(name, *columns):
        by_spark = sorted(map(tuple, registry.QUERIES[name](spark, str(at)).select(*columns).collect()), key=str)
        by_sql = sorted(duck.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall(), key=str)
        assert by_spark == by_sql
        return by_spark

    return run


def same(got, want):
    """The rows are those of a plain run with twenty of a source; with eight there were others."""
    assert want(plain(8)) != want(plain(20))
    assert got == sorted(want(plain(20)), key=str)


def test_keyword_boost(rows):
    same(rows("keyword_boost", "pos", "total", "kw_boost"), lambda b: [(r["pos"], r["total"], r["kw_boost"]) for r in b])


def test_assign_levels(rows):
    same(rows("assign_levels", "run_date", "pos", "total", "level"), lambda b: [(DAY, r["pos"], r["total"], r["level"]) for r in b])


def test_brief_order(rows):
    same(rows("brief_order", "run_date", "pos", "ord"), lambda b: [(DAY, r["pos"], k + 1) for k, r in enumerate(b)])


def test_lane_counts(rows):
    same([x for x in rows("lane_counts", "run_date", "lane", "n") if x[2]], lambda b: [(DAY, "model", len(b))])


def test_level_counts(rows):
    same(rows("level_counts", "run_date", "top", "watch", "normal"), lambda b: [(DAY, *[sum(r["level"] == x for r in b) for x in ("top", "watch", "normal")])])


def test_brief_counts(rows):
    levels = ("top", "watch", "normal")
    want = lambda b: [(DAY, None, None, len(b), 0, 0), (DAY, "model", None, len(b), 0, 0), *[(DAY, None, x, sum(r["level"] == x for r in b), 0, 0) for x in levels]]
    same(rows("brief_counts", "run_date", "lane", "level", "n", "stale", "repeat"), want)


def test_tier_inversion(rows):
    want = lambda b: [(DAY, min(r["total"] for r in b if r["level"] == "top"), max((r["total"] for r in b if r["level"] == "watch"), default=None), False)]
    same(rows("tier_inversion", "run_date", "top_min", "watch_max", "inverted"), want)


def test_batch_plan_counts(rows):
    same(rows("batch_plan_counts", "run_date", "translate", "want_type", "n", "batches"), lambda b: [(DAY, True, False, len(b), -(-len(b) // 25))])


def test_batch_assign(rows):
    same(rows("batch_assign", "run_date", "pos", "batch", "i"), lambda b: [(DAY, d, k // 25, k % 25) for k, d in enumerate(sorted(r["pos"] for r in b))])


def test_publish_projection(rows):
    want = lambda b: [(DAY, r["pos"], TEXTS[r["pos"]], TEXTS[r["pos"]][:200], "译文 " + TEXTS[r["pos"]] if r["level"] == "top" else None) for r in b]
    same(rows("publish_projection", "run_date", "pos", "descr", "summary", "desc_zh"), want)


def test_body_fetch_worklist(rows):
    same(rows("body_fetch_worklist", "run_date", "pos", "ord"), lambda b: [(DAY, r["pos"], k + 1) for k, r in enumerate(b) if len(TEXTS[r["pos"]]) < 300][:8])


def test_translate_worklist(rows):
    long = lambda b: [r["pos"] for r in b if r["level"] == "top" and len(TEXTS[r["pos"]]) >= 300]
    same(rows("translate_worklist", "run_date", "pos", "batch", "body"), lambda b: [(DAY, d, k // 5, TEXTS[d][:1200]) for k, d in enumerate(long(b)[:20])])
