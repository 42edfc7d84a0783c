"""Every query against its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from newsloom.jobs import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else f"{v:.9g}"
    return "null" if v is None else v.isoformat(" ") if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(registry.ORACLES[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    norm = lambda rows: [tuple(x.removesuffix(".0") for x in r) for r in rows]
    assert sorted(norm(got)) == sorted(norm(want))


def test_daily_brief_survives_an_empty_day(spark):
    from newsloom.operators import select as L
    from newsloom.sources.items import items

    assert L.brief(items(spark, DATA).filter("false")).count() == 0


#: What the SQL has to show on sf0.01, so that agreeing with it says something.
SHOWS = {
    "also_in": "count(*) > 0",
    "cross_source_fold": "count(*) > 0",
    "keyword_hit": "bool_or(hit) AND NOT bool_and(hit)",
    "keyword_boost": "bool_or(kw_boost) AND NOT bool_and(kw_boost)",
    "fallback_total": "count(*) > 0",
    "title_pin": "bool_or(was_pinned) AND NOT bool_and(was_pinned)",
    "cross_day_repeat": "bool_or(is_repeat) AND NOT bool_and(is_repeat)",
    "brief_counts": "max(repeat) > 0 AND min(repeat) = 0",
    "dup_url": "count(*) > 0",
    "dup_title_jaccard": "count(*) > 0",
    "dup_host_time": "count(*) > 0",
    "dedup_drop_counts": "min(n) > 0",
    "batch_assign": "max(batch) > 0",
    "batch_plan_counts": "max(batches) > 1",
    "response_acceptance": "bool_or(accepted) AND NOT bool_and(accepted) AND bool_or(low_yield) AND NOT bool_and(low_yield)",
    "probe_freshness": "count(DISTINCT flag) >= 3",
    "pick_path": "count(*) > 0",
    "degraded_sources": "count(*) > 0",
    "keyword_type": "count(DISTINCT type) = 11",
    "coarse_type": "count(DISTINCT type) > 5",
    "case_types": "count(*) > 1",
    "case_purge": "count(*) > 0",
    "curated_stale": "bool_or(stale) AND NOT bool_and(stale)",
    "body_fill": "count(desc_from) > 0 AND count(desc_from) < count(*)",
    "body_fetch_worklist": "count(*) > 0",
    "translate_worklist": "count(*) > 0",
    "nav_fragment": "bool_or(nav) AND NOT bool_and(nav)",
    "body_acceptance": "bool_or(accepted) AND NOT bool_and(accepted)",
    "body_join_back": "count(desc_zh) > 0 AND count(desc_zh) < count(*) AND count(DISTINCT left(desc_zh, 2)) = 2",
    "daily_run": "bool_or(is_repeat) AND NOT bool_and(is_repeat) AND bool_or(was_pinned) AND NOT bool_and(was_pinned)",
    "pins_rolled": "count(DISTINCT seen) > 5",
    "source_paths": "bool_or(ok) AND NOT bool_and(ok) AND count(DISTINCT via) = 3 AND count(*) FILTER (diag LIKE '%跳过%') > 0",
    "fetched_items": "count(DISTINCT via) = 3",
    "window_by_settings": "bool_or(stale) AND NOT bool_and(stale)",
    "report_source_rows": "count(reason) > 0 AND count(reason) < count(*) AND count(via) > 0",
    "report_paths": "count(DISTINCT outcome) = 3",
    "report_counts": "count(repeat) > 0 AND count(repeat) < count(*)",
    "reports_read": "count(reason) > 0 AND count(reason) < count(*)",
}


@pytest.fixture(scope="module")
def larger():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SHOWS))
def test_sql_shows_both_outcomes(larger, name):
    assert larger.execute(f"SELECT {SHOWS[name]} FROM ({registry.ORACLES[name]})").fetchone()[0], name


def test_fold_folds(larger):
    sql = registry.ORACLES
    assert larger.execute(f"SELECT count(*) FROM ({sql['cross_source_fold']})").fetchone()[0] < larger.execute(f"SELECT count(*) FROM ({sql['window_with_floor']})").fetchone()[0]


def test_the_brief_takes_twenty_of_a_source():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.1/{t}.parquet'")
    most = "SELECT max(n) FROM (SELECT count(*) AS n FROM ({}) GROUP BY run_date, source_id)"
    assert c.execute(most.format(registry.ORACLES["daily_brief"])).fetchone()[0] > 8
    assert c.execute(most.format(registry.ORACLES["window_with_floor"])).fetchone()[0] == 8
