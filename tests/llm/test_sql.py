"""Every operator that SQL can express against its SQL."""

import duckdb
import pytest

from newsloom.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_operator_equals_its_sql(spark, name):
    at, duck = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    found = duck.execute(registry.ORACLES[name])
    names = [x[0] for x in found.description]
    df = registry.QUERIES[name](spark, at)
    assert sorted(df.columns) == sorted(names)
    number = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(map(number, r)) for r in df.select(*names).collect()) == sorted(tuple(map(number, r)) for r in found.fetchall())
