from __future__ import annotations

import duckdb
import pytest

from docloom.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
