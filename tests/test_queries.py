"""Each query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from docloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLE:
        return
    result = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)


def test_whole_line_graph(spark, sf_dir, duck):
    after = {}
    for s, d in duck.execute("select distinct l_partkey, (l_partkey * 7 + l_suppkey) % 2000 from lineitem").fetchall():
        after.setdefault(s, set()).add(d)
    level, front = {3: 0}, {3}
    for k in range(1, 7):
        front = {d for s in front for d in after.get(s, ())} - set(level)
        level |= dict.fromkeys(front, k)
    rows = registry.QUERIES["upstream_bfs"](spark, sf_dir).collect()
    assert len(rows) == len(level) and {r.node: r.level for r in rows} == level


@pytest.mark.parametrize("name, table", [("version_chain", "orders"), ("bridge_cascade", "lineitem")])
def test_no_row_is_left_out(spark, sf_dir, duck, name, table):
    assert registry.QUERIES[name](spark, sf_dir).count() == duck.execute(f"select count(*) from {table}").fetchone()[0]


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES and set(registry.ORACLE) <= set(registry.QUERIES)
