"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import math

import duckdb
import pytest

from strandframe.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b)))
    return a == b


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(round(v, 6)) if isinstance(v, float) else str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, sf, name):
    df = registry.queries()[name](spark, sf)
    names, want = duck(sf, registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(names)
    cols = sorted(names)
    got = ordered([tuple(r[c] for c in cols) for r in df.collect()])
    want = ordered([tuple(r[names.index(c)] for c in cols) for r in want])
    assert len(got) == len(want)
    assert not [(g, w) for g, w in zip(got, want, strict=True) if not all(map(same, g, w))][:5]


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0
