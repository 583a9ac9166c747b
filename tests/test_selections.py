"""Selections by bitmaps against a scan."""

import random

import pytest
from pyspark.sql import functions as F

from strandframe.operators import selections
from strandframe.operators.selections import label, letter

SCHEMA = "id int, count long, moi string, `a.b` int, points array<struct<pos:int,mut:string>>"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = [(k, rnd.randint(1, 9), rnd.choice(["x", "y", "", None]), k % 3, [(p, rnd.choice("ACGT")) for p in sorted(rnd.sample(range(12), rnd.randint(0, 5)))]) for k in range(70_000)]
    return out + [(-1, 1, "x", None, None), (-2, None, None, 1, [(None, "A"), (3, None), (4, "C")]), *[(-3, 5, "y", 2, [(1, "A")])] * 4]


CASES = [
    ([], []), ([[letter(1, "A")]], []), ([[letter(1, "A"), letter(1, "C")], [label("moi", "x")]], []), ([[label("moi", None)], [label("a.b", 1)]], [letter(4, "C")]),
    ([], [label("moi", ""), letter(0, "T")]), ([[letter(99, "A")]], []), ([[letter(1, "A")], [letter(2, "C")], [letter(3, "G")]], [letter(5, "T"), label("moi", "y")]), ([[]], []),
]


def test_selections_equal_the_scan(spark, rows):
    built = selections.index(spark.createDataFrame(rows, SCHEMA).repartition(6), ("moi", "a.b"), of="one")
    assert built.rows.select(F.count_distinct("__bucket")).first()[0] == 3

    def terms(r):
        return {label("moi", r[2]), label("a.b", r[3])} | {letter(p, m) for p, m in r[4] or () if p is not None and m is not None}

    for having, without in CASES:
        want = [r for r in rows if all(terms(r) & set(c) for c in having) and not terms(r) & set(without)]
        got = built.select(having, without)
        assert got.columns == ["id", "count", "moi", "a.b", "points"]
        assert sorted(r.id for r in got.collect()) == sorted(r[0] for r in want), (having, without)
        assert built.count(having, without).first().n == len(want)


def test_an_index_is_built_anew_for_another_version(spark, tmp_path):
    def write(n):
        spark.range(n).selectExpr("cast(id as int) id", "array(named_struct('pos', 1, 'mut', 'A')) points").write.mode("overwrite").parquet(str(tmp_path / "g"))
        return spark.read.parquet(str(tmp_path / "g"))

    first = write(5)
    assert selections.index(first).count([[letter(1, "A")]]).first().n == 5
    assert selections.version(first) == selections.version(spark.read.parquet(str(tmp_path / "g")))
    assert selections.index(first).rows.inputFiles() == selections.index(first).rows.inputFiles()
    second = write(7)
    assert selections.index(second).count([[letter(1, "A")]]).first().n == 7
    with pytest.raises(ValueError):
        selections.index(spark.createDataFrame([(1, [])], "id int, points array<struct<pos:int,mut:string>>"))
    empty = selections.index(second.limit(0), of="none")
    assert empty.count().first().n == 0 and empty.select([[letter(1, "A")]]).count() == 0
