"""Queries with SQL: the same rows as DuckDB on the same tables."""

import os
import textwrap

import duckdb
import pytest

from strandframe.llm import licenses, lines, queries, sharding

TABLES = "documents embeddings pages benchmark labels conversations".split()


def duck(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in cur.fetchall()), key=repr), sorted(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    want, names = duck(sf, queries.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) == want


def test_lines_near_the_threshold_are_counted_exactly(spark):
    rows = []
    for line in range(30):
        for site in range(1 + line % 10):
            for copy in range(3):
                rows.append((len(rows), f"own {len(rows)}\n\n  line {line} \t\nend {len(rows)}", f"s{site}"))
    rows += [(len(rows), None, "s1"), (len(rows) + 1, "", "s1"), (len(rows) + 2, "line 9\nline 9", None), (None, "line 9\nx", "s0")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, __extra int").repartition(3)
    got = {r.doc_id: r for r in lines.clean(docs, sites=6).collect()}
    spread = lambda text, n: text is not None and text.strip().startswith("line ") and int(text.strip()[5:]) % 10 + 1 >= n
    for i, text, _ in rows:
        kept = None if text is None else "\n".join(x for x in text.split("\n") if not spread(x, 6))
        assert got[i]["__clean"] == kept
    assert got[len(rows) - 2]["__removed"] == 2 and lines.clean(docs.limit(0)).count() == 0


def test_license_spellings_and_odd_rows(spark):
    mit = licenses.KNOWN["MIT"][0]
    rows = [
        (1, mit.upper().replace("LICENSE", "LICENCE")), (2, "intro\nReleased  under the MIT Licence!\nmore"), (3, None), (4, ""), (5, "..."),
        (6, mit + " more"), (7, "Copyright 2020 Me\n" + mit), (None, "Licensed under CC BY-NC 4.0."),
    ]
    got = {r.doc_id: (r["__license"], r["__notices"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", []), 2: (None, ["MIT"]), 3: (None, []), 4: (None, []), 5: (None, []), 6: (None, []), 7: ("MIT", []), None: ("CC-BY-NC-4.0", ["CC-BY-NC-4.0"])}


@pytest.mark.parametrize("width", [60, 72, 80, 120, 10**9])
def test_known_texts_are_found_however_they_are_wrapped(spark, width):
    rows, want = [], {}
    for name, texts in licenses.KNOWN.items():
        for t in texts:
            by_paragraph = "\n\n".join(textwrap.fill(p, width) for p in t.split("\n\n"))
            for v in (by_paragraph, textwrap.fill(t, width), textwrap.indent(by_paragraph, " * ", lambda line: True), by_paragraph.replace("\n", "\r\n")):
                want[len(rows)] = name
                rows.append((len(rows), v))
    got = {r.doc_id: r["__license"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_stock_files(spark):
    stock = "MIT License\n\nCopyright (c) 2023 A. Person, B. Person and the\nWidget contributors\n\n" + licenses.KNOWN["MIT"][0]
    bsd = "Copyright 2011-2020, Some Group, Inc.\nAll rights reserved.\n\n" + textwrap.fill(licenses.KNOWN["BSD-3-Clause"][0], 78)
    close = "Copyright (c) 2020 X\n\n" + licenses.KNOWN["MIT"][0].replace("COPYRIGHT HOLDERS", "")
    rows = [(1, stock.replace("and the\n", "and the ")), (2, bsd), (3, close), (4, "no license\n" * 3000 + "SPDX-License-Identifier: MIT\n" + "x" * 100_000)]
    got = {r.doc_id: (r["__license"], r["__notices"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("MIT", []), 2: ("BSD-3-Clause", []), 3: (None, []), 4: (None, ["MIT"])}


def test_notices_without_a_year_and_long_ones(spark):
    mit, bsd = licenses.KNOWN["MIT"][0], licenses.KNOWN["BSD-3-Clause"][0]
    ten = "Copyright (c) 2020 " + ",\n".join(f"A Very Long Holder Name, Number {i}, of Somewhere" for i in range(10))
    found = [
        ("Copyright Joe Bloggs and contributors. All rights reserved.\n\n" + mit, "MIT"), ("Copyright The Foo Authors.\n\n" + bsd, "BSD-3-Clause"),
        ("MIT License\nCopyright Joe Bloggs\n\n" + mit, "MIT"), (ten + "\n\n" + mit, "MIT"), (ten + "\n" + mit, "MIT"),
        ("Copyright A. All rights reserved.\nCopyright B.\n\nCopyright C\n" + mit, "MIT"),
        (" * Copyright The Foo Authors.\n *\n" + textwrap.indent(textwrap.fill(mit, 70), " * "), "MIT"),
        ("Copyright The Foo Authors " + "x" * 200_000 + "\n\n" + mit, "MIT"), ("Copyright X\n" + "line\n" * 50_000 + "\n" + mit, "MIT"),
        (mit + "\n\nCopyright holders must be paid.", None), ("Copyright Joe\n\nPay me.\n\n" + mit, None),
        ("Copyright Joe\n\n" + mit.replace("COPYRIGHT HOLDERS", ""), None), ("Copyright Joe Bloggs", None),
    ]
    found += [("Copyright 2020 The X Authors\n" + t, name) for name, texts in licenses.KNOWN.items() for t in texts]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(found)], "doc_id long, text string")
    got = {r.doc_id: r["__license"] for r in licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(found))] == [n for _, n in found]
    table, con = docs.toPandas(), duckdb.connect()
    con.register("documents", table)
    assert dict(con.execute(f"SELECT doc_id, license FROM ({licenses.oracle()})").fetchall()) == got


def test_long_licenses_are_known_by_digest(spark):
    folder, files = "/usr/share/common-licenses", {"Apache-2.0": "Apache-2.0", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if not all(os.path.exists(f"{folder}/{f}") for f in files.values()):
        pytest.skip("no license files on this machine")
    texts = {n: open(f"{folder}/{f}").read() for n, f in files.items()}
    rows = [(n, v) for n, t in texts.items() for v in (t, " ".join(t.split()), t.replace("\n", "\r\n"))]
    assert "license" in licenses.canonical_text(texts["MPL-2.0"])
    got = licenses.scan(spark.createDataFrame(rows, "name string, text string")).collect()
    assert [r["__license"] for r in got] == [r["name"] for r in got]


def test_license_rows_that_repeat_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "SPDX-License-Identifier: MIT")] * 3 + [(None, None)] * 2, "doc_id long, text string")
    got = licenses.scan(docs).collect()
    assert len(got) == 5 and sum(r["__license"] == "MIT" for r in got) == 3
    assert licenses.scan(docs.limit(0)).count() == 0


def test_notices_without_the_word_license_and_long_lines(spark):
    flat = {n: " ".join(licenses.KNOWN[n][0].split()) for n in ("ISC", "Zlib")}
    rows = [(1, "intro\n" + flat["ISC"] + "\nmore"), (2, "intro\n" + flat["Zlib"]), (3, "intro\nReleased under the MIT License" + "." * 20_000), (4, "intro\nPlain Words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r["__notices"] for r in licenses.scan(docs).collect()} == {1: ["ISC"], 2: ["Zlib"], 3: ["MIT"], 4: []}
    own = licenses.scan(docs, known={"Own": ("plain words",)})
    assert {r.doc_id: r["__notices"] for r in own.collect()} == {1: [], 2: [], 3: [], 4: ["Own"]}


def test_sharding_is_even_and_stable(spark):
    table = sharding.fill(sharding.SHARDS, sharding.SLOTS)
    sizes = [table.count(i) for i in range(len(sharding.SHARDS))]
    assert max(sizes) - min(sizes) <= 1 and -1 not in table
    fewer = sharding.fill(sharding.SHARDS[:-1], sharding.SLOTS)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != len(sharding.SHARDS) - 1)
    assert moved / len(table) < 0.25
    docs = spark.createDataFrame([(None, "a", 1), (1, "b", 2), (1, "b", 2)], "doc_id long, shard string, slot int")
    got = sharding.place(docs, slot_name="slot").collect()
    assert len(got) == 3 and len({r.shard for r in got if r.doc_id == 1}) == 1
    assert sorted((r.shard_in, r.slot_in) for r in got) == [("a", 1), ("b", 2), ("b", 2)]
    assert sharding.place(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.place(docs, key_col="shard")
    with pytest.raises(ValueError):
        sharding.fill(("a", "a"), 11)
    with pytest.raises(ValueError):
        sharding.fill(("a",), 10)
