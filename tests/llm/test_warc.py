import hashlib

from strandframe.llm import warc

FAKE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.0 y WARC/1."


def expected(rows):
    full = [(i, h or "") for i, h in rows]
    last = {}
    for i, h in full:
        if len(h.encode()) >= 1000 and i is not None:
            last[h] = max(i, last.get(h, i))
    out = []
    for i, h in full:
        refers = last[h] if i is not None and h in last and last[h] != i else None
        out.append((i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), "revisit" if refers is not None else "response", refers, True))
    return out


def test_round_trip_with_magic_copies_nulls_and_long_payloads(spark):
    big = "é<p>" * 400
    rows = [(1, "a"), (2, None), (3, ""), (4, FAKE), (5, big), (6, big), (7, big + FAKE), (8, big + FAKE), (9, "WARC/1."), (10, "\r\n" * 600), (None, big), (11, "z" * 3_000_000), (12, "a")]
    rows += [(i, f"page {i} " * (i % 90) + (FAKE if i % 7 == 0 else "")) for i in range(100, 400)]
    pages = spark.createDataFrame([(i, "http://h/a b", h) for i, h in rows], "page_id long, url string, html string").repartition(3)
    got = [tuple(r) for r in warc.round_trip(pages).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_splits_inside_records_do_not_matter(spark):
    rows = [(i, f"text {i} " * 40 + (FAKE * 3 if i % 3 == 0 else "")) for i in range(200)]
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string").coalesce(1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")
        got = sorted(tuple(r) for r in warc.round_trip(pages).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected(rows)


def test_empty_table_and_broken_chain(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string, id int")
    assert warc.round_trip(pages).count() == 0
    good = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(good * 3 + b"WARC/1.0\r\nContent-Length: 99999\r\n\r\nlost" + good)
    got = warc.read(spark, f"file://{tmp_path}/x.warc").orderBy("start").collect()
    assert [bytes(r.payload) for r in got] == [b"ab"] * 3
    (tmp_path / "y.warc").write_bytes(good * 3 + good[:-3])
    assert [bytes(r.payload) for r in warc.read(spark, f"file://{tmp_path}/y.warc").collect()] == [b"ab"] * 3
    (tmp_path / "z.warc").write_bytes(good * 3)
    assert [bytes(r.payload) for r in warc.read(spark, f"file://{tmp_path}/z.warc").collect()] == [b"ab"] * 3


def test_record_headers(spark, tmp_path):
    big = "b" * 1200
    pages = spark.createDataFrame([(1, "u1", big), (1, "u2", big), (1, "u3", "c"), (2, "u4", big), (3, "u5", big)], "page_id long, url string, html string")
    warc.write(pages, f"file://{tmp_path}/a")
    got = warc.read(spark, f"file://{tmp_path}/a").collect()
    assert len({r.record_id for r in got}) == 5
    response = {r.record_id for r in got if r.type == "response" and len(r.payload) == 1200}
    assert {r.refers for r in got if r.type == "revisit"} == response and len(response) == 1
    text = "".join(p.read_bytes().decode() for p in (tmp_path / "a").glob("part-*"))
    assert text.count("WARC-Profile: " + warc.PROFILE) == text.count("WARC-Type: revisit") == 3


def test_separators_in_urls_lose_no_record(spark):
    rows = [(i, f"text {i} " * 200) for i in range(40)]
    pages = spark.createDataFrame([(i, f"http://h/WARC/1.1/{i}?WA RC/1.=WARC/1." if i % 5 == 3 else "http://h/", h) for i, h in rows], "page_id long, url string, html string").coalesce(1)
    assert sorted(tuple(r) for r in warc.round_trip(pages).collect()) == expected(rows)
