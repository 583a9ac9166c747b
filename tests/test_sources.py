"""Files read by byte ranges: every record once, wherever the ranges end."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from strandframe.sources import readers, writers


def made(n, seed=0):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        size = rnd.choice([0, 1, 5, 60, 60, 400])
        seq = "".join(rnd.choice("ACGTN") for _ in range(size))
        rows.append((f"r{k}", rnd.choice([None, "@x +y", "a=1"]), seq, [rnd.choice([10, 31, 31, 0, 40]) for _ in seq]))
    return rows


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True, False])
def test_fastq_with_any_quality_and_split(spark, tmp_path, ending, last):
    rows = [r for r in made(300) if r[2]]
    text = ending.join(x for i, d, s, q in rows for x in (f"@{i} {d}" if d else f"@{i}", s, "+", "".join(chr(v + 33) for v in q))) + (ending if last else "")
    (tmp_path / "a.fastq").write_bytes(text.encode())
    with gzip.open(tmp_path / "b.fastq.gz", "wb") as f:
        f.write(text.encode())
    assert any(q[0] == 31 for *_, q in rows)
    for name, split in (("a.fastq", 1 << 20), ("a.fastq", 997), ("a.fastq", 61), ("b.fastq.gz", 61)):
        got = [tuple(r) for r in readers.read_fastq(spark, str(tmp_path / name), split).collect()]
        assert sorted(got) == sorted(rows, key=lambda r: r[0]) if None not in {r[1] for r in rows} else sorted(got, key=lambda r: r[0]) == sorted(rows, key=lambda r: r[0])
    assert readers.read_fastq(spark, str(tmp_path), 5000).count() == 2 * len(rows)


def test_bam_is_read_back_whatever_the_split(spark, tmp_path):
    rnd = random.Random(2)
    rows = []
    for k, (i, _, seq, quals) in enumerate(made(4000, 3)):
        mapped = k % 7 > 0
        rows.append((i, "refA" if k % 3 else "refB", k, 0, f"{len(seq)}M" if seq else "*", seq or "*", quals if k % 5 and seq else None, rnd.choice([None, "f1"]), rnd.choice([None, 3])) if mapped else (i, "*", -1, 4, "*", seq or "*", quals if seq else None, None, None))
    rows.append(("long", "refA", 5, 16, "200000M", "ACGT" * 50_000, [7] * 200_000, None, 1))
    df = spark.createDataFrame(rows, "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string, nm int").coalesce(1)
    assert writers.write_bam(df, f"{tmp_path}/bam", {"refA": 300_000, "refB": 9000}) == len(rows)
    names = df.columns
    for split in (1 << 27, 100_000, 20_011):
        got = readers.read_bam(spark, f"{tmp_path}/bam", "t", split=split)
        assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(rows, key=repr)
    assert readers.read_bam(spark, f"{tmp_path}/bam", reference="refB").filter("reference_name <> 'refB'").count() == 0
    assert readers.read_bam(spark, f"{tmp_path}/bam", reference="refB").count() == sum(r[1] == "refB" for r in rows)
    assert readers.read_bam(spark, f"{tmp_path}/bam", reference="*").count() == sum(r[1] == "*" for r in rows)
    assert readers.read_bam(spark, f"{tmp_path}/bam", split=20_011).rdd.getNumPartitions() > 5


def test_sam_and_fastq_round_trips(spark, tmp_path):
    rows = [(i, "t", "refA", 3, 0, f"{len(s)}M", s, q, None, 2) for i, _, s, q in made(50, 5) if s]
    df = spark.createDataFrame(rows, readers.ALIGNMENTS)
    writers.write_sam(df, f"{tmp_path}/sam")
    assert sorted(map(tuple, readers.read_sam(spark, f"{tmp_path}/sam", "t").collect())) == sorted(rows, key=lambda r: r[0])
    assert readers.read_sam(spark, f"{tmp_path}/sam", "t").agg(F.sum("nm")).first()[0] == 2 * len(rows)


ALIGNED = "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string, nm int"


def aligned(n, references, seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        name = rnd.choice([*references, *references, "*"])
        seq = "".join(rnd.choice("ACGT") for _ in range(80))
        rows.append((f"r{k}", name, -1 if name == "*" else rnd.randrange(references[name] - 90), 4 if name == "*" else 0, "*" if name == "*" else "30M5D50M", seq, [30] * 80, None, None))
    return rows


def test_only_the_ranges_of_a_reference_are_read(spark, tmp_path):
    from strandframe.sources import ranges

    references = {"a": 3_000_000, "b": 40_000, "c": 500_000, "empty": 100}
    rows = aligned(9000, {n: s for n, s in references.items() if n != "empty"})
    df = spark.createDataFrame(rows, ALIGNED)
    assert writers.write_bam(df, f"{tmp_path}/one", references, split=False) == len(rows)
    whole = readers.read_bam(spark, f"{tmp_path}/one", split=10_000)
    everything = whole.rdd.getNumPartitions()
    for name in ("a", "b", "c"):
        some = whole.filter(F.col("reference_name") == name)
        assert 0.2 * everything < some.rdd.getNumPartitions() < 0.45 * everything
        assert sorted(r.read_id for r in some.collect()) == sorted(r[0] for r in rows if r[1] == name)
    assert whole.filter(F.col("reference_name") == "empty").count() == whole.filter(F.col("reference_name") == "other").count() == 0
    both = whole.filter(F.col("reference_name").isin("a", "b") & (F.col("ref_start") < 20_000))
    assert sorted(r.read_id for r in both.collect()) == sorted(r[0] for r in rows if r[1] in ("a", "b") and r[2] < 20_000)
    assert ranges.bin_of(0, 1) == 4681 and ranges.bin_of(0, 1 << 14) == 4681 and ranges.bin_of(0, (1 << 14) + 1) == 585 and ranges.bin_of(1 << 14, (1 << 14) + 1) == 4682 and ranges.bin_of(0, 1 << 29) == 0
    assert readers.read_bam(spark, f"{tmp_path}/one").agg(F.count("*"), F.countDistinct("read_id")).first()[:] == (len(rows), len(rows))


@pytest.mark.parametrize("split", [True, False])
def test_one_sorted_file_per_group(spark, tmp_path, split):
    import os

    references = {"a": 3_000_000, "b": 40_000}
    rows = aligned(2000, references, 3)
    df = spark.createDataFrame(rows, ALIGNED).withColumn("tag", F.lit("t1")).withColumn("output_file_barcodes", F.when(F.hash("read_id") % 3 == 0, "g/1").when(F.hash("read_id") % 3 == 1, "g2"))
    folder = f"{tmp_path}/groups"
    for _ in range(2):
        assert writers.write_bam(df, folder, references, ["tag", "output_file_barcodes"], split) == len(rows)
    files = sorted(f for f in os.listdir(folder) if f.endswith(".bam"))
    assert {f.split(".")[0] for f in files} == {"t1_g-1", "t1_g2", "t1_"} and (split or len(files) == 3)
    assert sorted(f + ".bai" for f in files) == sorted(f for f in os.listdir(folder) if not f.endswith(".bam"))
    for group, name in (("g/1", "t1_g-1"), ("g2", "t1_g2"), (None, "t1_")):
        mine = [f"{folder}/{f}" for f in files if f.split(".")[0] == name]
        got = readers.read_bam(spark, mine)
        assert sorted(r.read_id for r in got.collect()) == sorted(r.read_id for r in df.filter(F.col("output_file_barcodes").eqNullSafe(group)).collect())
        for f in mine:
            places = [(r.reference_name == "*", r.reference_name, r.ref_start) for r in readers.read_bam(spark, f).collect()]
            assert places == sorted(places)
    with pytest.raises(Exception, match="of one name"):
        writers.write_bam(df, folder, references, ["tag", "output_file_barcodes"], split, mode="append")


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    import os

    references = {"a": 3_000_000}
    df = spark.createDataFrame(aligned(400, references), ALIGNED).repartition(4)
    bad = F.when(F.col("read_id") == "r77", F.raise_error(F.lit("broken"))).otherwise(F.col("query_seq"))
    with pytest.raises(Exception, match="broken"):
        writers.write_bam(df.withColumn("query_seq", bad), f"{tmp_path}/bad", references)
    assert not os.path.isdir(f"{tmp_path}/bad") or os.listdir(f"{tmp_path}/bad") == []
    with pytest.raises(Exception):
        writers.write_bam(df.withColumn("cigar", F.when(F.col("read_id") == "r77", "3Z").otherwise(F.col("cigar"))), f"{tmp_path}/worse", references)
    assert not os.path.isdir(f"{tmp_path}/worse") or os.listdir(f"{tmp_path}/worse") == []


def test_fastqs_are_found_below_a_path_or_an_address(tmp_path):
    for name in ("a/run1/fastq_pass/x.fastq", "a/run1/fastq_pass/y.fastq.gz", "a/run1/fastq_fail/z.fq", "a/run1/notes.md", "b/run2/w.fastq", "b/deep/only.fastq", "c/run3/.keep", "b/same.fq.gz", "c/same.fq.gz"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).touch()
    for root in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/"):
        short = lambda found: [p.removeprefix(root.rstrip("/") + "/") for p in found]  # noqa: E731, B023
        assert short(readers.find_fastqs(root, ["run1"], "fastq_pass, fastq_fail")) == ["a/run1/fastq_pass/x.fastq", "a/run1/fastq_pass/y.fastq.gz", "a/run1/fastq_fail/z.fq"]
        assert short(readers.find_fastqs(root, ["run1"], "fastq_pass", "x.fastq")) == ["a/run1/fastq_pass/x.fastq"]
        assert short(readers.find_fastqs(root, ["run2"])) == ["b/run2/w.fastq"] and short(readers.find_fastqs(root, ["only.fastq", "w.fastq"])) == ["b/deep/only.fastq", "b/run2/w.fastq"]
        for wrong in (["run3"], ["run9"], ["same.fq.gz"], ["none.fastq"], ["run1"]):
            with pytest.raises(FileNotFoundError):
                readers.find_fastqs(root, wrong)
    assert readers.choose_source({"fwdReads": "f", "runname": ["r"]}) == "fwdReads" and readers.choose_source({"runname": ["r"], "bs_project_ID": 1}) == "runname"
    with pytest.raises(ValueError):
        readers.choose_source({"runname": []})


def test_reads_of_one_place_are_spread_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(4000).selectExpr("cast(id as string) as read_id", "'r' as reference_name", "0 as ref_start", "0 as flag", "'4M' as cigar", "'ACGT' as query_seq", "cast(null as array<int>) as quals", "cast(null as string) as bc", "1 as nm")
    path = f"file://{tmp_path}/bam"
    try:
        assert writers.write_bam(df, path, {"r": 4}) == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = readers.read_bam(spark, path)
    assert got.count() == 4000 and got.select("read_id").distinct().count() == 4000
    assert len([p for p in (tmp_path / "bam").iterdir() if p.name.endswith(".bam")]) > 1
