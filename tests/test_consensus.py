"""Consensus of reads with insertions and deletions, and of concatemers."""

import random

import numpy as np
import pytest

from strandframe.operators import align as A
from strandframe.operators import consensus as C
from tests.test_align import TURN, bases, worn


def test_votes_by_quality_and_inserted_letters():
    p = C.Pile()
    p.aligned("ACGT", np.array([30] * 4), 0, "4M")
    p.aligned("ATGT", np.array([30, 2, 30, 30]), 0, "4M")
    p.aligned("ACXGT", np.array([20] * 5), 0, "2M1I2M")
    p.aligned("AGT", np.array([1, 1, 1]), 0, "1M1D2M")
    assert p.called() == "ACGT"
    p.aligned("ACCGT", np.array([60] * 5), 0, "2M1I2M")
    assert p.called() == "ACCGT"
    q = C.Pile()
    q.aligned("GGACGT", None, 2, "2I4M")
    assert q.called() == "GGACGT" and C.Pile().called() == ""


def test_sums_of_parts_are_those_of_the_whole():
    rnd = random.Random(0)
    whole, parts = C.Pile(), [C.Pile() for _ in range(3)]
    ref = bases(rnd, 200)
    for k in range(60):
        seq = worn(rnd, ref, 0.1)
        _, start, cigar, _ = A.extend([(A.codes(ref), A.codes(seq), -60, 60)], A.Scores())[0]
        for pile in (whole, parts[k % 3]):
            pile.aligned(seq, None, start, cigar)
    merged = C.Pile()
    for p in parts:
        merged.add(p.reads, p.votes.ravel(), np.array(list(p.extra)), np.concatenate(list(p.extra.values())))
    assert merged.called() == whole.called() and merged.reads == 60


@pytest.mark.parametrize("held", [C.HELD, 1])
def test_groups_with_indels_return_their_template(spark, monkeypatch, held):
    monkeypatch.setattr(C, "HELD", held)
    rnd = random.Random(1)
    ref = bases(rnd, 500)
    reads, want = [], {}
    for group in range(8):
        template = list(ref)
        template[100 + group] = ""
        template[200] += bases(rnd, 7)
        template[300 + group] = "A" if template[300 + group] != "A" else "C"
        want[group] = "".join(template)
        for _ in range(25):
            seq = worn(rnd, want[group], 0.08)
            _, start, cigar, _ = A.extend([(A.codes(ref), A.codes(seq), -60, 60)], A.Scores())[0]
            reads.append((group, seq, None, start, cigar))
    reads += [(99, "ACGT", None, -1, "*"), (None, ref, [30] * 500, 0, "500M"), (98, None, None, 0, "3M")]
    df = spark.createDataFrame([r for r in reads if r[1] is not None], "g int, query_seq string, quals array<int>, ref_start int, cigar string").repartition(5)
    got = {r.g: (r.consensus, r.reads) for r in C.molecules(df, ["g"]).collect()}
    assert {g: c for g, (c, _) in got.items() if g in want} == want
    assert got[None] == (ref, 1) and all(got[g][1] == 25 for g in want)


@pytest.mark.parametrize("unit", [60, 400, 1500])
def test_concatemers_give_back_their_unit(spark, unit):
    rnd = random.Random(unit)
    rows, want = [], {}
    for k in range(6):
        text = bases(rnd, unit)
        want[f"r{k}"] = text
        copies = [worn(rnd, text, 0.04) for _ in range(8 + k)]
        rows.append((f"r{k}", "".join(copies) + text[: unit // 3], None))
    rows += [("alone", bases(rnd, 700), [20] * 700), ("short", "ACG", None), ("empty", "", None), ("null", None, None)]
    got = {r.read_id: r for r in C.concatemers(spark.createDataFrame(rows, "read_id string, seq string, quals array<int>").repartition(2)).collect()}
    for name, text in want.items():
        r = got[name]
        # A unit may begin a base beside where the first one did; around the circle it is the same.
        around = A.codes(r.consensus * 2)
        assert int(name[1:]) + 8 == r.repeats and A.extend([(around, A.codes(text), -unit, 2 * unit)], A.Scores())[0][0] >= 2 * unit + 60 - 10 * max(1, unit // 500), name
    assert sum(t in got[n].consensus * 2 for n, t in want.items()) >= 4
    assert got["alone"].repeats == 1 and got["alone"].consensus == rows[-4][1] and got["alone"].read_name == "alone_20.0_700_1_700"
    assert "null" not in got


def test_splint_is_cut_out_on_both_strands(spark):
    rnd = random.Random(5)
    splint, insert = bases(rnd, 40), bases(rnd, 300)
    circle = insert + splint
    rows = []
    for k, shift in enumerate((0, 50, 290, 310)):
        turned = circle[shift:] + circle[:shift]
        text = "".join(worn(rnd, turned, 0.03) for _ in range(9))
        rows.append((f"r{k}", text.translate(TURN)[::-1] if k % 2 else text, None))
    got = C.concatemers(spark.createDataFrame(rows, "read_id string, seq string, quals array<int>"), splint).collect()
    assert [A.pairs_aligned([insert], [r.consensus], A.Scores(), False)[0][0] >= 590 for r in got] == [True] * 4


def test_votes_of_many_reads_are_those_of_each(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(6)
    rows = []
    for k in range(90):
        seq = bases(rnd, rnd.randint(0, 30)) if k % 17 else "ACÄGT"
        n = len(seq)
        cigar = rnd.choice([f"{n}M", f"2S{n - 2}M", f"{n - 3}M3S", f"3M1I{n - 4}M", f"3M2D{n - 3}M"]) if n > 5 else f"{n}M" if n else ""
        quals = None if k % 3 else np.array([rnd.randint(0, 40) for _ in seq])
        rows.append((k % 4, seq, quals, None if k % 11 == 0 else (rnd.randint(0, 5), cigar)))
    for part in (rows, [r for r in rows if r[1].isascii()]):
        for text in (C.TEXT, 40):
            monkeypatch.setattr(C, "TEXT", text)
            want, got = [C.Pile() for _ in range(4)], [C.Pile() for _ in range(4)]
            for g, seq, quals, place in part:
                if place:
                    want[g].aligned(seq, quals, *place)
            column = pa.array(["skipped", *(r[1] for r in part)])[1:]
            C.vote([got[r[0]] for r in part], column, [r[2] for r in part], [r[3] for r in part])
            for a, b in zip(want, got, strict=True):
                n = max(len(a.votes), len(b.votes))
                a.room(n), b.room(n)
                assert a.reads == b.reads and {k: v.tolist() for k, v in a.extra.items()} == {k: v.tolist() for k, v in b.extra.items()}
                m = min(len(a.votes), len(b.votes))
                assert (a.votes[:m] == b.votes[:m]).all() and not a.votes[m:].any() and not b.votes[m:].any()


def test_reads_are_placed_on_their_drafts_as_one_by_one():
    import pyarrow as pa

    rnd = random.Random(7)
    drafts = [bases(rnd, rnd.randint(20, 70)) for _ in range(60)]
    seqs = [worn(rnd, d, rnd.choice([0, 0.02, 0.1])) for d in drafts] + ["", "ACÄGT"]
    drafts += ["", "ACGGT"]
    for some in (slice(None), slice(0, -1)):
        want = []
        for seq, draft in zip(seqs[some], drafts[some], strict=True):
            a, b = A.codes(draft), A.codes(seq)
            if len(a) == len(b) and int((a != b).sum()) <= 2:
                want.append((0, f"{len(b)}M" if seq else ""))
                continue
            apart = len(a) - len(b)
            want.append(A._in_parts([(a, b, min(0, apart) - 48, max(0, apart) + 48)], C.SCORES, "ends")[0][1:3])
        assert C._jobs(pa.array(seqs[some], pa.string()), pa.array(drafts[some], pa.string()), 48) == want


def test_one_gap_is_placed_as_the_band_places_it():
    import pyarrow as pa

    rnd = random.Random(8)
    seqs, drafts, want = [], [], []
    for _ in range(1500):
        draft = "".join(rnd.choice(rnd.choice(["ACGT", "AC", "AAAC"])) for _ in range(rnd.choice([3, 6, 20, 60])))
        seq = list(draft)
        seq[rnd.randrange(len(seq))] = rnd.choice("ACGTN")
        at, k = rnd.randrange(len(seq) + 1), rnd.choice([-1, 1, 2])
        seq[at : at + (k < 0)] = bases(rnd, max(k, 0)) if rnd.random() < 0.8 else "A" * max(k, 0)
        a, b = A.codes(draft), A.codes("".join(seq))
        if len(a) == len(b):
            continue
        seqs.append("".join(seq)), drafts.append(draft)
        want.append(A._in_parts([(a, b, min(0, len(a) - len(b)) - 16, max(0, len(a) - len(b)) + 16)], C.SCORES, "ends")[0][1:3])
    assert C._jobs(pa.array(seqs), pa.array(drafts), 16) == want
    flat = [C._flat(pa.array(x)) for x in (seqs, drafts)]
    found = C._one_gap(flat[0][0], flat[1][0], flat[0][1][:-1], flat[1][1][:-1], *(np.diff(f[1]) for f in flat))
    assert (found > 0).mean() > 0.2


def test_cuts_of_many_reads_are_those_of_each():
    rnd = random.Random(9)
    texts = ["", "A", "A" * 90, *("".join(worn(rnd, u, 0.05) for _ in range(rnd.randint(1, 9))) for u in (bases(rnd, rnd.choice([8, 30, 90])) for _ in range(60))), ""]
    got = C._units(texts, C.SHORTEST)
    alone = [C.cuts(A.codes(t)) for t in texts]
    assert got == [e if len(e) > 1 else [0, len(t)] for e, t in zip(alone, texts, strict=True)]
    assert sum(len(e) > 3 for e in got) > 20
    unit = bases(rnd, 50)
    assert C.cuts(A.codes(unit * 3 + unit[:20])) == [0, 50, 100, 150]


def test_units_of_a_concatemer_stay_in_their_task(spark):
    unit = bases(random.Random(10), 60)
    found = C.concatemers(spark.createDataFrame([("r", unit * 5, None)], "read_id string, seq string, quals array<int>"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("r", "r_0.0_300_5_60", 5, unit)]


def _members(rnd):
    rows = []
    for group in range(12):
        ref = bases(rnd, rnd.randint(20, 90))
        for k in range(rnd.randint(1, 9)):
            seq = worn(rnd, ref, 0.08)
            _, start, cigar, _ = A.extend([(A.codes(ref), A.codes(seq), -60, 60)], A.Scores())[0]
            quals = [rnd.randint(0, 40) for _ in seq] if group % 3 else None
            if k % 4 == 1:
                seq, cigar, quals = "GG" + seq + "T", f"1H2S{cigar}1S", quals and [1, 2, *quals, 3]
            rows.append((group or None, k % 2, seq, quals, *((start, cigar) if k % 4 != 2 else (None, None))))
    return [*rows, (20, 0, "ACGT", None, -1, "*"), (21, 0, "", None, 0, ""), (22, 0, None, None, 0, "3M"), (23, 1, "ACÄGT", None, 0, "5M")]


def test_groups_settled_together_are_those_that_are_spread(spark, monkeypatch):
    rows = _members(random.Random(11))
    df = spark.createDataFrame(rows, "g int, h int, query_seq string, quals array<int>, ref_start int, cigar string").repartition(5)
    got = []
    for together, rounds in ((C.TOGETHER, 3), (150, 3), (-1, 3), (C.TOGETHER, 0)):
        monkeypatch.setattr(C, "TOGETHER", together)
        got.append({(r.g, r.h): (r.reads, r.consensus) for r in C.molecules(df, ["g", "h"], rounds, 16).collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) == len({r[:2] for r in rows if r[2] is not None}) == len(got[3])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    for name in ("TEXT", "HOLD", "SOME"):
        monkeypatch.setattr(C, name, 100)
    assert {(r.g, r.h): (r.reads, r.consensus) for r in C.molecules(df, ["g", "h"], 3, 16).collect()} == got[0]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_groups_of_few_letters_shuffle_no_votes(spark, monkeypatch):
    monkeypatch.setattr(C, "_voted", None)
    rows = [(g, "ACGTACGT"[: 8 - (k == 2)], None, 0, f"{8 - (k == 2)}M") for g in range(5) for k in range(3)]
    df = spark.createDataFrame(rows, "g int, query_seq string, quals array<int>, ref_start int, cigar string")
    assert sorted(tuple(r) for r in C.molecules(df, ["g"]).collect()) == [(g, 3, "ACGTACGT") for g in range(5)]
    assert C.molecules(df.limit(0), ["g"]).count() == 0
