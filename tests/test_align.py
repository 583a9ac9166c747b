"""Alignment: scores of full tables, long reads along their references, and reads that share no seed."""

import random
import re
from functools import cache

import numpy as np
import pytest

from strandframe.operators import align as A

TURN = str.maketrans("ACGT", "TGCA")
TURN_BASE = dict(zip("ACGT", "TGCA", strict=True))


def bases(rnd, n):
    return "".join(rnd.choice("ACGT") for _ in range(n))


def worn(rnd, text, rate):
    out = []
    for c in text:
        x = rnd.random()
        out.append(rnd.choice("ACGT") if x < rate / 2 else "" if x < rate * 3 / 4 else c + rnd.choice("ACGT") if x < rate else c)
    return "".join(out)


def scored(ref, query, start, cigar, s, ends=True):
    """Score and changed bases of an alignment as it is spelled."""
    i, j, total, changes = start, 0, 0, 0
    ops = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDS])", cigar)]
    for n, op in ops:
        if op == "M":
            total += sum(s.unknown if "N" in ref[i + k] + query[j + k] else s.match if ref[i + k] == query[j + k] else -s.mismatch for k in range(n))
            changes += sum(ref[i + k] != query[j + k] for k in range(n))
        elif op in "ID":
            total -= s.gap(n)
            changes += n
        i += n if op in "MD" else 0
        j += n if op in "MIS" else 0
    assert j == len(query)
    if ends:
        total += s.end_bonus * ((ops[0][1] != "S") + (ops[-1][1] != "S"))
    return total, changes


def plain_global(a, b, s):
    @cache
    def best(i, j, state):
        if i == j == 0:
            return 0 if state == 0 else -(10**6)
        out = -(10**6)
        if state == 0 and i and j:
            out = max(best(i - 1, j - 1, t) for t in range(3)) + (s.match if a[i - 1] == b[j - 1] else -s.mismatch)
        for t, di, dj in ((1, 1, 0), (2, 0, 1)):
            if state == t:
                for n in range(1, (i if di else j) + 1):
                    out = max(out, max(best(i - n * di, j - n * dj, u) for u in range(3) if u != t) - s.gap(n))
        return out

    return max(best(len(a), len(b), t) for t in range(3))


def test_global_scores_are_those_of_all_paths():
    rnd = random.Random(0)
    for s in (A.Scores(end_bonus=0), A.Scores(2, 4, ((4, 2),), 0), A.Scores(1, 1, ((3, 2), (5, 1)), 0)):
        first = [bases(rnd, rnd.randint(0, 14)) for _ in range(60)]
        second = [worn(rnd, f, 0.4) if k % 2 else bases(rnd, rnd.randint(0, 14)) for k, f in enumerate(first)]
        for a, b, (score, x, y) in zip(first, second, A.pairs_aligned(first, second, s, False), strict=True):
            assert score == plain_global(a, b, s), (a, b)
            assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)


@pytest.mark.parametrize("scores", [A.Scores(), A.Scores(2, 4, ((4, 2),), 0), A.Scores(1, 3, ((2, 1),), 5)])
def test_a_band_gives_the_score_of_the_full_table(scores):
    rnd = random.Random(1)
    jobs, texts = [], []
    for k in range(80):
        ref = bases(rnd, rnd.randint(60, 300))
        lo = rnd.randrange(0, 30)
        query = worn(rnd, ref[lo : lo + rnd.randint(20, 200)], rnd.choice([0, 0.05, 0.15]))
        if k % 7 == 0:
            query = query[: len(query) // 2] + bases(rnd, 30) + query[len(query) // 2 :]
        if k % 5 == 0:
            query = bases(rnd, 25) + query + "N" * (k % 3)
        texts.append((ref, query))
        jobs.append((A.codes(ref), A.codes(query), lo - 70, lo + 60))
    banded = A.extend(jobs, scores)
    full = A.extend([(r, q, -len(q), len(r)) for r, q, _, _ in jobs], scores)
    assert [b[0] for b in banded] == [f[0] for f in full]
    for (ref, query), (score, start, cigar, nm) in zip(texts, banded, strict=True):
        assert scored(ref, query, start, cigar, scores) == (score, nm)


def test_chains_follow_one_diagonal_band():
    rnd = np.random.default_rng(0)
    q = np.sort(rnd.choice(5000, 400, replace=False))
    r = q + 1000 + np.where(q > 2500, 30, 0)
    noise_r, noise_q = rnd.integers(0, 6000, 300), rnd.integers(0, 5000, 300)
    score, lo, hi = A.chain(np.concatenate([r, noise_r]), np.concatenate([q, noise_q]), 11)
    assert 990 <= lo <= 1000 and 1030 <= hi <= 1040 and score > 3000


def test_long_reads(spark):
    rnd = random.Random(3)
    refs = {f"ref{k}": bases(rnd, 5000) for k in range(3)}
    refs["close"] = worn(rnd, refs["ref0"], 0.1)
    whole = {n: t + bases(rnd, 6000) for n, t in refs.items()}
    rows, want = [], {}
    for k in range(24):
        name = rnd.choice([*refs])
        source = whole[name] if k % 8 == 0 else refs[name]
        lo = rnd.randrange(0, 1500)
        text = worn(rnd, source[lo : lo + rnd.choice([1000, 3000, 10_000])], 0.08)
        back = k % 2 == 1
        want[f"r{k}"] = (name, lo, back)
        rows.append((f"r{k}", text.translate(TURN)[::-1] if back else text, [k % 40] * len(text)))
    got = A.align_reads(
        spark.createDataFrame(rows, "read_id string, seq string, quals array<int>").repartition(3), spark.createDataFrame(refs.items(), "reference_name string, alignment_seq string")
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        name, lo, back = want[r.read_id]
        assert (r.reference_name, r.flag) == (name, 16 if back else 0) and abs(r.ref_start - lo) < 12 and len(r.quals) == len(r.query_seq)
        assert scored(refs[name], r.query_seq, r.ref_start, r.cigar, A.Scores()) == (r.score, r.nm)
        full = A.extend([(A.codes(refs[name]), A.codes(r.query_seq), -len(r.query_seq), 5000)], A.Scores())[0] if len(r.query_seq) < 2000 else (r.score,)
        assert full[0] == r.score


def test_every_read_has_a_row(spark):
    rnd = random.Random(4)
    refs = {f"ref{k}": bases(rnd, 400) for k in range(4)}
    rows = []
    for k in range(12):
        name = f"ref{k % 4}"
        text = list(refs[name][40:240])
        for p in range(k % 8, 200, 8):
            text[p] = rnd.choice([c for c in "ACGT" if c != text[p]])
        rows.append((f"{name}-{k}", "".join(text) if k % 3 else "".join(text).translate(TURN)[::-1]))
    rows += [("tiny", "ACG"), ("none", ""), ("null", None), ("unknown", "NNNNNNNN"), ("low", "A" * 200)]
    got = {r.read_id: r for r in A.align_reads(spark.createDataFrame(rows, "read_id string, seq string"), spark.createDataFrame(refs.items(), "reference_name string, alignment_seq string")).collect()}
    assert got.keys() == {r[0] for r in rows}
    assert all(r.reference_name == i.split("-")[0] for i, r in got.items() if "-" in i)
    assert got["none"].flag == got["null"].flag == 4 and got["none"].cigar == "*" and got["tiny"].flag != 4
    empty = spark.createDataFrame([], "read_id string, seq string")
    assert A.align_reads(empty, spark.createDataFrame(refs.items(), "reference_name string, alignment_seq string")).count() == 0


def test_equal_reads_are_aligned_once_and_all_have_rows(spark, monkeypatch):
    rnd = random.Random(5)
    refs = {"a": bases(rnd, 120), "b": bases(rnd, 120)}
    rare = "".join(c if k % 6 else TURN_BASE[c] for k, c in enumerate(refs["b"][20:80]))
    texts = [refs["a"][10:90], refs["a"][10:50] + refs["a"][53:100], refs["b"][5:100].translate(TURN)[::-1], rare, "ACG", ""]
    rows = [(f"r{k}", texts[k % 6].lower() if k % 12 < 6 else texts[k % 6]) for k in range(600)] + [("null", None), ("null too", None)]
    ref_rows = spark.createDataFrame(refs.items(), "reference_name string, alignment_seq string")
    alone = {r.read_id: r for r in A.align_reads(spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "read_id string, seq string"), ref_rows).collect()}
    saved, real = [], A.Scratch.save
    monkeypatch.setattr(A.Scratch, "save", lambda self, df: saved.append(out := real(self, df)) or out)
    got = A.align_reads(spark.createDataFrame(rows, "read_id string, seq string").repartition(7), ref_rows).collect()
    assert sorted(r.read_id for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert r[1:] == alone[str(int(r.read_id[1:]) % 6)][1:] if r.read_id[0] == "r" else r.flag == 4
    # Chains are those of the texts, on both strands, along both references.
    chained = [df.count() for df in saved if "chain" in df.columns]
    assert len(chained) == 2 and max(chained) <= 4 * len(texts)


def test_seeds_of_many_texts_are_those_of_each():
    rnd = random.Random(11)
    texts = ["", "ACGT", bases(rnd, 11), bases(rnd, 15), bases(rnd, 16), bases(rnd, 80) + "N" + bases(rnd, 9), "A" * 40, *(bases(rnd, rnd.randint(5, 300)) for _ in range(40)), ""]
    for patterns, w in (((tuple(range(11)),), 5), (A.SPACED, 1), (((0, 1, 3),), 3)):
        want = set()
        for row, text in enumerate(texts):
            for number, offsets in enumerate(patterns):
                value, places = A.minimizers(*A.words(A.codes(text), offsets), w)
                want |= {(row, int(v) * len(patterns) + number, int(p)) for v, p in zip(value, places, strict=True)}
        got = list(zip(*(x.tolist() for x in A.seeds(texts, patterns, w)), strict=True))
        assert set(got) == want and len(got) == len(want)


def test_chains_of_many_lists_are_those_of_each():
    rnd = random.Random(12)
    lists = [[(q + d, q) for q in rnd.sample(range(200), rnd.randint(1, 30)) for d in ([7] if k % 2 else rnd.sample([0, 1, 5, 90], 2))] for k in range(60)]
    lists.append([(5, 5), (5, 5), (9, 9)])
    r, q = (np.array([x[k] for one in lists for x in one], np.int32) for k in (0, 1))
    ends = np.cumsum([0] + [len(one) for one in lists])
    want = [A.chain(r[a:b], q[a:b], 11) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert list(zip(*(x.tolist() for x in A.chains(ends, r, q, 11)), strict=True)) == want
    assert list(zip(*(x.tolist() for x in A.chains(ends[3:], r, q, 11)), strict=True)) == want[3:]


@pytest.mark.parametrize("kind", ["ends", "local", "global"])
@pytest.mark.parametrize("scores", [A.Scores(), A.Scores(gaps=((4, 2),), end_bonus=0)])
def test_narrow_bands_and_straight_texts_give_what_whole_bands_give(kind, scores, monkeypatch):
    rnd = random.Random(13)
    jobs = []
    for k in range(120):
        ref = bases(rnd, rnd.randint(1, 90)) if k % 3 else "ACACAC" * rnd.randint(1, 12)
        seq = worn(rnd, ref, rnd.choice([0.0, 0.02, 0.1, 0.4])) or "A"
        seq = bases(rnd, rnd.randint(0, 25)) + seq if k % 5 == 0 else seq[rnd.randint(0, 30) :] or "C" if k % 7 == 0 else seq
        apart = len(ref) - len(seq)
        jobs.append((A.codes(ref), A.codes(seq), min(0, apart) - 60, max(0, apart) + 60))
    if kind == "global":
        jobs = [(r + np.int8(8), q + np.int8(8), max(lo, -len(q)), min(hi, len(r))) for r, q, lo, hi in jobs]
    tried = []
    real = A._in_parts
    monkeypatch.setattr(A, "_in_parts", lambda some, *more: tried.append(len(some)) or real(some, *more))
    assert A.extend(jobs, scores, kind) == real(jobs, scores, kind)
    assert tried[-1] < len(jobs)


def test_short_jobs_are_worked_off_in_near_memory_by_narrow_numbers(monkeypatch):
    rnd = random.Random(14)
    jobs = []
    for k in range(3000):
        ref = bases(rnd, 60)
        seq = worn(rnd, ref, rnd.choice([0.02, 0.1, 0.3])) or "A"
        jobs.append((A.codes(ref), A.codes(seq), -60, 60))
    rows, real = [], A._banded
    monkeypatch.setattr(A, "_banded", lambda some, *more: rows.append(len(some) * max(hi - lo + 1 for _, _, lo, hi in some)) or real(some, *more))
    got = A.extend(jobs, A.Scores())
    # A row of all at once would have 3000 times 25 cells and more, in several arrays of 4 bytes.
    assert max(rows) <= A.ROW < 3000 * 25
    # Beside a long query the numbers are wide.
    ref = bases(rnd, 4000)
    long = (A.codes(ref), A.codes(worn(rnd, ref, 0.1)), -80, 80)
    for kind in ("ends", "local"):
        assert real([*jobs[:100], long], A.Scores(), kind)[:100] == real(jobs[:100], A.Scores(), kind)
    assert got[:100] == real(jobs[:100], A.Scores(), "ends")


def test_pieces_of_gap_costs_are_left_out_only_where_they_change_nothing():
    assert A.Scores().within(34).gaps == ((6, 2),)
    assert A.Scores().within(43).gaps == ((6, 2),) and A.Scores().within(44) == A.Scores()
    assert A.Scores(gaps=((24, 1), (6, 2))).within(34).gaps == ((24, 1), (6, 2))
    for gaps in (((3, 2), (5, 1)), ((6, 2), (9, 1)), ((4, 3), (20, 1)), ((2, 0), (1, 1))):
        for lost in range(1, 60):
            less = A.Scores(gaps=gaps).within(lost)
            assert all(A.Scores(gaps=gaps).gap(n) == less.gap(n) or A.Scores(gaps=gaps).gap(n) >= lost for n in range(1, 100))


def test_chains_of_bent_lists_are_found_side_by_side(monkeypatch):
    rng = np.random.default_rng(15)
    lists = []
    for k in range(150):
        q = rng.integers(0, 60 if k % 3 else 4000, int(rng.integers(2, 400 if k % 10 == 0 else 20)))
        lists.append((q + 100 + rng.choice([0, 3, 40, -7][: 1 + k % 4], len(q)), q))
    r, q = (np.concatenate([x[k] for x in lists]).astype(np.int32) for k in (0, 1))
    want, real, alone = [A.chain(a, b, 11) for a, b in lists], A._chained, []
    bent = {k for k, (a, b) in enumerate(lists) if len(set((a - b).tolist())) > 1}
    monkeypatch.setattr(A, "chain", lambda *a: alone.append(a))
    monkeypatch.setattr(A, "ROW", 1 << 10)
    together = []
    monkeypatch.setattr(A, "_chained", lambda r, q, starts, n, size: together.append(n) or real(r, q, starts, n, size))
    got = list(zip(*(x.tolist() for x in A.chains(np.cumsum([0] + [len(x[0]) for x in lists]), r, q, 11)), strict=True))
    assert all(got[k] == want[k] for k in bent) and not alone
    assert sum(map(len, together)) == len(bent) and 1 < len(together) < len(bent) / 4
