import hashlib
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest

from strandframe.llm import queries, repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(codes):
    """(cost, letters, roles): the least letters among the cheapest edits, by a search over whole edit sequences in order of cost, then letters."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, roles, turns = heappop(heap)
        # Of two ways to the same place with the same cost, the one of smaller letters comes first.
        if (i, roles[-1:], len(roles) > 0) in done:
            continue
        done.add((i, roles[-1:], len(roles) > 0))
        if i == len(codes) and GRAMMAR.fullmatch(roles):
            return cost, letters, turns
        ok = lambda r: any(re.fullmatch(GRAMMAR, r + more) for more in ("", "a", "ua"))
        for role in ("user", "assistant"):
            if ok(roles + role[0]):
                heappush(heap, (cost + 5, letters + "I", i, roles + role[0], (*turns, (role, ""))))
        if i < len(codes):
            role, text, must, cut = codes[i]
            heappush(heap, (cost + 2, letters + "D", i + 1, roles, turns))
            if not must:
                for letter, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if new[:1] in ("s", "u", "a") and ok(roles + new[:1]):
                        heappush(heap, (cost + price + 5 * cut, letters + letter, i + 1, roles + new[0], (*turns, (new, text))))


def plain_report(rows, conv_ids):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r[1:])
    out = {}
    for conv in conv_ids:
        turns = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        count, seen, codes, illegal = defaultdict(int), set(), [], 0
        for k, (_, role, text) in enumerate(turns):
            visible = BLANK.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            codes.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
            illegal += k > 0 and turns[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, letters, fixed = cheapest(codes)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, digest)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def taken(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def made(n, seed, longest=9):
    rnd = random.Random(seed)
    texts = ["Fine.", "Fine.", "Yes!", "Why?", "cut off", "", " \t", None, "Last one.  \n", "odd …"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ab"]
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = ("user", "assistant")[turn % 2] if rnd.random() < 0.5 else rnd.choice(roles)
            text = f"Turn {turn}." if rnd.random() < 0.5 else rnd.choice(texts)
            rows.append((None if conv == 0 else conv, rnd.choice([turn, turn, turn, None, turn * 3]), role, text))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [0, 1])
def test_damaged_conversations_against_a_search_of_edit_sequences(spark, seed):
    rows = made(200, seed)
    got = taken(repair.damaged_report(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == plain_report(plain_damage(rows), {r[0] for r in rows})


@pytest.mark.parametrize("segment", [0, 1, 2])
def test_segments_change_nothing(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = made(60, 7, 12)
    got = taken(repair.damaged_report(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == plain_report(plain_damage(rows), {r[0] for r in rows})


def test_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2] if t % 7 else "user", f"Say {t % 900}." if t % 5 else "cut") for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert taken(repair.report(df)) == plain_report(rows, {1})
    turns = repair.repaired(df).orderBy("place").collect()
    digest = hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest()
    assert digest == taken(repair.report(df))[1][-1] and GRAMMAR.fullmatch("".join(r.role[0] for r in turns))


def test_known_cases(spark):
    talks = {
        1: ["user:Hi.", "assistant:Yes."], 2: ["user:Hi."], 3: ["assistant:Hi.", "user:Yes."], 4: ["system:Be.", "user:Hi.", "user:Hi.", "assistant:Ok."],
        5: ["user:cut"], 6: ["system:Only."], 7: [":x."], 8: ["user:A.", "user:B."],
    }
    rows = [(c, t, *x.split(":", 1)) for c, turns in talks.items() for t, x in enumerate(turns)]
    got = taken(repair.report(spark.createDataFrame(rows, SCHEMA)))
    assert {c: (v[5], v[6]) for c, v in got.items()} == {1: (0, "KK"), 2: (2, "D"), 3: (2, "RR"), 4: (2, "KKDK"), 5: (2, "D"), 6: (2, "D"), 7: (2, "D"), 8: (1, "KR")}
    assert got == plain_report(rows, set(talks))


def test_cases(spark):
    extra = spark.createDataFrame([(1, 0, "user", "A.", "x", 3)], SCHEMA + ", seen string, kind int")
    assert taken(repair.report(extra)) == plain_report([(1, 0, "user", "A.")], {1})
    assert repair.damaged_report(extra.limit(0)).count() == repair.repaired(extra.limit(0)).count() == 0
    big = [(1, 0, "user", "word " * 500_000 + "."), (1, 1, "assistant", None)]
    assert taken(repair.report(spark.createDataFrame(big, SCHEMA))) == plain_report([big[0], (1, 1, "assistant", " ")], {1})


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert taken(queries.op12_structure_repair(spark, sf)) == plain_report(plain_damage(rows), {r[0] for r in rows})
