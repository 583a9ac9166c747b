"""Toxicity: a weighted lexicon matched by one Aho-Corasick pass per text.

*Folding.* Texts are lower-cased, look-alike letters of other scripts and
full-width forms become Latin, accents go, digits and signs that stand for
letters become them (``1 ! | l`` all fold to ``i``), and everything else
separates words. Lexicon and text are folded alike.

*Lexicon.* Learned from labelled rows: whole words and word beginnings of 4 to
6 letters, weighed by the smoothed log-odds of the texts that hold them. At
most ``train_rows`` labelled rows are used, those with the smallest hash of
their id; they are written once as a table of their own. Only entries found in
``support`` toxic texts or more, and in ``support_share`` of them, with a weight of at
least ``least_weight`` stay, the ``entries`` of the highest weight.

*Score.* Each word counts with its best entry, unless it lies in an exception
phrase: harmless uses of lexicon words, given (``EXCEPTIONS``) or learned (a
lexicon word and its neighbour that ``spare`` harmless training texts or more
hold, and no toxic one). The sum is divided by
a power of the length in words; the mildest power that fits the training rows
about as well as any is taken, with a logistic curve. 1 means toxic.

Defined cases: null and empty texts have length 0 and get the score of a text
without matches. Labels that are null or whose text is missing teach nothing.
Without toxic or without harmless training rows the lexicon is empty and every
score is the share of toxic labels (0 without labels). Repeated rows are scored
each; of the texts of one id the least teaches; several labels of one document all
count. Null ids are scored too. Other columns are ignored or kept as they are; an
empty table gives an empty one. Texts are scored whole, however long.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strandframe.llm._names import all_of, col, filter_batches
from strandframe.llm._store import Scratch, ready

# Letters of other scripts that look like Latin ones, in the order of the Latin row.
_ALIKE = (("авсԁеһіјӏкмнопԛрѕтуѵхԝɡαβεικνορτυχγη", "abcdehijlkmhonqpstyvxwgabeiknoptuxyn"),)
# Digits and signs that stand for letters; i, l and their signs fold together.
_SIGNS = ("0123456789@$|l", "oizeasgtbgasii")
#: Harmless uses of words that are abuse when aimed at someone.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "trash pickup", "take out the trash", "clown fish",
    "circus clown", "rodeo clown", "pond scum", "soap scum", "sore loser", "worthless stock", "winner and loser",
)
_LOW, _HIGH = 4, 6


def _table() -> dict[int, str]:
    table = {}
    for code in range(0x250):
        base = unicodedata.normalize("NFKD", chr(code))[:1].lower()
        table[code] = base if base.isalnum() and base.isascii() else " "
    for code in range(0xFF01, 0xFF5F):
        table[code] = chr(code - 0xFEE0).lower()
    for src, dst in _ALIKE:
        for a, b in zip(src, dst, strict=True):
            table[ord(a)] = table[ord(a.upper()[:1])] = b
    table[ord("ß")], table[ord("æ")], table[ord("ø")], table[ord("đ")] = "s", "a", "o", "d"
    for a, b in zip(*_SIGNS, strict=True):
        table[ord(a)] = b
    table[ord("L")] = table[0xFF2C] = table[0xFF4C] = "i"
    for code in [k for k, v in table.items() if v.isdigit() or v == "l"]:
        table[code] = table[ord(table[code])]
    return table


_TABLE = _table()
_ASCII = bytes(ord(_TABLE[c][0]) if c < 128 else 32 for c in range(256))
_BANG = re.compile(r"!(?=\w)")


def fold(text: str) -> str:
    """The folded text: lower-case Latin words between single or repeated blanks, blanks around."""
    if "!" in text:
        text = _BANG.sub("i", text)
    if text.isascii():
        return " " + text.encode().translate(_ASCII).decode() + " "
    return " " + text.translate(_TABLE) + " "


def entries_of(text: str) -> set[str]:
    """Possible lexicon entries of a text: `` word `` and `` begi``."""
    out = set()
    for word in set(fold(text).split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in range(_LOW, min(_HIGH, len(word)) + 1))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    power: float = 0.5
    slope: float = 1.0
    offset: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for phrase in self.exceptions:
            key = " " + " ".join(fold(phrase).split()) + " "
            machine.add_word(key, (len(key), None))
        for key, weight in self.weights.items():
            machine.add_word(key, (len(key), weight))
        machine.make_automaton()
        return machine

    def evidence(self, text: str | None, machine: ahocorasick.Automaton) -> tuple[float, int]:
        """(sum of the best weight of each matched word, number of words)."""
        parts = fold(text or "").split()
        return sum(self._matched(parts, machine).values()), len(parts)

    def neighbours(self, text: str, machine: ahocorasick.Automaton) -> set[str]:
        """Every matched word with the word before it, and with the one behind."""
        parts, out, at = fold(text).split(), set(), 0
        matched = self._matched(parts, machine)
        for x, word in enumerate(parts):
            if at in matched:
                out.update(" ".join(pair) for pair in (parts[x - 1 : x + 1] if x else [], parts[x : x + 2]) if len(pair) == 2)
            at += len(word) + 1
        return out

    def _matched(self, parts: list[str], machine: ahocorasick.Automaton) -> dict[int, float]:
        """The best weight of each matched word, by the place of the blank before it."""
        if not len(machine) or not parts:
            return {}
        folded = " " + " ".join(parts) + " "
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in machine.iter(folded):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        for lo, hi in spared:
            for start in [s for s in best if lo <= s < hi]:
                del best[start]
        return best

    def density(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        return total / np.maximum(words, 1.0) ** self.power

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = self.offset + self.slope * self.density(total, words)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, loss) of a lightly damped logistic fit in one variable."""
    w, ridge = np.zeros(2), np.diag([1e-3, 1e-3])
    features = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        hessian = features.T * (p * (1 - p)) @ features + ridge
        w += np.clip(np.linalg.solve(hessian, features.T @ (y - p) - ridge @ w), -4, 4)
    p = np.clip(1 / (1 + np.exp(-np.clip(features @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w[0], w[1], float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    train_rows: int = 16_000, support: int = 4, support_share: float = 0.006, least_weight: float = 3.0, entries: int = 20_000,
    spare: int = 5, exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """Fit a lexicon on at most train_rows labelled rows."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    marks = labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    picked = scratch.save(_smallest(marks.distinct(), train_rows), "picked")
    texts = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(picked.select("id").distinct()), "id").groupBy("id").agg(F.min("text").alias("text"))
    rows = scratch.save(texts.join(F.broadcast(picked), "id").select("y", "text"), "train")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _counted(batches, entries_of)

    counted = rows.mapInArrow(count, "entry string, no long, yes long").groupBy("entry").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    counted = scratch.save(counted.filter((F.col("entry") == "") | (F.col("yes") >= support)), "counts")
    sizes = counted.filter("entry = ''").first()
    if not sizes or not sizes.no or not sizes.yes:
        scratch.drop(picked, rows, counted)
        if not sizes:
            return Lexicon({}, exceptions, offset=-30.0)
        return Lexicon({}, exceptions, slope=0.0, offset=30.0 if sizes.yes else -30.0)
    weight = F.log((F.col("yes") + 0.5) / (sizes.yes + 1)) - F.log((F.col("no") + 0.5) / (sizes.no + 1))
    found = counted.filter((F.col("entry") != "") & (F.col("yes") * 4 > F.col("no")))
    strong = _specific(found).withColumn("weight", weight).filter((F.col("weight") >= least_weight) & (F.col("yes") >= support_share * sizes.yes))
    got = strong.orderBy(F.desc("weight"), "entry").select("entry", "weight").limit(entries).collect()
    lexicon = Lexicon({r.entry: r.weight for r in got}, exceptions)
    lexicon.exceptions = (*exceptions, *_spared(rows, lexicon, spare))
    seen = evidence(rows, lexicon, "text", ["y"]).collect()
    scratch.drop(picked, rows, counted)
    y, total, words = (np.array([r[i] for r in seen], float) for i in range(3))
    fits = []
    for power in (0.125, 0.25, 0.5, 0.75, 1.0):
        lexicon.power = power
        slope, offset, loss = _logistic(lexicon.density(total, words), y)
        fits.append((loss, power, slope, offset))
    enough = min(fits)[0] * 1.05 + 0.002
    _, lexicon.power, lexicon.slope, lexicon.offset = next(f for f in fits if f[0] <= enough)
    return lexicon


def _smallest(marks: DataFrame, most: int) -> DataFrame:
    """The most rows (id, y) of the smallest hash of their id.

    Hashes are even, so a bound on them leaves about twice the rows wanted to be
    ordered in one task, whatever the rows; should fewer be left, all are ordered.
    """
    key, count = F.xxhash64("id"), marks.count()
    near = marks.filter(key <= int(2.0**64 * 2 * most / count) - 2**63) if count > 4 * most else marks
    if count > 4 * most and near.count() < most:
        near = marks
    return near.orderBy(key, "id", "y").limit(most)


def _counted(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """(entry, no, yes): harmless and toxic rows (y, text) that hold each entry; the entry '' is held by all."""
    for batch in batches:
        seen = (Counter(), Counter())
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[y].update(of(text) | {""})
        keys = sorted(set(seen[0]) | set(seen[1]))
        columns = [pa.array([seen[y][k] for k in keys], pa.int64()) for y in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *columns], ["entry", "no", "yes"])


def _spared(rows: DataFrame, lexicon: Lexicon, spare: int) -> list[str]:
    """Lexicon words with a neighbour that only harmless rows (y, text) hold, spare of them or more."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value.automaton()
        yield from _counted(batches, lambda text: shared.value.neighbours(text, machine))

    counted = rows.mapInArrow(run, "entry string, no long, yes long").groupBy("entry").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    return sorted(r.entry for r in counted.filter((F.col("entry") != "") & (F.col("no") >= spare) & (F.col("yes") == 0)).collect())


def _specific(found: DataFrame) -> DataFrame:
    """found (entry, no, yes) without beginnings that are found hardly more often than one longer entry alone."""
    sizes = F.sequence(F.lit(_LOW + 1), F.least(F.length("entry") - 1, F.lit(_HIGH + 1)))
    starts = found.filter(F.length("entry") > _LOW + 1).select("entry", "yes", F.explode(sizes).alias("n"))
    longest = starts.groupBy(F.expr("substring(entry, 1, n)").alias("start")).agg(F.max("yes").alias("most"))
    joined = found.join(longest, F.col("entry") == F.col("start"), "left")
    return joined.filter(F.col("entry").endswith(" ") | (F.col("yes") > 1.1 * F.coalesce("most", F.lit(0)))).select("entry", "no", "yes")


def evidence(docs: DataFrame, lexicon: Lexicon, text_col: str, keep: list[str]) -> DataFrame:
    """keep columns, total and words of every row."""
    ready(docs.sparkSession)
    slim = docs.select(*all_of(keep), col(text_col).cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value.automaton()
        for batch in batches:
            got = [shared.value.evidence(t.as_py(), machine) for t in batch.column(len(keep))]
            extra = [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *extra], [*keep, "total", "words"])

    schema = StructType([*slim.schema.fields[:-1], StructField("total", DoubleType()), StructField("words", LongType())])
    return slim.mapInArrow(run, schema)


def scores(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted, total, words) per row."""
    z = F.lit(lexicon.offset) + F.lit(lexicon.slope) * F.col("total") / F.pow(F.greatest(F.col("words").cast("double"), F.lit(1.0)), F.lit(lexicon.power))
    out = evidence(docs, lexicon, text_col, [id_col])
    out = out.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
    return out.select(id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "total", "words")


def held_out(id_col: str, parts: int = 4, part: int = 2):
    """Whether a row is kept from learning: crc32 of the id as text. Null ids are not."""
    return F.coalesce(F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value.automaton()
        for batch in batches:
            got = [shared.value.evidence(t.as_py(), machine) for t in batch.column(where)]
            score = shared.value.score(np.array([g[0] for g in got], float), np.array([g[1] for g in got], float))
            yield batch.filter(pa.array(score < threshold))

    return filter_batches(docs, run)
