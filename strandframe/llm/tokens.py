"""Token counts of a byte-level BPE tokenizer by rank-synchronous array merging.

A text is cut into pre-tokens by the tokenizer's pattern. The bytes of many
pre-tokens lie behind each other in one array, with the number of the pre-token
that each belongs to. A round looks up the ranks of all neighbouring symbols,
finds the lowest of every pre-token, and merges all its occurrences at once, from
the left where they overlap. Pre-tokens without a known pair left are done: their
symbols are counted and leave the arrays. A new pair is always of a higher rank
than the merge that made it, so this ends where merging one by one does.

Counts of pre-tokens met before are remembered by a task, up to ``REMEMBERED``;
that saves work and changes nothing. Texts are read in windows of ``WINDOW``
characters that end between pre-tokens, and worked off in slices of ``SLICE``
characters, so a text of any length takes the memory of a slice (of its longest
pre-token, if that is longer). No shuffle: rows are counted where they are read.

The tokenizer's file is read on the driver; its merges (two integers each) are
sent to the tasks. Strings of its added tokens count as one token each, as the
library does by default.

Defined cases: a null text counts as empty: 0 bytes, 0 tokens. Bytes that are no
UTF-8 count as the replacement character each. Other columns are kept as they
are; those named as an output come out with ``_in`` appended. Repeated rows are
counted each; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandframe.llm._names import all_of, col, make_room
from strandframe.llm._store import ready

OUTPUTS = ("__bytes", "__tokens")
WINDOW, SLICE, REMEMBERED = 1 << 18, 1 << 20, 1 << 19
# Fixed value: the pattern by which byte-level BPE cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII alone, where its classes are plain.
_PLAIN = PATTERN.replace("[^\\s\\p{L}\\p{N}]", r"[^\x09-\x0d\x20A-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]").replace(r"\s", r"[\x09-\x0d\x20]").replace(r"\S", r"[^\x09-\x0d\x20]")
#: Pre-tokens at a window's end that the text behind it can still change.
OPEN = 3
_NONE = np.int32(2**31 - 1)


@dataclass
class Merges:
    """The merges of a tokenizer as sorted arrays, and its added strings."""

    first: np.ndarray  # symbol of each byte
    pairs: np.ndarray  # left * size + right, ascending
    ranks: np.ndarray
    merged: np.ndarray
    size: int
    added: list[str]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank _NONE where there is none."""
        pair = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], _NONE), self.merged[at]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def load(path: str) -> Merges:
    """The merges of a tokenizer file; an error for one of another kind than byte-level BPE."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = not spec["normalizer"] and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"] and cut["use_regex"]
    if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("byte_fallback") or model.get("dropout"):
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
        raise ValueError("added tokens that take blanks or whole words are not supported")
    vocab = model["vocab"]
    halves = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    size = max(vocab.values()) + 1
    pairs = np.array([vocab[a] * size + vocab[b] for a, b in halves], np.int64)
    # A pair listed twice counts by its later place, as in the library.
    keys, last = np.unique(pairs[::-1], return_index=True)
    ranks = (len(pairs) - 1 - last).astype(np.int32)
    merged = np.array([vocab[a + b] for a, b in halves], np.int32)
    first = np.array([vocab[letter] for letter in byte_letters()], np.int32)
    return Merges(first, keys, ranks, merged[ranks], size, [a["content"] for a in spec["added_tokens"]])


def symbols_left(words: list[bytes], merges: Merges) -> np.ndarray:
    """The number of tokens of each pre-token."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = sizes.copy()
    symbols = merges.first[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    while len(symbols):
        ranks = np.full(len(symbols), _NONE)
        found, merged = merges.look_up(symbols[:-1], symbols[1:])
        inside = owner[:-1] == owner[1:]
        ranks[:-1][inside] = found[inside]
        starts = np.flatnonzero(np.concatenate([[True], ~inside]))
        lengths = np.diff(np.append(starts, len(symbols)))
        lowest = np.minimum.reduceat(ranks, starts)
        alive = lowest < _NONE
        out[owner[starts[~alive]]] = lengths[~alive]
        at = np.flatnonzero((ranks == np.repeat(lowest, lengths)) & (ranks < _NONE))
        # Occurrences that overlap are neighbours: every second one of such a run is merged.
        begins = np.diff(at, prepend=-2) != 1
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
        symbols[at] = merged[at]
        stay = np.repeat(alive, lengths)
        stay[at + 1] = False
        symbols, owner = symbols[stay], owner[stay]
    return out


@lru_cache(maxsize=1)
def _cutters():
    """The pattern for ASCII and for all texts, characters that Unicode versions may class differently, and the library, which cuts where those are."""
    from tokenizers.pre_tokenizers import ByteLevel

    unsure = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])
    return re.compile(_PLAIN), regex.compile(PATTERN), unsure, ByteLevel(add_prefix_space=False, use_regex=True)


def _cut(part: str) -> list[str]:
    plain, pattern, unsure, library = _cutters()
    if part.isascii():
        return plain.findall(part)
    if unsure[np.frombuffer(part.encode("utf-32-le"), np.uint32)].any():
        return [part[a:b] for _, (a, b) in library.pre_tokenize_str(part)]
    return pattern.findall(part)


def pre_tokens(text: str, window: int = WINDOW) -> Iterator[list[str]]:
    """The pre-tokens of a text in lists, window after window."""
    at, wide = 0, window
    while at < len(text):
        found = _cut(text[at : at + wide])
        if at + wide < len(text):
            if len(found) <= OPEN:
                wide *= 2
                continue
            del found[-OPEN:]
        yield found
        at, wide = at + sum(map(len, found)), window


class Counter:
    """Token counts of texts one after the other, with a bounded memory of pre-tokens."""

    def __init__(self, merges: Merges):
        self.merges, self.known = merges, {}
        self.added = re.compile("|".join(map(re.escape, sorted(merges.added, key=len, reverse=True)))) if merges.added else None

    def counts(self, texts: Iterator[str], rows: int) -> np.ndarray:
        out, waiting, size = np.zeros(rows, np.int64), [], 0
        for row, text in enumerate(texts):
            parts = self.added.split(text) if self.added else [text]
            out[row] += len(parts) - 1
            for part in parts:
                for found in pre_tokens(part):
                    waiting.append((row, found))
                    size += sum(map(len, found))
                    if size >= SLICE:
                        self.settle(waiting, out)
                        waiting, size = [], 0
        self.settle(waiting, out)
        return out

    def settle(self, waiting: list[tuple[int, list[str]]], out: np.ndarray) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({w for _, found in waiting for w in found} - self.known.keys())
        if new:
            self.known.update(zip(new, symbols_left([w.encode() for w in new], self.merges).tolist(), strict=True))
        count = self.known.__getitem__
        for row, found in waiting:
            out[row] += sum(map(count, found))


def count(docs: DataFrame, path: str, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The columns (all by default) of docs with the bytes and tokens of every whole text, as ``__bytes`` and ``__tokens``."""
    spark = docs.sparkSession
    ready(spark)
    merges = spark.sparkContext.broadcast(load(path))
    docs = make_room(docs, list(OUTPUTS), [text_col])
    kept = docs.columns if columns is None else columns
    plain = docs.select(F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary"), *all_of(kept)).toDF(*(f"c{k}" for k in range(len(kept) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges.value)
        for batch in batches:
            texts = batch.column(0)
            counts = counter.counts((t.as_py().decode("utf-8", "replace") for t in texts), len(batch))
            sizes = np.array([len(t.as_buffer()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sizes), pa.array(counts)], names)

    fields = [*plain.schema.fields[1:], *(T.StructField(o, T.LongType()) for o in OUTPUTS)]
    names = [f.name for f in fields]
    return plain.mapInArrow(run, T.StructType(fields)).toDF(*kept, *OUTPUTS)
