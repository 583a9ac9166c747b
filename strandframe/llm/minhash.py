"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

*Signature.* A document's set holds the hashes of its distinct 5-word
shingles. One random permutation (``_spread``) scatters the set over the
32-bit circle; the second (``_permute``) is used at ``bands * rows`` circular
shifts, so two permutations give all signature coordinates.

*Classes.* Documents with the same set form one class; only its smallest id is
banded, so exact copies cost one row each, whatever their number.

*Links.* Every bucket of a band is a star around its smallest id. Each member
is compared with the centre on the full sets (``100 * common >= 75 * union``),
exact copies aside. Around centres whose members are then still in different
components the search goes on: what a member has and the centre lacks (few
shingles, as a rule) decides which members outside the largest component can
be linked with whom (see ``unsettled``); those pairs are verified on full sets
too. A hot bucket of true copies ends after its star, and one that only shares
a frequent passage after a join on rare shingles; nothing is capped and no
bucket's pairs are all emitted.

A pair at similarity 0.75 shares no bucket with probability
(1 - 0.75**3)**24 = 2e-6; one that is not found by its centre's star is passed over
with probability 1e-7 more, as its signatures are compared before its sets.

Defined cases: null or empty text and text without words have an empty set,
``n_shingles`` 0 and no links. Repeated rows of one id count as one document
whose links are those of all its rows; each row is returned. Rows with null id
are returned with null component and ``kept`` true. Other columns are ignored; an
empty table gives an empty one. Texts are compared whole, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.llm._graph import components
from strandframe.llm._names import all_of, col, prefix
from strandframe.llm._store import Scratch
from strandframe.llm._words import Words, mix64, word_slices

_U, _U32 = np.uint64, np.uint32
#: A shingle that one in so many members of a bucket centre have belongs to the centre.
COMMON = 3
#: Tasks that the rows of one bucket centre are dealt over.
SALTS = 16
_WEIGHTS = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.uint64) * _U(2) + _U(1)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row of a slice: values and bounds.

    A row of fewer words than ``size`` gives its whole sequence as one shingle.
    """
    h, b = words.hashes, words.bounds
    lengths = np.diff(b)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if not bounds[-1]:
        return np.zeros(0, _U), bounds
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - b[:-1], counts)
    width = np.repeat(np.minimum(lengths, size), counts)
    value = width.astype(_U)
    for k in range(size):
        if (whole := k < width).all():
            value += h[at + k] * _WEIGHTS[k % 64]
        else:
            value[whole] += h[at[whole] + k] * _WEIGHTS[k % 64]
    value = mix64(value)
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        value[s:e].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    fresh[bounds[:-1][counts > 0]] = True
    return value[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def _spread(x: np.ndarray) -> np.ndarray:
    return (mix64(x + _U(0x632BE59BD9B4E019)) >> _U(32)).astype(_U32)


def _permute(v: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit circle, in place."""
    v ^= v >> _U32(16)
    v *= _U32(0x7FEB352D)
    v ^= v >> _U32(15)
    v *= _U32(0x846CA68B)
    v ^= v >> _U32(16)
    return v


def circulant_minhash(values: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures (rows, coordinates) of non-empty sets given as values and bounds."""
    place, starts = _spread(values), bounds[:-1]
    out = np.empty((len(starts), coordinates), _U32)
    shift = (1 << 32) // coordinates | 1
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(_permute(place - _U32(k * shift & 0xFFFFFFFF)), starts)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    parts = signature.reshape(len(signature), bands, rows).astype(_U)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), parts.shape[:2]) * _U(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = mix64(key ^ parts[:, :, k]) * _WEIGHTS[k]
    return mix64(key)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(id, n, d1, d2, keys, sketch) per row: set size, 128-bit set digest, band keys, a byte per coordinate.

    Empty sets have no keys and an empty sketch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in word_slices(batch.column(1)):
                values, bounds = shingles(w, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                keys, low = np.zeros((0, bands), _U), b""
                digest = np.zeros((2, len(n)), _U)
                if len(full):
                    held = np.append(bounds[full], bounds[-1])
                    for i, salt in enumerate((0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)):
                        digest[i, full] = np.add.reduceat(mix64(values + _U(salt)), bounds[full])
                    signature = circulant_minhash(values, held, bands * rows)
                    keys, low = band_keys(signature, bands, rows), signature.astype(np.uint8).tobytes()
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                ends = offsets * rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first, w.last - w.first), pa.array(n, pa.int64()),
                        *(pa.array(d.view(np.int64)) for d in digest),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64))),
                        pa.array([low[s:e] for s, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                    ],
                    ["id", "n", "d1", "d2", "keys", "sketch"],
                )

    slim = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "id long, n long, d1 long, d2 long, keys array<long>, sketch binary")


def bloom(ids: DataFrame, most_bits: int = 1 << 26) -> tuple[np.ndarray, int]:
    """A Bloom filter of the column id, as 64-bit words of at most most_bits bits (8 MB).

    It only spares work: beyond its capacity it lets everything pass.
    """
    count = ids.count()
    bits = min(most_bits, 1 << max(16, math.ceil(math.log2(max(1, count))) + 4))
    at = F.explode(F.array(*(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(bits)) for k in range(2)))).alias("at")
    words = ids.select(at).groupBy((F.col("at") / 64).cast("long").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("v"))
    table = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("w").to_numpy()] = table.column("v").to_numpy()
    return out, bits


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, items): the sorted distinct shingle hashes, as packed 64-bit words, of the rows with the given ids.

    Rows are picked by a Bloom filter before any set is built, so that only the
    sets of candidates are shuffled, never all texts.
    """
    bits_of, bits = bloom(ids)
    shared = docs.sparkSession.sparkContext.broadcast(bits_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            maybe = np.ones(len(batch), bool)
            for k in (2, 3):
                at = batch.column(k).to_numpy()
                maybe &= words[at >> 6] >> (at & 63) & 1 == 1
            picked = batch.filter(pa.array(maybe))
            for w in word_slices(picked.column(1)):
                values, bounds = shingles(w, size)
                items = pa.array([values[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([picked.column(0).slice(w.first, w.last - w.first), items], ["id", "items"])

    spots = (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(bits)).alias(f"at{k}") for k in range(2))
    slim = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text")).filter("id is not null")
    found = slim.select("id", "text", *spots).mapInArrow(run, "id long, items binary")
    return found.join(ids, "id", "left_semi")


def _compared(percent: int, novel: bool):
    """Pairs with the sizes of both sets and of what they share; novel: what a has and b lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            numbers, fresh = np.zeros((len(batch), 3), np.int64), []
            for i in range(len(batch)):
                x, y = np.frombuffer(left[i].as_buffer(), _U), np.frombuffer(right[i].as_buffer(), _U)
                shared = np.isin(x, y, assume_unique=True) if novel else None
                if novel:
                    numbers[i] = len(x), len(y), np.count_nonzero(shared)
                    fresh.append(x[~shared].view(np.int64))
                else:
                    both = np.concatenate([x, y])
                    both.sort()
                    numbers[i] = len(x), len(y), np.count_nonzero(both[1:] == both[:-1])
            na, nb, both = numbers.T
            linked = (100 * both >= percent * (na + nb - both)) & (na > 0) & (nb > 0)
            columns = [batch.column(0), batch.column(1), pa.array(na), pa.array(both), pa.array(linked)]
            if novel:
                columns.append(pa.array(fresh, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "common", "linked", "novel"][: len(columns)])

    return run


def compare(pairs: DataFrame, sets: DataFrame, percent: int, novel: bool = False) -> DataFrame:
    """(a, b, n, common, linked[, novel]) of pairs on their full sets.

    Sets travel to the pairs by sort-merge joins; a b with many partners is a
    hot key that is split at run time.
    """
    wide = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    wide = wide.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
    schema = "a long, b long, n long, common long, linked boolean" + ", novel array<long>" * novel
    return wide.mapInArrow(_compared(percent, novel), schema)


def _hopeful(pairs: DataFrame, coordinates: int, percent: int) -> DataFrame:
    """The different pairs (a, b) of rows (a, b, x, y) whose signatures x, y do not rule the similarity out (5.4 standard deviations).

    Signatures are compared where the pairs arise; only those left are shuffled.
    """
    share = percent / 100
    least = math.ceil(coordinates * share - 5.4 * math.sqrt(coordinates * share * (1 - share)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, coordinates) for i in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return pairs.mapInArrow(run, "a long, b long").distinct()


def _join_centres(rows: DataFrame, by: list[str], centres: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined to the few rows of their centre h; the rows of one centre are dealt over SALTS tasks by columns."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    copies = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["h", "salt"], how).drop("salt")


def unsettled(stars: DataFrame, comp: DataFrame, sketches: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs (a, b, x, y) around one centre, in different components, that their deltas to it allow to be linked; x, y: signatures.

    The centre h is its document's set and what a third of its members have
    besides, so that one odd document is as good a centre as any. Of two sets
    x, y around it, what they share inside h is at most min(|x & h|, |y & h|).
    Either that alone can reach the similarity, which depends on four numbers
    and is joined on their distinct values, or x and y share novel shingles
    (outside h): then their rarest common one is among the
    first ``novel - needed + 1`` of each, rarest first, and they meet in a join on
    it. Members of a centre's largest component are not paired with each other.
    Nothing is dealt by the centre alone: sums have a map side, and joins are
    salted. What is usual around a centre is bounded by the length of its texts.
    """
    p = percent
    group = stars.select(F.col("b").alias("h"), F.col("a").alias("id"), "n", F.col("common").alias("i"), "novel").join(comp, "id", "left")
    group = group.withColumn("comp", F.coalesce("component", "id")).drop("component")
    split = group.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).filter("lo < hi").select("h", "size")
    group = scratch.save(_join_centres(group, ["id"], scratch.save(split, "split")), "members")
    counted = group.select("h", "size", F.explode("novel").alias("s")).groupBy("h", "s", "size").agg(F.count("*").alias("f"))
    common = counted.filter((F.col("f") * COMMON > F.col("size")) & (F.col("f") > 1)).groupBy("h").agg(F.collect_list("s").alias("usual"))
    group = _join_centres(group.drop("size"), ["id"], common, "left")
    outside = F.when(F.col("usual").isNull(), F.col("novel")).otherwise(F.array_except("novel", "usual"))
    group = group.withColumn("own", outside).withColumn("i", F.col("i") + F.size("novel") - F.size("own"))
    group = scratch.save(group.select("h", "id", "n", "i", F.col("own").alias("novel"), "comp"), "group")
    most = F.max(F.struct(F.col("count"), (-F.col("comp")).alias("least"))).alias("most")
    main = group.groupBy("h", "comp").count().groupBy("h").agg(most).select("h", (-F.col("most.least")).alias("main"))
    marked = _join_centres(group, ["id"], main).withColumn("aside", F.col("comp") != F.col("main")).drop("main")
    marked = scratch.save(marked.join(sketches, ["id", "n"]), "marked")

    x = lambda c: F.col(f"x_{c}")
    fits = F.least(F.col("n"), x("n")) * 100 >= F.greatest(F.col("n"), x("n")) * p
    needed = p * (F.col("n") + x("n"))  # of (100 + p) * shared
    reach = F.least(F.col("i"), x("i"))
    as_x = lambda df, *cols: df.filter("aside").select("h", *(F.col(c).alias(f"x_{c}") for c in cols))

    inside = marked.select("h", "n", "i", "aside").distinct()
    numbers = _join_centres(inside.select("h", "n", "i").distinct(), ["n", "i"], as_x(inside, "n", "i").distinct())
    numbers = numbers.filter(fits & (reach * (100 + p) >= needed))
    members = marked.select("h", "id", "n", "i", "comp", "sketch")
    by_numbers = numbers.join(members, ["h", "n", "i"]).join(as_x(marked, "id", "n", "i", "comp", "sketch"), ["h", "x_n", "x_i"])

    rows = marked.select("h", "id", "n", "i", "comp", "aside", "sketch", F.size("novel").alias("m"), F.explode("novel").alias("s"))
    rarity = rows.groupBy("h", "s").agg(F.count("*").alias("f")).filter("f > 1")
    rank = F.row_number().over(Window.partitionBy("h", "id", "n").orderBy("f", "s"))
    # Shingles that one member alone has come first and meet nothing; they only use up places.
    shared = rows.join(rarity, ["h", "s"]).withColumn("alone", F.col("m") - F.count("*").over(Window.partitionBy("h", "id", "n")))
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * p / 100) - F.col("i"))
    first = shared.withColumn("r", rank + F.col("alone")).filter(F.col("r") <= F.col("m") - least + 1).select("h", "s", "id", "n", "i", "comp", "aside", "m", "sketch")
    both = (reach + F.least(F.col("m"), x("m"))) * (100 + p) >= needed
    by_novel = first.join(as_x(first, "s", "id", "n", "i", "comp", "m", "sketch").withColumnRenamed("x_s", "s"), ["h", "s"]).filter(fits & both)
    found = [
        df.filter("comp != x_comp").select(F.greatest("id", "x_id").alias("a"), F.least("id", "x_id").alias("b"), F.col("sketch").alias("x"), F.col("x_sketch").alias("y"))
        for df in (by_numbers, by_novel)
    ]
    return found[0].unionByName(found[1])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    size: int = 5, percent: int = 75, bands: int = 24, rows: int = 3,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of docs; see the module for the cases."""
    scratch = Scratch(docs.sparkSession, "minhash")
    sig = scratch.save(signatures(docs, id_col, text_col, size, bands, rows), "signatures")
    full = sig.filter("n > 0 and id is not null")
    rep = scratch.save(full.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("c")), "classes")
    copies = full.join(rep.filter("c > 1"), ["d1", "d2", "n"]).filter("id > rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    banded = full.join(rep.select("d1", "d2", "n", F.col("rep").alias("id")), ["d1", "d2", "n", "id"], "left_semi")
    banded = banded.select("id", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("key", "first")
    shared = scratch.save(shared, "firsts")  # a join of two plain shuffles: the rows of a hot key can be split at run time
    stars = banded.join(shared, "key").filter("id > first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    stars = scratch.save(stars.distinct(), "stars")
    ids = stars.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = scratch.save(shingle_sets(docs, scratch.save(ids, "ids"), id_col, text_col, size), "sets")
    compared = scratch.save(compare(stars, sets, percent, novel=True), "compared")
    links = scratch.save(compared.filter("linked").select("a", "b").unionByName(copies).distinct(), "links")
    comp = scratch.save(components(links, scratch), "components")
    pairs = _hopeful(unsettled(compared, comp, full.select("id", "n", "sketch"), scratch, percent), bands * rows, percent)
    more = scratch.save(compare(scratch.save(pairs, "pairs"), sets, percent).filter("linked").select("a", "b").distinct(), "more")
    if not more.isEmpty():
        known = comp.filter("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        comp = scratch.save(components(known.unionByName(more), scratch), "components")
    scratch.drop(sets)
    out = sig.select("id", "n").join(comp, "id", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns.

    Rows that share a kept id are documents of their own here: of those with
    texts that are linked, however indirectly, the one with the least hash of id and
    text stays, and of rows equal in id and text that with the least hash of all
    columns. Differing texts are never lost. Rows with null id stay.
    """
    p, scratch, names = prefix(docs), Scratch(docs.sparkSession, "first"), docs.columns
    gone = near_duplicates(docs, id_col, text_col).filter("not kept").select(col(id_col).alias(f"{p}gone")).distinct()
    left = docs.join(gone, col(id_col).cast("long") == F.col(f"{p}gone"), "left_anti")
    many = left.filter(col(id_col).isNotNull()).groupBy(col(id_col).alias(f"{p}id")).agg(F.count("*").alias("c")).filter("c > 1")
    many = scratch.save(many.select(f"{p}id"), "repeated")
    if many.isEmpty():
        return left
    once = left.join(many, col(id_col) == F.col(f"{p}id"), "left_anti")
    again = left.join(many, col(id_col) == F.col(f"{p}id"), "left_semi")
    whole = F.min_by(F.struct(*all_of(names)), F.xxhash64(*all_of(names))).alias("row")
    key = F.xxhash64(col(id_col), col(text_col))
    texts = scratch.save(again.groupBy(key.alias("key"), col(text_col).alias("text")).agg(whole), "texts")
    kept = near_duplicates(texts, "key", "text").filter("kept").select("key").distinct()
    return once.unionByName(texts.join(kept, "key", "left_semi").select("row.*"))
