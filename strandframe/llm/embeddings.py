"""Near-duplicate vectors: int8 tile products with rigorous error bounds.

*Classes.* Equal vectors of a label, told by their SHA-256, form one class; only
classes are compared.

*Quantisation.* A unit vector x is stored as int8 q with scale s; its error
norm e = |x - s q| is measured, not assumed. For two vectors
``|x.y - s t (q.r)| <= e + f + e f`` (Cauchy-Schwarz), so a tile's integer product
settles all pairs whose approximate cosine is farther from the threshold than
their bound, and only the others are recomputed in double precision from the
original components.

*Tiles.* The classes of a label, ordered by the signs of random projections, are
cut into blocks of about ``span`` vectors by the counts of their sign patterns;
a pattern that many share is dealt over blocks by the digest. Every two blocks of
a label are a task of bounded size, whatever the label's share of the rows: a
vector travels once per block of its label, class count / span times. Within a task,
strips of ``tile`` vectors with a centre and a radius are compared; two strips whose
caps are too far apart to hold a linked pair are passed over. A task returns link
counts per vector and each vector's link to the first of its group, never its
pairs, so dense groups cost a row per vector and task.

Defined cases: null, empty, zero vectors and vectors with null or non-finite
components, and rows with null label or null id, link with nothing. Vectors of
different lengths do not link. Rows that repeat an id and vector are separate
vectors for counts (each other's copies); each row is returned with the sum of
its id's links. Null ids get null components and are kept. Other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.llm._graph import components
from strandframe.llm._names import col
from strandframe.llm._store import Scratch

_BITS = 30
_EPS = 1e-9


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vec, code): components packed, null when unusable; code orders by direction."""
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column(2)
        offsets, null = lists.offsets.to_numpy(), np.array(lists.is_null())
        lengths, flat = np.where(null, 0, np.diff(offsets)), lists.values
        gaps = np.concatenate([[0], np.cumsum(np.array(flat.is_null()))])
        values = flat.fill_null(0).to_numpy(zero_copy_only=False)
        whole = (lengths > 0) & (gaps[offsets[:-1] + lengths] == gaps[offsets[:-1]])
        vecs, codes = np.full(len(batch), None, object), np.zeros(len(batch), np.int64)
        for n in np.unique(lengths[whole]).tolist():
            rows = np.flatnonzero(whole & (lengths == n))
            x = values[offsets[rows][:, None] + np.arange(n)] + 0
            usable = np.isfinite(x).all(axis=1) & x.any(axis=1)
            rows, x = rows[usable], x[usable] + x.dtype.type(0)
            if not len(rows):
                continue
            if n not in planes:
                planes[n] = np.random.default_rng(n).standard_normal((n, _BITS))
            bits = (x / np.abs(x).max(axis=1, keepdims=True)).astype(np.float64) @ planes[n] > 0
            codes[rows] = bits @ (1 << np.arange(_BITS, dtype=np.int64))
            raw, size = x.tobytes(), n * x.itemsize
            vecs[rows] = [raw[k : k + size] for k in range(0, len(raw), size)]
        columns = [batch.column(0), batch.column(1), pa.array(vecs, pa.binary()), pa.array(codes)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label", "vec", "code"])


def unit(vecs: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe against overflow."""
    x = vecs / np.abs(vecs).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and measured error norms of unit rows."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.sqrt(((x - scale[:, None] * q) ** 2).sum(axis=1))
    return q, scale, error * (1 + 1e-12) + 1e-15


def caps(x: np.ndarray, tile: int) -> list[tuple[slice, np.ndarray, float]]:
    """Strips of rows with their centre and the angle that holds all of them."""
    out = []
    for lo in range(0, len(x), tile):
        part = x[lo : lo + tile]
        centre = part.mean(axis=0)
        centre = unit(centre[None])[0] if np.abs(centre).max() > 1e-12 else part[0]
        out.append((slice(lo, lo + len(part)), centre, float(np.arccos(np.clip((part @ centre).min(), -1, 1)))))
    return out


def tile_links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, tile: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked rows of two blocks of unit vectors (above the diagonal if same)."""
    qx, sx, ex = quantise(x)
    qy, sy, ey = (qx, sx, ex) if same else quantise(y)
    fx, fy = qx.astype(np.float32), qy.astype(np.float32)
    width, reach = fx.shape[1], float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6
    strips_x = caps(x, tile)
    strips_y = strips_x if same else caps(y, tile)
    for k, (a, cx, rx) in enumerate(strips_x):
        for b, cy, ry in strips_y[k:] if same else strips_y:
            if float(np.arccos(np.clip(cx @ cy, -1, 1))) - rx - ry > reach:
                continue
            # Products of int8 codes are integers below 2**24 for up to 1024 components: exact in float32.
            parts = [fx[a, c : c + 1024] @ fy[b, c : c + 1024].T for c in range(0, width, 1024)]
            product = parts[0] if len(parts) == 1 else sum(part.astype(np.float64) for part in parts)
            near = product * sx[a, None] * sy[None, b]
            bound = ex[a, None] + ey[None, b] + ex[a, None] * ey[None, b] + _EPS
            i, j = np.nonzero(near >= threshold - bound)
            if same:
                upper = i + a.start < j + b.start
                i, j = i[upper], j[upper]
            exact = near[i, j] < threshold + bound[i, j]
            keep = ~exact
            if exact.any():
                keep[exact] = np.einsum("nd,nd->n", x[i[exact] + a.start], y[j[exact] + b.start]) >= threshold
            yield i[keep] + a.start, j[keep] + b.start


def group(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]], copies: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked copies per row of both blocks, and the first row of each row's group; rows of y begin at shift."""
    links, first = np.zeros(n), np.arange(n)
    for i, j in pairs:
        j = j + shift
        links += np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        a, b = first[i], first[j]
        while len(a := a[(apart := a != b)]):
            b = b[apart]
            np.minimum.at(first, np.maximum(a, b), np.minimum(a, b))
            while (first[first] != first).any():
                first = first[first]
            a, b = first[a], first[b]
    return links.astype(np.int64), first


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.93, tile: int = 512, span: int = 8192,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of vectors; see the module for the cases."""
    scratch = Scratch(vectors.sparkSession, "vectors")
    single = vectors.select(col(vec_col)).schema[0].dataType.simpleString() == "array<float>"
    kind = np.dtype(np.float32 if single else np.float64)
    slim = vectors.select(
        col(id_col).cast("long").alias("id"), col(label_col).cast("string").alias("label"), col(vec_col).cast("array<float>" if single else "array<double>").alias("v")
    )
    rows = slim.mapInArrow(_prepare, "id long, label string, vec binary, code long")
    rows = scratch.save(rows.withColumn("digest", F.sha2("vec", 256)), "rows")
    good = rows.filter("id is not null and label is not null and vec is not null")
    same = good.groupBy("label", "digest").agg(F.min("id").alias("head"), F.count("*").alias("copies"), F.first("code").alias("code"), F.first("vec").alias("vec"))
    classes = same.withColumn("width", F.octet_length("vec")).withColumn("range", F.shiftright("code", _BITS - 10))
    classes = scratch.save(classes, "classes")

    counts = classes.groupBy("label", "width", "range").agg(F.count("*").alias("c"))
    whole = Window.partitionBy("label", "width")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spots = counts.withColumn("begin", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("total", F.sum("c").over(whole))
    spots = scratch.save(spots.withColumn("blocks", F.ceil(F.col("total") / span)), "spots")
    dealt = F.pmod(F.xxhash64("digest"), F.lit(1 << 20)) / float(1 << 20)
    block = F.least(F.col("blocks") - 1, F.floor((F.col("begin") + dealt * F.col("c")) * F.col("blocks") / F.col("total")))
    placed = classes.join(spots, ["label", "width", "range"]).withColumn("block", block)
    placed = placed.select("label", "width", "block", "digest", "head", "copies", "code", "vec", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    tiles = placed.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        pdf = pdf.sort_values(["block", "code", "digest"])
        shift = 0 if same else int((pdf["block"] == pdf["lo"]).sum())
        x = unit(np.frombuffer(b"".join(pdf["vec"]), kind).reshape(len(pdf), -1).astype(np.float64))
        pairs = tile_links(x, x, True, threshold, tile) if same else tile_links(x[:shift], x[shift:], False, threshold, tile)
        links, first = group(len(pdf), pairs, pdf["copies"].to_numpy(np.float64), shift)
        some, heads = np.flatnonzero(links), pdf["head"].to_numpy()
        columns = {"label": pdf["label"].iloc[0], "digest": pdf["digest"].to_numpy()[some], "n": links[some], "a": heads[some], "b": heads[first[some]]}
        return pd.DataFrame(columns)

    found = tiles.groupBy("label", "width", "lo", "hi").applyInPandas(product, "label string, digest string, n long, a long, b long")
    found = scratch.save(found, "found")
    counted = found.groupBy("label", "digest").agg(F.sum("n").alias("n"))
    # One join on the digest, of two plain shuffles, so that the rows of a hot vector can be split at run time.
    known = scratch.save(classes.select("label", "digest", "head", "copies").join(counted, ["label", "digest"], "left"), "known")
    members = good.join(known, ["label", "digest"])
    members = scratch.save(members.select("id", "head", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")), "members")
    copied = members.filter("id != head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    comp = scratch.save(components(found.filter("a != b").select("a", "b").unionByName(copied), scratch), "components")
    per_id = members.groupBy("id").agg(F.sum("n").alias("n"))
    out = rows.select("id").join(per_id, "id", "left").join(comp, "id", "left")
    scratch.drop(classes, spots, found, known)
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )
