"""Genotypes as sparse (position, letter) rows: identities, consensus, distances, labels."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.functions import seq as S
from strandframe.operators.common import distribution, runs

_ITEM = r"^([A-Z*]?)(\d+)([A-Z*]?)$"


def parse_genotype(subs: Column, dels: Column | None = None, shift: int = 1) -> Column:
    """Array of (pos, mut), 0-based, of ``A1T, G5C`` and deletions ``7del2``; insertions are ignored.

    shift is the base of the deletions' positions.
    """
    items = F.filter(F.split(F.coalesce(subs, F.lit("")), ", "), lambda x: x != "")
    points = F.transform(items, lambda x: F.struct((F.regexp_extract(x, r"(\d+)", 1).cast("int") - 1).alias("pos"), F.regexp_extract(x, r"\d+(.)$", 1).alias("mut")))
    if dels is None:
        return points
    cuts = F.filter(F.split(F.coalesce(dels, F.lit("")), ", "), lambda x: x != "")
    start = lambda x: F.regexp_extract(x, r"^(-?\d+)del", 1).cast("int") - shift
    gaps = F.flatten(F.transform(cuts, lambda x: F.transform(F.sequence(start(x), start(x) + F.regexp_extract(x, r"del(\d+)$", 1).cast("int") - 1), lambda p: F.struct(p.alias("pos"), F.lit("-").alias("mut")))))
    return F.concat(points, F.filter(gaps, lambda g: g["pos"] >= 0))


def apply_genotype(ref: Column, points: Column) -> Column:
    """The sequence that a genotype spells."""
    changed = F.map_from_entries(F.transform(points, lambda p: F.struct(p["pos"], p["mut"])))
    return F.array_join(F.transform(S.chars(ref), lambda c, i: F.coalesce(F.element_at(changed, i), c)), "")


def call_mutations(seqs: DataFrame, ref_col: str = "ref", seq_col: str = "seq", by: tuple[str, ...] = ("id",)) -> DataFrame:
    """(by, substitutions, deletions) of aligned sequences of reference length; both 1-based."""
    pairs = F.transform(F.arrays_zip(S.chars(F.col(ref_col)).alias("w"), S.chars(F.col(seq_col)).alias("m")), lambda x, i: F.struct(i.alias("pos"), x["w"].alias("w"), x["m"].alias("m")))
    rows = seqs.select(*by, F.explode(F.filter(pairs, lambda x: x["w"] != x["m"])).alias("x")).withColumn("pos", F.col("x.pos"))
    item = F.concat("x.w", (F.col("pos") + 1).cast("string"), "x.m")
    ordered = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["t"]), ", ")
    subs = rows.filter("x.m != '-'").groupBy(*by).agg(ordered(F.struct("pos", item.alias("t"))).alias("substitutions"))
    gaps = runs(rows.filter("x.m = '-'").select(*by, "pos"), list(by), "pos")
    text = F.concat((F.col("first") + 1).cast("string"), F.lit("del"), F.col("length").cast("string"))
    dels = gaps.groupBy(*by).agg(ordered(F.struct("first", text.alias("t"))).alias("deletions"))
    return seqs.select(*by).join(subs, list(by), "left").join(dels, list(by), "left").fillna("", ["substitutions", "deletions"])


def identities(genotypes: DataFrame, refs: DataFrame, weight: str | None = "count", alphabet: str = S.NT_ALPHABET) -> DataFrame:
    """(reference_name, position, wt, mutation, n): sequences with each letter at each position.

    genotypes: reference_name, points, weight. Only changed letters are
    counted; the wild type's count is what is left of the total.
    """
    w = F.col(weight) if weight else F.lit(1)
    changed = genotypes.select("reference_name", w.alias("w"), F.explode("points").alias("p")).groupBy("reference_name", F.col("p.pos").alias("pos"), F.col("p.mut").alias("mutation")).agg(F.sum("w").alias("n"))
    total = genotypes.groupBy("reference_name").agg(F.sum(w).alias("total"))
    spine = refs.join(total, "reference_name").select("reference_name", "total", F.posexplode(S.chars(F.col("seq"))).alias("pos", "wt"))
    spine = spine.withColumn("mutation", F.explode(F.array(*(F.lit(c) for c in alphabet))))
    dense = spine.join(changed, ["reference_name", "pos", "mutation"], "left").fillna({"n": 0})
    others = F.sum(F.when(F.col("wt") != F.col("mutation"), F.col("n")).otherwise(0)).over(Window.partitionBy("reference_name", "pos"))
    n = F.when(F.col("wt") == F.col("mutation"), F.col("total") - others).otherwise(F.col("n"))
    return dense.select("reference_name", (F.col("pos") + 1).cast("long").alias("position"), "wt", "mutation", n.cast("long").alias("n"))


def consensus(counts: DataFrame, alphabet: str = S.NT_ALPHABET) -> DataFrame:
    """(reference_name, consensus): the most frequent letter per position, the first of the alphabet of equals."""
    order = F.instr(F.lit(alphabet), F.col("mutation"))
    best = counts.groupBy("reference_name", "position").agg(F.max(F.struct("n", (-order).alias("o"), F.col("mutation").alias("c"))).alias("m"))
    letters = F.array_sort(F.collect_list(F.struct("position", F.col("m.c").alias("c"))))
    return best.groupBy("reference_name").agg(F.array_join(F.transform(letters, lambda x: x["c"]), "").alias("consensus"))


def abundance_bins(genotypes: DataFrame, by: tuple[str, ...] = (), count: str = "count") -> DataFrame:
    """Reads by order of magnitude of their genotype's count: bins (0,1], (1,10], (10,100], ..."""
    log = F.when(F.col(count) <= 1, 0).otherwise(F.length((F.col(count) - 1).cast("string")))
    return distribution(genotypes.withColumn("__b", log), "__b", list(by), count)


def matches(pattern: str, wt: Column, pos: Column, mut: Column) -> Column:
    """Whether a change is one of interest: A100G, 150, 150_, G_, _C or A_C (1-based)."""
    pattern = pattern.strip()
    if m := re.match(_ITEM, pattern):
        test = pos == int(m[2])
        for letter, col in ((m[1], wt), (m[3], mut)):
            test = test & (col == letter) if letter else test
        return test
    if m := re.match(r"^(\d+)_$", pattern):
        return pos == int(m[1])
    if m := re.match(r"^([A-Z*]?)_([A-Z*]?)$", pattern):
        test = F.lit(bool(m[1] or m[2]))
        for letter, col in ((m[1], wt), (m[2], mut)):
            test = test & (col == letter) if letter else test
        return test
    raise ValueError(f"no mutation pattern: {pattern}")


def label_interest(genotypes: DataFrame, wanted: str, groups: int, subs: str = "NT_substitutions", alphabet: str = S.NT_ALPHABET) -> DataFrame:
    """genotypes with label: their changes of interest; the commonest groups keep it, others get other, those without none."""
    patterns = [p for p in (x.strip() for x in wanted.split(",")) if p]
    items = F.filter(F.split(F.coalesce(F.col(subs), F.lit("")), ", "), lambda x: x != "")
    part = lambda x, k: F.regexp_extract(x, r"^(.)(\d+)(.)$", k)
    hit = lambda x: F.greatest(*(matches(p, part(x, 1), part(x, 2).cast("int"), part(x, 3)) for p in patterns), F.lit(False)) if patterns else F.lit(False)
    ranked = F.array_sort(F.transform(F.filter(items, hit), lambda x: F.struct(part(x, 2).cast("int").alias("p"), F.instr(F.lit(alphabet), part(x, 3)).alias("o"), x.alias("t"))))
    rows = genotypes.withColumn("__all", F.array_join(F.transform(ranked, lambda x: x["t"]), ", "))
    best = rows.filter("__all != ''").groupBy("__all").count().orderBy(F.desc("count"), "__all").limit(groups).select("__all", F.lit(True).alias("__top"))
    out = rows.join(F.broadcast(best), "__all", "left")
    return out.withColumn("label", F.when(F.col("__all") == "", "none").when(F.col("__top"), F.col("__all")).otherwise("other")).drop("__all", "__top")


def position_profile(tidy: DataFrame, by: tuple[str, ...] = ("reference_name",)) -> DataFrame:
    """Share of changed sequences per position, for colouring."""
    return tidy.groupBy(*by, "wt", "position").agg(F.sum("total_count").alias("total_count"), F.sum("proportion_of_seqs").alias("frequency"))


def conspicuous(tidy: DataFrame, positions: int, common: bool = True, ranges: str | None = None, by: tuple[str, ...] = ("reference_name",)) -> DataFrame:
    """Cells of the positions with most (or fewest) changes, or of given ranges; X, N and gaps apart.

    The wild type's cells get a proportion just below 0.
    """
    rows = tidy.filter(~F.col("mutation").isin("X", "N", "-"))
    if ranges:
        chosen = rows.filter(S.in_ranges(F.col("position"), ranges))
    else:
        totals = position_profile(rows, by)
        order = F.desc("total_count") if common else F.asc("total_count")
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(order, "position"))
        chosen = rows.join(totals.withColumn("__r", rank).filter(F.col("__r") <= positions).select(*by, "position"), [*by, "position"], "left_semi")
    return chosen.withColumn("proportion_of_seqs", F.coalesce("proportion_of_seqs", F.lit(-1e-6)))


def embed(genotypes: DataFrame, sites: int = 2000, dimensions: int = 2, by_id: str = "genotype_ID") -> DataFrame:
    """PCA of the one-hot (position, letter) matrix; a linear substitute for non-linear embeddings.

    All changes are its columns, as sparse vectors, if they are sites at most;
    more would need a matrix of their number squared on the driver, so that is an
    error: raise sites, or choose changes before.
    """
    from pyspark.ml.feature import PCA, CountVectorizer
    from pyspark.ml.functions import vector_to_array

    found = genotypes.select(F.explode("points").alias("p")).distinct().limit(sites + 1).count()
    if found > sites:
        raise ValueError(f"more than {sites} different changes")
    if found < dimensions:
        raise ValueError("fewer changes than dimensions")
    named = genotypes.withColumn("__t", F.transform("points", lambda x: F.concat(x["pos"].cast("string"), F.lit(":"), x["mut"])))
    counted = CountVectorizer(inputCol="__t", outputCol="__v", vocabSize=sites, binary=True).fit(named).transform(named)
    out = PCA(k=dimensions, inputCol="__v", outputCol="__p").fit(counted).transform(counted).withColumn("__p", vector_to_array("__p"))
    return out.select(*genotypes.columns, *(F.col("__p")[k].alias(f"PCA{k + 1}") for k in range(dimensions)))
