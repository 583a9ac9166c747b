"""Sequence expressions: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements of the IUPAC letters, and of each the bases it stands for.
IUPAC, COMPLEMENTS = "ACGTMRWSYKVHDBN", "TGCAKYWSRMBDHVN"
IUPAC_BASES = {"M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}
# The standard genetic code for codons in the order T, C, A, G of each base.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip(("".join(c) for c in product("TCAG", repeat=3)), AMINO_ACIDS, strict=True))
NTS, AAS = "ATGC", "ACDEFGHIKLMNPQRSTVWY*"
NT_ALPHABET, AA_ALPHABET = "ATGC-N", "ACDEFGHIKLMNPQRSTVWY*-X"
_ORF = r"ATG(?:(?!TAA|TAG|TGA)...)*(?:TAA|TAG|TGA)"


def chars(c: Column) -> Column:
    """Characters of a string as an array."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(F.upper(c), IUPAC, COMPLEMENTS))


def translate_codon(c: Column) -> Column:
    """One amino acid; X for what is no codon of A, C, G, T. A codon is a number of three digits to the base 4."""
    known = (F.length(c) == 3) & (F.translate(c, "TCAG", "") == "")
    place = F.conv(F.translate(c, "TCAG", "0123"), 4, 10).cast("int") + 1
    return F.when(known, F.substring(F.lit(AMINO_ACIDS), place, F.lit(1))).otherwise("X")


def translate_nt(c: Column) -> Column:
    """Amino acids of the whole codons of a sequence."""
    return F.array_join(F.transform(F.regexp_extract_all(F.upper(c), F.lit("..."), F.lit(0)), translate_codon), "")


def hamming(a: Column, b: Column) -> Column:
    """Differing positions over the length of the shorter string."""
    n = F.least(F.length(a), F.length(b))
    cut = lambda c: chars(F.substring(c, F.lit(1), n))
    return F.size(F.filter(F.zip_with(cut(a), cut(b), lambda x, y: x != y), lambda d: d))


def longest_orf(c: Column) -> Column:
    """The longest reading frame of six, the first of equals; empty if there is none."""
    seq = F.upper(c)
    back = F.reverse(F.translate(seq, "ATGC", "TACG"))
    hits = F.concat(*(F.regexp_extract_all(F.substring(s, F.lit(i + 1), F.length(s)), F.lit(_ORF), F.lit(0)) for s in (seq, back) for i in range(3)))
    ranked = F.transform(hits, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("o"), x.alias("s")))
    return F.coalesce(F.array_max(ranked)["s"], F.lit(""))


def cigar_ops(c: Column) -> Column:
    """Array of (op, n)."""
    parts = F.regexp_extract_all(c, F.lit("[0-9]+[MIDNSHPX=]"), F.lit(0))
    return F.transform(parts, lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, r"^\d+", 0).cast("int").alias("n")))


def cigar_segments(ops: Column) -> Column:
    """Array of (op, n, r, q): every M, I or D with its offsets from the start of the alignment."""
    seg = "array<struct<op:string,n:int,r:int,q:int>>"
    start = F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.array().cast(seg).alias("s"))

    def step(acc: Column, x: Column) -> Column:
        on_ref, on_query = x["op"].isin("M", "D"), x["op"].isin("M", "I")
        this = F.struct(x["op"].alias("op"), x["n"].alias("n"), acc["r"].alias("r"), acc["q"].alias("q"))
        return F.struct(
            (acc["r"] + F.when(on_ref, x["n"]).otherwise(0)).alias("r"), (acc["q"] + F.when(on_query, x["n"]).otherwise(0)).alias("q"),
            F.when(on_ref | on_query, F.concat(acc["s"], F.array(this))).otherwise(acc["s"]).alias("s"),
        )

    return F.aggregate(ops, start, step)["s"]


def _unclipped(ops: Column, cut) -> Column:
    """What cut makes of the clipped lengths at both ends. The operations are worked out once, however often they are named."""
    clip = lambda x: F.coalesce(F.when(x["op"] == "S", x["n"]), F.lit(0))
    tail = lambda x: F.when(F.size(x) > 1, clip(F.element_at(x, -1))).otherwise(0)
    inner = F.array(F.filter(ops, lambda x: x["op"] != "H"))
    return F.get(F.transform(F.transform(inner, lambda x: F.struct(clip(F.get(x, F.lit(0))).alias("head"), tail(x).alias("tail"))), lambda c: cut(c["head"], c["tail"])), F.lit(0))


def aligned_query(seq: Column, ops: Column) -> Column:
    """The query without its soft-clipped ends."""
    return _unclipped(ops, lambda head, tail: F.substring(seq, head + 1, F.length(seq) - head - tail))


def aligned_quals(quals: Column, ops: Column) -> Column:
    return _unclipped(ops, lambda head, tail: F.slice(quals, head + 1, F.size(quals) - head - tail))


def _joined(segments: Column, piece) -> Column:
    return F.array_join(F.transform(segments, piece), "")


def gapped_reference(ref: Column, start: Column, segments: Column) -> Column:
    """The reference along the query: insertions are gaps, deletions are left out."""
    return _joined(segments, lambda x: F.when(x["op"] == "M", F.substring(ref, start + x["r"] + 1, x["n"])).when(x["op"] == "I", F.repeat(F.lit("-"), x["n"])).otherwise(""))


def covered_reference(ref: Column, start: Column, segments: Column) -> Column:
    """The reference bases that the alignment spans."""
    return _joined(segments, lambda x: F.when(x["op"].isin("M", "D"), F.substring(ref, start + x["r"] + 1, x["n"])).otherwise(""))


def gapped_query(query: Column, segments: Column) -> Column:
    """The query along the reference: deletions are gaps, insertions are left out."""
    return _joined(segments, lambda x: F.when(x["op"] == "M", F.substring(query, x["q"] + 1, x["n"])).when(x["op"] == "D", F.repeat(F.lit("-"), x["n"])).otherwise(""))


def both_sides(ref: Column, query: Column, start: Column, segments: Column) -> tuple[Column, Column]:
    """Both sides of an alignment, with gaps where the other has bases of its own."""
    mine = lambda x: F.substring(ref, start + x["r"] + 1, x["n"])
    theirs = lambda x: F.substring(query, x["q"] + 1, x["n"])
    gap = lambda x: F.repeat(F.lit("-"), x["n"])
    first = _joined(segments, lambda x: F.when(x["op"] == "I", gap(x)).otherwise(mine(x)))
    return first.alias("aligned_ref"), _joined(segments, lambda x: F.when(x["op"] == "D", gap(x)).otherwise(theirs(x))).alias("aligned_seq")


def marked_query(query: Column, segments: Column) -> Column:
    """The query along the reference, inserted bases in lower case behind the position they follow."""
    return _joined(segments, lambda x: F.when(x["op"] == "D", F.repeat(F.lit("-"), x["n"])).when(x["op"] == "I", F.lower(F.substring(query, x["q"] + 1, x["n"]))).otherwise(F.substring(query, x["q"] + 1, x["n"])))


def gapped_quals(quals: Column, segments: Column) -> Column:
    """Qualities along the reference, 0 where bases are deleted."""
    return F.flatten(F.transform(segments, lambda x: F.when(x["op"] == "M", F.slice(quals, x["q"] + 1, x["n"])).when(x["op"] == "D", F.array_repeat(F.lit(0), x["n"])).otherwise(F.array().cast("array<int>"))))


def match_line(ref: Column, query: Column) -> Column:
    """``|`` for equal bases, ``.`` for different ones, blank for deleted ones."""
    return F.array_join(F.zip_with(chars(ref), chars(query), lambda r, q: F.when(q == "-", " ").when(r == q, "|").otherwise(".")), "")


def find_context(gapped_ref: Column, context: str) -> Column:
    """(start, stop, reason) of the N run of a context in a gapped reference, 0-based.

    A gap next to the barcode makes its identification unsure.
    """
    context = context.upper()
    if "N" not in context:
        raise ValueError("a context needs an N run that marks the barcode")
    at = F.instr(gapped_ref, context) - 1
    start, stop = at + context.index("N"), at + context.rindex("N") + 1
    edge = (F.substring(gapped_ref, start, F.lit(1)) == "-") & (start > 0) | (F.substring(gapped_ref, stop + 1, F.lit(1)) == "-")
    reason = F.when(at < 0, F.lit("context_not_present")).when(edge, F.lit("low_confidence"))
    return F.struct(F.when(reason.isNull(), start).alias("start"), F.when(reason.isNull(), stop).alias("stop"), reason.alias("reason"))


def context_pattern(context: str) -> str:
    """A regular expression that an IUPAC context stands for."""
    return "".join(f"[{IUPAC_BASES[c]}]" if c in IUPAC_BASES and c != "N" else "[ACGTN]" if c == "N" else c for c in context.upper())


def count_of(text: Column, part: str) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def natural_key(c: Column) -> Column:
    """A sort key under which bc2 comes before bc10."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\d+|\D+"), F.lit(0)), lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x))


def log_fraction(c: Column, r: Column) -> Column:
    return F.ln((c + 0.5) / (r + 0.5))


def entity_id(*cols: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols))


def parse_read_name(c: Column) -> Column:
    """``UMI-7|ref-name|read_0`` to (umi, reference_name, read)."""
    return F.struct(
        F.regexp_extract(c, r"^UMI-([^|]*)", 1).alias("umi"), F.regexp_extract(c, r"\|ref-([^|]*)", 1).alias("reference_name"),
        F.regexp_replace(F.regexp_extract(c, r"([^|]*)$", 1), r"_0$", "").alias("read"),
    )


def parse_rca_name(c: Column) -> Column:
    """``name_quality_length_repeats_subread`` to its fields."""
    parts = F.split(c, "_")
    n = F.size(parts)
    field = lambda k: F.get(parts, n - k)
    return F.struct(
        F.array_join(F.slice(parts, 1, n - 4), "_").alias("read_id"), field(4).cast("double").alias("average_quality_score"), field(3).cast("int").alias("original_read_length"),
        field(2).cast("int").alias("number_of_complete_repeats"), field(1).cast("int").alias("subread_length"),
    )


def description_fields(c: Column) -> Column:
    """``a=1 b=2`` to a map."""
    return F.str_to_map(c, F.lit(" "), F.lit("="))


def position_ranges(text: str) -> list[tuple[int, int]]:
    """``20-30,50`` to inclusive ranges."""
    out = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        lo, _, hi = part.partition("-")
        out.append((int(lo), int(hi or lo)))
    return out


def in_ranges(c: Column, text: str) -> Column:
    tests = [c.between(lo, hi) for lo, hi in position_ranges(text)]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out
