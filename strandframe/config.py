"""Run configuration: dataclasses, value coercion and the checks made before anything runs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.functions import seq as S


def coerce(text: str | None) -> Any:
    """A layout cell as a value: True, False, all, a whole number, a number, else text."""
    if text is None:
        return None
    if text in ("True", "False"):
        return text == "True"
    if re.fullmatch(r"[+-]?\d+", text):
        return int(text)
    try:
        return float(text) if text.lower() not in ("nan", "inf", "-inf", "infinity") else text
    except ValueError:
        return text


def as_bool(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    if str(value).strip().lower() in ("true", "false"):
        return str(value).strip().lower() == "true"
    raise ValueError(f"neither true nor false: {value!r}")


@dataclass
class Run:
    """One tag of a configuration."""

    tag: str
    runname: list[str] = field(default_factory=list)
    references: str = ""
    barcodes: str | None = None
    partition_groups: str | None = None
    label_groups: str | None = None
    umi_contexts: list[str] = field(default_factory=list)
    splint: str | None = None
    timepoint: str | None = None

    def errors(self) -> list[str]:
        out = [f"tag {self.tag}: {t}" for t, bad in (("no references", not self.references), ("names may not hold _", "_" in self.tag)) if bad]
        if self.partition_groups and not self.barcodes:
            out.append(f"tag {self.tag}: barcode groups without barcodes")
        return out


def shared_steps(runs: list[Run]) -> dict[tuple, list[str]]:
    """Tags that share raw data, UMI contexts, splint and references, so one consensus serves them."""
    out: dict[tuple, list[str]] = {}
    for r in runs:
        out.setdefault((tuple(r.runname), tuple(r.umi_contexts), r.splint, r.references), []).append(r.tag)
    return out


def context_errors(refs: DataFrame, contexts: list[str]) -> DataFrame:
    """(reference_name, context, n) where a context is not found exactly once."""
    up = F.upper("alignment_seq")
    rows = None
    for c in contexts:
        part = refs.select("reference_name", F.lit(c).alias("context"), S.count_of(up, c.upper()).alias("n"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.filter("n != 1")


def pattern_errors(refs: DataFrame, contexts: list[str]) -> DataFrame:
    """(reference_name, context) where an IUPAC context stands nowhere, its letters read as sets of bases."""
    rows = None
    for c in contexts:
        part = refs.filter(~F.upper("alignment_seq").rlike(S.context_pattern(c))).select("reference_name", F.lit(c).alias("context"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def group_errors(groups: DataFrame, words: DataFrame) -> DataFrame:
    """(group, barcode_type, name) of group members that no dictionary holds, and of names with a _."""
    members = groups.select("group", F.explode("members").alias("barcode_type", "name"))
    unknown = members.join(words.select("barcode_type", "name").distinct(), ["barcode_type", "name"], "left_anti").select("group", "barcode_type", "name")
    odd = groups.filter(F.col("group").contains("_")).select("group", F.lit(None).cast("string").alias("barcode_type"), F.lit(None).cast("string").alias("name"))
    return unknown.unionByName(odd)


def barcode_errors(info: dict[str, dict[str, Any]]) -> list[str]:
    """Mistakes of barcode types: fields missing, no barcode in the context, odd numbers."""
    out = []
    for name, row in info.items():
        context = str(row.get("context") or "").upper()
        if not context or set(context) - set(S.IUPAC):
            out.append(f"{name}: context is empty or not IUPAC")
        elif "N" not in context:
            out.append(f"{name}: context has no N")
        generate = row.get("generate", False)
        if generate not in (False, "all") and not isinstance(generate, int):
            out.append(f"{name}: generate is False, all or a number")
        if not generate and not row.get("fasta"):
            out.append(f"{name}: no fasta")
        if not isinstance(row.get("hamming_distance", 0), int) or row.get("hamming_distance", 0) < 0:
            out.append(f"{name}: hamming_distance is a whole number")
    return out


def timepoint_errors(columns: list[str], cells: list[str | None]) -> list[str]:
    """Mistakes of a time layout: headers that are no numbers, cells that are not tag_group."""
    out = [f"time {c} is no number" for c in columns if not isinstance(coerce(c), (int, float)) or isinstance(coerce(c), bool)]
    return out + [f"{c} is not tag_group" for c in cells if c and len(c.split("_")) != 2]
