"""Column names that cannot clash with those of an input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def prefix(*frames: DataFrame) -> str:
    """A prefix that no column of the tables begins with, whatever its case."""
    taken = [c.lower() for df in frames for c in df.columns]
    out = "_x"
    while any(c.startswith(out) for c in taken):
        out += "x"
    return out


def make_room(df: DataFrame, outputs: list[str], used: list[str] = ()) -> DataFrame:
    """df with every column that bears the name of an output renamed to that name and ``_in`` (again, until it is free).

    Columns in used are read by the operator and cannot be renamed: their clash is an error.
    """
    wanted, taken = {o.lower() for o in outputs}, {c.lower() for c in df.columns}
    if clash := [c for c in used if c is not None and c.lower() in wanted]:
        raise ValueError(f"output named like an input column: {clash}")
    names = []
    for c in df.columns:
        new = c
        if c.lower() in wanted:
            while new.lower() in wanted or new.lower() in taken:
                new += "_in"
            taken.add(new.lower())
        names.append(new)
    return df if names == df.columns else df.toDF(*names)


def filter_batches(df: DataFrame, run) -> DataFrame:
    """df through an Arrow function that drops rows; columns go by position, so any name will do."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
