"""Command line: ``python -m strandframe NAME IN_DIR OUT_DIR`` runs one registered query to Parquet or CSV."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from strandframe.plans import registry


def main() -> None:
    names = registry.queries()
    parser = argparse.ArgumentParser(prog="strandframe", description=__doc__)
    parser.add_argument("name", choices=sorted(names))
    parser.add_argument("tables", help="folder of the Parquet tables")
    parser.add_argument("out", help="folder to write")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(args.name).getOrCreate()
    writer = names[args.name](spark, args.tables).write.mode("overwrite").format(args.format)
    (writer.option("header", True) if args.format == "csv" else writer).save(args.out)


if __name__ == "__main__":
    main()
