"""Command line: ``python -m snapflow.llm QUERY TABLES OUT`` runs one of the operators' queries over a folder of tables and writes parquet."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from snapflow.llm.queries import QUERIES


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="snapflow.llm", description=__doc__)
    parser.add_argument("query", choices=QUERIES)
    parser.add_argument("tables", help="folder of documents.parquet, embeddings.parquet and so on")
    parser.add_argument("out")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"snapflow-{args.query}").getOrCreate()
    QUERIES[args.query](spark, args.tables).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
