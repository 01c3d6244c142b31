"""python -m textloom QUERY SF_DIR OUT: run a query of the catalog and write its rows as Parquet."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from textloom.plans.catalog import CATALOG


def main(args: list[str]) -> int:
    if len(args) != 3 or args[0] not in CATALOG:
        print(__doc__, "\nQueries:", *sorted(CATALOG), file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"textloom {args[0]}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    CATALOG[args[0]].run(spark, args[1]).write.mode("overwrite").parquet(args[2])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
