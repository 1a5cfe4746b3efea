"""``python -m tillroll --raw lines.csv --out folder [--analytics]``"""

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tillroll.plans.medallion import run_pipeline


def main() -> int:
    parser = argparse.ArgumentParser(prog="tillroll", description=__doc__)
    parser.add_argument("--raw", required=True, help="CSV file or folder of invoice lines")
    parser.add_argument("--out", required=True, help="folder for bronze, silver and gold")
    parser.add_argument("--analytics", action="store_true", help="reports and layout timing")
    chosen = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return run_pipeline(spark, chosen.raw, chosen.out, chosen.analytics)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
