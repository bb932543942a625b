"""Times report and license queries on tables with a hot user, larger than the given ones.

``SCALE_ROWS`` licenses (10 million unless set) over a tenth as many users; one user
holds a third of them, over many products. Tables are written once to ``SCALE_DIR``.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seatwise.functions.clock import Day  # noqa: E402
from seatwise.operators import expiry, reports  # noqa: E402
from seatwise.session import build_session  # noqa: E402

AS_OF: Day = "2025-09-10"
ROWS = int(os.environ.get("SCALE_ROWS", 10_000_000))
FOLDER = os.environ.get("SCALE_DIR", f"/tmp/seatwise-scale-{ROWS}")


def hot_licenses(spark: SparkSession, rows: int) -> DataFrame:
    number = F.xxhash64("id")
    pick = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    day = F.lit(AS_OF).cast("date")
    return spark.range(rows).select(
        F.hex(number).alias("license_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(pick(1, rows // 10)).cast("string").alias("userid"),
        F.concat(F.lit("Type "), pick(2, 3) + 1).alias("license_type"),
        F.date_sub(day, 100).alias("start_date"),
        F.date_add(day, (pick(3, 200) - 50).cast("int")).alias("expiry_date"),
        F.concat(F.lit("Product "), pick(4, 1000)).alias("product_name"),
        F.when(pick(5, 10) < 8, "ACTIVE").otherwise("EXPIRED").alias("status"),
    )


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench-scale", master=f"local[{cpus}]",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(f"{FOLDER}/licenses/_SUCCESS"):
        hot_licenses(spark, ROWS).write.mode("overwrite").parquet(f"{FOLDER}/licenses")
    licenses = spark.read.parquet(f"{FOLDER}/licenses")
    users = licenses.select("userid").distinct()
    timed = {
        "license_report": lambda: reports.full_report(licenses, AS_OF),
        "license_counts_grouping_sets": lambda: reports.counts_at_all_levels(licenses, AS_OF),
        "user_license_rows": lambda: expiry.user_licenses(users, licenses),
        "active_license_count_per_user": lambda: expiry.active_license_counts(licenses, AS_OF),
    }
    seconds = {}
    for name, build in timed.items():
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", 2))):
            began = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(runs), 2)
    print(json.dumps({"metric": "total", "value": round(sum(seconds.values()), 2), "unit": "sec",
                      "queries": seconds, "rows": ROWS}))


if __name__ == "__main__":
    main()
