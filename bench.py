"""Headline timings: one JSON line. Input tapes are written first and not timed.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import fixtures
import queries as Q
from loantape.operators import quality, skew
from loantape.operators import timeline as tl
from loantape.plans.loans import KEYS, loan_rollup
from loantape.plans.monthly import monthly_table
from loantape.session import SETTINGS
from loantape.sinks.tables import write_monthly
from loantape.sources import tape

RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="run-bench-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loantape-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", scratch)
        .config("spark.sql.files.maxPartitionBytes", "16m")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    folder = Q.write_tape(spark, sf_dir)
    id_map = Q.tables.write_id_map(fixtures.id_map(spark, sf_dir), f"{scratch}/map")
    staged: list = []

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    def load():
        rows = monthly_table(tape.scan_loans(spark, f"{folder}/*"), Q.AS_OF, masks=True)
        # One loan's rows lie in several part files here; real files hold whole loans.
        rows = rows.withColumn("file", Q.folder(F.col("file")))
        staged.append(write_monthly(rows, Q.new_folder(spark, "monthly")))

    def monthly():
        return staged[-1]

    def long_lives():
        # As many rows, of a fifteenth of the loans: some 60 months each.
        some = monthly().where(F.pmod(F.xxhash64("lnId"), F.lit(15)) == 0)
        months = some.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(14))))
        return months.withColumn("month", F.add_months("month", F.col("__i"))).drop("__i")

    def blank_ids():
        blank = F.pmod(F.xxhash64("lnId"), F.lit(3)) == 0
        return monthly().withColumn("lnId", F.when(blank, "").otherwise(F.col("lnId")))

    order = tl.order_key(F.col("month"), F.col("payHist"))
    item = {n: F.col(n) for n in ("month", "upb", "dq", "zb")}
    steps = {
        "load_tapes": load,
        "loan_rollup": lambda: drain(loan_rollup(monthly(), id_map)),
        "loan_rollup_by_a_column": lambda: drain(loan_rollup(monthly(), id_map, tie=["payHist"])),
        "loan_rollup_no_size_check": lambda: drain(loan_rollup(monthly(), id_map, piece=None)),
        "loan_rollup_60_months": lambda: drain(loan_rollup(long_lives(), id_map)),
        "loan_rollup_blank_id": lambda: drain(loan_rollup(blank_ids(), id_map)),
        "timeline": lambda: drain(tl.timeline(monthly(), KEYS, order, item)),
        "qa_profile": lambda: drain(quality.qa_profile(monthly(), KEYS)),
        "size_check": lambda: skew.hot_groups(monthly(), KEYS, tl.PIECE),
        "first_valid_date": lambda: drain(Q.first_valid_date(spark, sf_dir)),
        "link_successor": lambda: drain(Q.link_successor(spark, sf_dir)),
    }
    times, runs = {}, {}
    for name, step in steps.items():
        runs[name] = []
        # The first run compiles and is not counted.
        for i in range(RUNS + 1):
            start = time.time()
            step()
            if i:
                runs[name].append(round(time.time() - start, 3))
        times[name] = sorted(runs[name])[RUNS // 2]
    spark.stop()
    line = {
        "metric": "load_tapes + loan_rollup",
        "value": round(times["load_tapes"] + times["loan_rollup"], 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "runs": runs,
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
