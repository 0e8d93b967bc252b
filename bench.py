"""Benchmark: validation and the full analysis chain on the driver tables.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line.  Stages:

  prepare   render the sales rows as raw delimited lines and write them
            (stands in for the input CSV; not part of the measured chain)
  validate  first-failure rules over every line; valid rows and quarantine written
  clean     typing, essential filter, imputation, derived columns, flags, z-scores; written
  <report>  each analysis over the written clean table

``value`` is the wall time of validate + clean + all reports (the full chain).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from salescope.operators import clean as C  # noqa: E402
from salescope.operators import hypothesis as H  # noqa: E402
from salescope.operators import profile as PR  # noqa: E402
from salescope.operators import timeseries as TS  # noqa: E402
from salescope.operators import validate as V  # noqa: E402
from salescope.plans import reports as RP  # noqa: E402
from salescope.schema import NUMERIC  # noqa: E402
from salescope.session import build_session, checkpoint_dir  # noqa: E402
from salescope.sources.sales import raw_lines  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # Intermediate tables go to the shared folder the session names (spark.checkpoint.dir).
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def write(df, name):
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    n_files = 2 * spark.sparkContext.defaultParallelism
    lines = timed("prepare", lambda: write(raw_lines(spark, sf_dir).repartition(n_files, "record_no"), "raw_lines"))
    n_lines = lines.count()

    def validate():
        checked = write(V.first_failure(lines), "checked")
        write(V.valid_rows(checked), "valid")
        write(V.quarantine_lines(checked), "quarantine")
        return checked
    checked = timed("validate", validate)

    def clean():
        typed = C.coerce_types(spark.read.parquet(f"{scratch}/valid"))
        typed = typed.drop("product", "first_names", "last_names")
        return write(C.clean(typed, cut_lineage=True), "clean")
    cl = timed("clean", clean)
    n_clean = cl.count()

    daily = PR.daily_sales(cl).persist()
    reports = {
        "validation_totals": lambda: V.validation_totals(checked).collect(),
        "missing_report": lambda: PR.missing_report(spark.read.parquet(f"{scratch}/valid")).collect(),
        "descriptive_stats": lambda: PR.descriptive_stats(cl, NUMERIC).collect(),
        "quantiles": lambda: PR.quantile_table(cl, NUMERIC).collect(),
        "daily_sales": lambda: daily.collect(),
        "seasonal_decompose": lambda: TS.seasonal_decompose(daily).collect(),
        "acf": lambda: TS.acf(daily).collect(),
        "box_stats": lambda: PR.box_stats(cl).collect(),
        "density_histogram": lambda: PR.density_histogram(cl, "amount", 40).collect(),
        "spearman_matrix": lambda: H.spearman_pairs(
            cl, [(NUMERIC[i], NUMERIC[j]) for i in range(6) for j in range(i + 1, 6)]).collect(),
        "chi_square": lambda: H.chi_square(cl, "channel", "store").collect(),
        "anova_kruskal": lambda: (H.anova(cl, "store", "amount").collect(),
                                  H.kruskal(cl, "store", "amount").collect()),
        "hypothesis_suite": lambda: RP.hypothesis_suite(cl, "1-URGENT", "2-HIGH").collect(),
        "association_suite": lambda: RP.association_suite(cl).collect(),
        "linear_report": lambda: RP.linear_report(spark, RP.linear_diagnostics(cl)).collect(),
        "normality": lambda: RP.normality(cl).collect(),
        "period_kpis": lambda: PR.period_kpis(PR.period(cl, "1996-01-01", "1996-12-31")).collect(),
    }
    for name, fn in reports.items():
        timed(name, fn)

    chain = times["validate"] + times["clean"] + sum(times[k] for k in reports)
    out = {
        "metric": "full_chain_wall_time",
        "value": round(chain, 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows_read": n_lines,
        "rows_clean": n_clean,
        "validate_rows_per_sec": round(n_lines / times["validate"], 1) if times["validate"] else None,
        "chain_rows_per_sec": round(n_lines / chain, 1) if chain else None,
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
