"""Headline queries, timed.  Prints one JSON line.

The plans' input tables are first written as Parquet, in as many files as there are cores; that
step is reported but not part of the total.  Then every query runs into the noop sink."""

from __future__ import annotations

import json
import os
import time
import uuid

from checks.catalog import all_checks
from checks.registry import Check, open_tables
from checks.standins import BASE, STANDINS, needed_by
from contactloom.session import build_session
from contactloom.sources.tables import Tables, load

HEADLINE = ["event_mail_funnel", "clip_order_spans", "interval_join", "global_rank", "earliest_cause_and_clamp",
            "suppression_waterfall", "trailing_units", "activity_sequence", "repeat_flags", "count_distinct_when",
            "first_per_key", "bounce_summary", "unpivot_without_nulls", "affiliation", "non_promotional_metrics",
            "professional_ranking", "professional_suppression", "patient_suppression", "marketing_activity",
            "combined_activity", "email_engagement_funnel", "interactions", "customer_universe"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "").split()
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false", "spark.log.level": "ERROR"})
    checks: dict[str, Check] = {n: c for n, c in all_checks().items() if n in (only or HEADLINE)}

    start = time.perf_counter()
    out, source = f"{spark.conf.get('spark.sql.warehouse.dir')}/bench-{uuid.uuid4().hex}", open_tables(spark, folder)
    for name in {n for c in checks.values() for n in needed_by(c.sql or "", STANDINS)}:
        source[name].repartition(int(cpus)).write.parquet(f"{out}/{name}.parquet")
    prepared = time.perf_counter() - start

    seconds, failed = {}, {}
    for name, check in checks.items():
        tables = Tables(lambda n: load(spark, n, folder if n in BASE else out))
        start = time.perf_counter()
        try:
            check.present(check.build(tables)).write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - the other times are still worth telling
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus), "prepare_sec": round(prepared, 3), "failed": failed}))


if __name__ == "__main__":
    main()
