"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from spendlake.queries import registry
from spendlake.session import build_session

HEADLINE = (
    "report_ad_day",
    "report_adset_day",
    "report_campaign_day",
    "report_ad_market_day",
    "report_ad_age_gender_day",
    "rollup_ad_to_campaign",
    "reconcile_levels",
    "collapse_breakdown",
    "independent_breakdowns",
    "scan_ads",
    "scan_report_ad",
    "unpack_batches",
    "account_local_day",
    "run_status",
    "run_outcomes",
    "fact_with_dim",
    "never_seen_entities",
    "action_value",
    "dedupe_source",
    "upsert_facts",
    "upsert_dims",
    "run_facts",
    "stream_daily",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry()
    # The first job of a session pays for starting up; that is not the query's time.
    known["report_ad_day"].run(spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in only:
        begin = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
