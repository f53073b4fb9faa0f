"""Times the headline queries: `BENCH_SF_DIR`, `BENCH_CPUS` and `BENCH_RUNS` steer it; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metaloom.plans.queries import QUERIES  # noqa: E402
from metaloom.session import build_session  # noqa: E402

HEADLINE = [
    "links_per_host",
    "page_links_distinct",
    "page_text",
    "source_facts",
    "source_variables",
    "registry_todo",
    "registry_counts",
    "box_check",
    "keywords_fix",
    "encoding_fix",
    "normalised_docs",
    "response_datasets",
    "metadata_merge",
    "validate_docs",
    "validate_summary",
    "audit_docs",
    "contract_rules",
    "failure_summary",
    "sitemap_reconcile",
    "catalog_dangling",
    "catalog_walk",
    "crawl_levels",
    "redirect_final",
    "quad_terms",
    "quad_entities",
    "quad_union_diff",
    "doc_quads",
    "duplicate_docs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "metaloom-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small warm-up for the JVM and the Python workers, outside the timings.
    QUERIES["links_per_host"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
