"""Benchmark the named analyses on the supplied tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5; one warm-up run first).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}:
``queries`` on the typed staging, ``text_queries`` the same analyses straight
from the raw text, and the one-off staging, alone and added to the sum.
"""

from __future__ import annotations

import io
import json
import os
import re
import statistics
import sys
import time
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.__main__ import ANALYSES  # noqa: E402
from ledgerlens.plans import mirrors  # noqa: E402
from ledgerlens.plans.registry import QUERIES  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources import parse_blocks, parse_contracts, parse_registry, parse_transactions  # noqa: E402

# Headline set: the fourteen named analyses (Q13 and Q14 as their series).
HEADLINE = [
    "monthly_transaction_count",
    "monthly_total_value",
    "monthly_average_value",
    "top_contracts_by_value",
    "top_miners_by_block_size",
    "monthly_average_gas_price",
    "monthly_contract_gas",
    "average_contract_gas",
    "gas_of_top_contracts",
    "block_column_overhead",
    "most_lucrative_scam",
    "scam_value_by_category_month",
    "chronological_series",
    "scam_series_pivot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="ledgerlens-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": "16g"},
    )
    # One-off: Spark derives the ledger text from the tables, then the typed,
    # validated Parquet from the text (free when already staged).
    t0 = time.perf_counter()
    for kind in ("transactions", "contracts", "blocks", "registry"):
        mirrors.staged_table(spark, sf_dir, kind)
    staging = round(time.perf_counter() - t0, 4)

    def median_of(q, times: int) -> tuple[float, int]:
        n = len(q().collect())  # warm-up
        samples = []
        for _ in range(times):
            t0 = time.perf_counter()
            q().collect()
            samples.append(time.perf_counter() - t0)
        return round(statistics.median(samples), 4), n

    parsers = {"transactions": parse_transactions, "contracts": parse_contracts, "blocks": parse_blocks, "registry": parse_registry}

    def from_text(name: str):
        """The analysis on the raw text, parsed anew."""
        inputs, analysis = ANALYSES[name]
        return analysis(*[parsers[i](mirrors.staged_lines(spark, sf_dir, i)) for i in inputs])

    def plan_nodes(name: str) -> dict[str, int]:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain(mode="formatted")
        tree = buf.getvalue().split("\n\n")[0]
        return {
            "scans": tree.count("Scan "),
            "shuffles": sum(1 for line in tree.splitlines() if line.strip(" +-:|").startswith("Exchange")),
            "broadcasts": tree.count("BroadcastExchange"),
        }

    timings: dict[str, float] = {}
    text: dict[str, float] = {}
    rows: dict[str, int] = {}
    nodes: dict[str, dict[str, int]] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        try:
            timings[name], rows[name] = median_of(lambda name=name: QUERIES[name](spark, sf_dir), runs)
            text[name], _ = median_of(lambda name=name: from_text(name), max(1, runs // 2))
            nodes[name] = plan_nodes(name)
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "plan_nodes": nodes,
                "staging_sec": staging,
                "total_with_staging_sec": round(staging + sum(timings.values()), 4),
                "text_queries": text,
                "text_sum_sec": round(sum(text.values()), 4),
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
                "errors": errors,
            }
        )
    )
    spark.stop()
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
