"""Run a named analysis on raw ledger dumps and write its result.

    spark-submit --py-files ledgerlens.zip ledgerlens/__main__.py top_contracts_by_value \\
        --transactions s3a://b/ledger/transactions.csv --contracts s3a://b/ledger/contracts.csv \\
        --out s3a://b/results --run-id run_01

Each analysis names the dumps it needs; results are written by the executors
(JSON lines by default) under ``<out>/<run-id>/<analysis>``.

``stage`` parses the given dumps once into typed Parquet under ``<out>/<dump>``;
later runs with ``--typed`` read those folders and prune columns:

    python -m ledgerlens stage --transactions .../transactions.csv --out s3a://b/staged [--overwrite]
    python -m ledgerlens monthly_total_value --typed --transactions s3a://b/staged/transactions --out ...
"""

from __future__ import annotations

import argparse
import sys
from functools import partial

from ledgerlens.plans import analyses as A
from ledgerlens.session import build_session
from ledgerlens.sinks import publish, run_folder, write_result
from ledgerlens.sources import typed as T
from ledgerlens.sources import (
    read_blocks,
    read_contracts,
    read_popular_contracts,
    read_registry,
    read_transactions,
)

def _exact(analysis):
    """Totals as decimal text, which holds them whatever their size."""
    return partial(analysis, text=True)


# analysis -> (inputs, function of the parsed inputs)
ANALYSES = {
    "monthly_transaction_count": (("transactions",), A.monthly_transaction_count),
    "monthly_total_value": (("transactions",), _exact(A.monthly_total_value)),
    "monthly_average_value": (("transactions",), A.monthly_average_value),
    "monthly_value_stats": (("transactions",), _exact(A.monthly_value_stats)),
    "top_contracts_by_value": (("transactions", "contracts"), _exact(A.top_contracts_by_value)),
    "top_miners_by_block_size": (("blocks",), A.top_miners_by_block_size),
    "monthly_average_gas_price": (("transactions",), A.monthly_average_gas_price),
    "monthly_contract_gas": (("transactions", "contracts"), A.monthly_contract_gas),
    "average_contract_gas": (("transactions", "contracts"), A.average_contract_gas),
    "gas_of_top_contracts": (("transactions", "contracts"), A.gas_of_top_contracts_by_value),
    "gas_of_popular_contracts": (
        ("transactions", "popular"), A.gas_of_top_contracts
    ),
    "block_column_overhead": (("blocks",), A.block_column_overhead),
    "most_lucrative_scam": (("transactions", "registry"), _exact(A.most_lucrative_scam)),
    "scam_value_by_category_month": (("transactions", "registry"), _exact(A.scam_value_by_category_month)),
    "chronological_series": (
        ("transactions",), lambda tx: A.chronological_series(A.monthly_transaction_count(tx))
    ),
    "scam_series_pivot": (
        ("transactions", "registry"),
        _exact(A.scam_series_pivot),
    ),
}

TYPED = {
    "transactions": lambda spark, path: T.typed_transactions(read_transactions(spark, path)),
    "contracts": lambda spark, path: T.typed_contracts(read_contracts(spark, path)),
    "blocks": lambda spark, path: T.typed_blocks(read_blocks(spark, path)),
    "registry": lambda spark, path: T.typed_registry(read_registry(spark, path)),
}

READERS = {
    "transactions": read_transactions,
    "contracts": read_contracts,
    "blocks": read_blocks,
    "registry": read_registry,
    "popular": read_popular_contracts,
}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlens", description=__doc__.splitlines()[0])
    ap.add_argument("analysis", choices=sorted(ANALYSES) + ["stage"])
    for name in READERS:
        ap.add_argument(f"--{name}", help=f"path of the {name} dump")
    ap.add_argument("--out", required=True, help="result folder (any Hadoop path)")
    ap.add_argument("--run-id", default=None, help="run folder name (default: from the clock)")
    ap.add_argument("--format", default="json", choices=["json", "parquet", "csv"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--cluster", action="store_true", help="large-cluster sizing (see session.py)")
    ap.add_argument("--overwrite", action="store_true", help="let `stage` replace folders that exist")
    ap.add_argument("--typed", action="store_true", help="inputs are folders written by `stage`")
    args = ap.parse_args(argv)

    if args.analysis == "stage":
        given = [i for i in TYPED if getattr(args, i)]
        if not given:
            ap.error("stage needs at least one of --" + " --".join(TYPED))
        spark = build_session(args.master, app_name="ledgerlens-stage", cluster=args.cluster)
        for name in given:
            path = f"{args.out.rstrip('/')}/{name}"
            staged = TYPED[name](spark, getattr(args, name))
            publish(spark, staged, path, "parquet", existing="overwrite" if args.overwrite else "error")
            print(path)
        return 0

    inputs, fn = ANALYSES[args.analysis]
    missing = [i for i in inputs if not getattr(args, i)]
    if missing:
        ap.error(f"{args.analysis} needs --{' --'.join(missing)}")
    spark = build_session(args.master, app_name=f"ledgerlens-{args.analysis}", cluster=args.cluster)
    if args.typed:
        frames = [spark.read.parquet(getattr(args, i)) if i in TYPED else READERS[i](spark, getattr(args, i))
                  for i in inputs]
    else:
        frames = [READERS[i](spark, getattr(args, i)) for i in inputs]
    path = write_result(fn(*frames), args.out, args.analysis, args.run_id or run_folder(), args.format)
    print(path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
