"""Write the physical plan tree of every registered query to docs/PLANS.md.

Usage: python tools/print_plans.py [sf_dir]   (default /root/testdata/sf0.1)
The plans are the ones Spark picks before execution (AQE may still coalesce
partitions or switch a join to broadcast from measured sizes at run time).
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.plans.registry import QUERIES  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", app_name="ledgerlens-plans", shuffle_partitions=8)
    out = ["# Physical plans", "", f"Generated by `tools/print_plans.py` on `{os.path.basename(sf_dir)}`.",
           "Initial plans (AQE re-plans at run time from measured sizes).", ""]
    for name, q in QUERIES.items():
        buf = io.StringIO()
        with redirect_stdout(buf):
            q(spark, sf_dir).explain(mode="formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
        pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", text)))
        out += [f"## {name}", "", "```", tree.rstrip(), "```", ""]
        out += [f"- ReadSchema: `{s}`" for s in schemas] + [f"- PushedFilters: `{p}`" for p in pushed] + [""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
