"""Write PLANS.md: the physical plan tree and the scan details of the
headline queries (``explain("formatted")``), for review.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.plans.queries import QUERIES  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

NAMES = ["silver_prices", "feature_mart", "gold_features", "target_summary"]


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    """Keep the operator tree and every scan's pushed filters / read schema."""
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    keep = []
    for block in details.split("\n\n"):
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan parquet" in head:
            keep.append("\n".join(line for line in block.strip().splitlines()
                                  if line.startswith(("(", "PushedFilters", "ReadSchema", "Location"))))
    subqueries = []
    if "===== Subqueries =====" in text:
        for block in text.split("===== Subqueries =====", 1)[1].split("\n\n"):
            lines = block.strip().splitlines()
            if lines and lines[0].startswith("Subquery:"):
                subqueries.append("\n".join(lines))
    out = tree.strip() + "\n\n" + "\n\n".join(keep)
    if subqueries:
        out += "\n\n===== Subqueries (trees) =====\n\n" + "\n\n".join(subqueries)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    parts = ["# Physical plans of the headline queries",
             "",
             f"Generated by `tools/dump_plans.py` on `{os.path.basename(sf_dir)}` (static plans before AQE "
             "re-optimisation; the SKU dimension and demand tables are written once per run and appear "
             "as Parquet scans of the shared folder).",
             ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        parts += [f"## {name}", "", "```", summarize(formatted(df)), "```", ""]
    spark.stop()
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main()
