"""Write docs/PLANS.md: the physical plan tree of every registered query of the load.

usage: python tools/plans.py [SF_DIR]   (default /root/testdata/sf0.1)
Plans are shown as planned before execution (AQE re-plans at run time:
it may coalesce partitions, switch a join to broadcast or split skew).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def digest(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for line in details.splitlines():
        if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema")):
            keep.append("    " + re.sub(r"#\d+L?", "", line))
        elif re.match(r"^\(\d+\) Scan", line):
            keep.append(line)
    tree = tree.replace("== Physical Plan ==\n", "")
    return tree.rstrip() + ("\n\n" + "\n".join(keep) if keep else "")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from seriesmart.session import build_session
    from seriesmart.registry import QUERIES
    spark = build_session("local[8]", 8)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plans.py` on `{sf}`. Plans as planned before execution;",
           "AQE may still coalesce partitions, switch a join to broadcast or split a skewed",
           "partition at run time. Round-trip queries show the read-back of the files they wrote.", ""]
    for name, fn in sorted(QUERIES.items()):
        out += [f"## {name}", "", "```", digest(fn(spark, sf)), "```", ""]
    # the load itself: raw text -> wide table (AQE off to show the codegen stages)
    from seriesmart.plans import DatasetPaths, read_inputs, wide_table
    from seriesmart.registry import ORDERS_SURVEY, survey_files
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    src = survey_files(spark, sf)
    f, s, d = read_inputs(spark, ORDERS_SURVEY, DatasetPaths.in_folder(src, ORDERS_SURVEY))
    wide = wide_table(f, s, d, ORDERS_SURVEY).hint("rebalance", "year")
    out += ["## load plan: raw text -> wide table (survey_load_end_to_end, AQE off)", "",
            "`*` marks operators inside whole-stage code generation. The write adds one more",
            "exchange on top, `hashpartitioning(year) REBALANCE_PARTITIONS_BY_COL`, which only",
            "exists with AQE on (AQE then splits big years and merges small ones).", "",
            "```", digest(wide), "```", ""]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
