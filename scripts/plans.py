"""Write PLANS.md: the physical plan tree (``explain('formatted')``, tree part)
and the scan schemas of selected queries at one scale factor.

usage: python scripts/plans.py [sf_dir] [query ...]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabmine.plans.queries import QUERIES  # noqa: E402
from tabmine.session import local_session  # noqa: E402

DEFAULT = ["first_encounter", "deletion_audit", "nzv_all_columns", "value_distribution", "run_history",
           "stratified_split", "roc_curve", "feature_scores"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session()
    out = ["# Physical plans", "", f"`explain('formatted')` tree of selected queries on `{sf}` (before AQE re-planning;",
           "a pinned intermediate shows up as a Parquet scan of the checkpoint folder).", ""]
    for name in names:
        p = plan_text(QUERIES[name](spark, sf))
        tree = p.split("\n\n\n")[0].strip()
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*)", p)))
        out += [f"## {name}", "", QUERIES[name].__doc__.strip().split("\n")[0], "", "```", tree, "```", ""]
        if schemas:
            out += ["Scan schemas:", ""] + [f"- `{s}`" for s in schemas] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
