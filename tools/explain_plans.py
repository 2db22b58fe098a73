"""Write PLANS.md: the physical plan outline of every query of the registry.

For each query: the operator tree of ``explain("formatted")``, the scans'
``ReadSchema`` / ``PushedFilters``, and the exchanges (shuffles) in the plan.

Usage: python tools/explain_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def outline(df) -> tuple[str, list[str], list[str]]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n", 1)[0].replace("== Physical Plan ==\n", "")
    scans = sorted({m for m in re.findall(r"(ReadSchema: .*|PushedFilters: .*)", text)})
    exchanges = re.findall(r"\(\d+\) (Exchange|ShuffleExchange)[^\n]*\n[^\n]*\n(Arguments: [^\n]*)", text)
    ex = [a for _, a in exchanges]
    return tree, scans, ex


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    from strandline.session import get_spark

    # AQE off here only so that the static plan carries the codegen marks
    spark = get_spark("local[8]", 16, extra={"spark.sql.adaptive.enabled": "false"})
    from strandline.plans.registry import QUERIES

    parts = [
        "# Physical plans\n",
        f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8], 16 shuffle partitions; AQE",
        "off for display only, so that `*` marks the operators inside whole-stage codegen).",
        "Queries that write intermediate data (dump, streams) show the plan that reads it back.\n",
    ]
    for name, fn in QUERIES.items():
        tree, scans, ex = outline(fn(spark, sf_dir))
        parts.append(f"## {name}\n")
        parts.append("```\n" + tree.strip() + "\n```\n")
        if scans:
            parts.append("Scans: " + "; ".join(f"`{s}`" for s in scans) + "\n")
        parts.append(f"Exchanges: {len(ex)}" + ("".join(f"\n- `{a[:160]}`" for a in ex)) + "\n")
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main()
