"""Print the physical plan tree of registered queries (explain "formatted",
tree part only, before execution).

    python tools/plans.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripscope import registry  # noqa: E402
from tripscope.plans.inspect import plan_text  # noqa: E402
from tripscope.session import build_session  # noqa: E402


def tree(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if line.startswith("(") or (out and not line.strip()):
            break
        out.append(line)
    return "\n".join(out).strip()


def scans(plan: str) -> list[str]:
    keep = ("PartitionFilters:", "PushedFilters:", "ReadSchema:")
    return [ln.strip() for ln in plan.splitlines() if ln.strip().startswith(keep)]


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(registry.queries())
    spark = build_session("plans", master="local[4]", shuffle_partitions=8)
    qs = registry.queries()
    for key in keys:
        plan = plan_text(qs[key](spark, sf_dir))
        print(f"### {key}\n```\n{tree(plan)}\n```")
        for ln in scans(plan)[:3]:
            print(f"    {ln[:160]}")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
