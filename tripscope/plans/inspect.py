"""Plan inspection for tests and tuning: the formatted physical plan as
text, and the scan nodes in it."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def scan_nodes(plan: str) -> list[str]:
    """The text of each ``Scan parquet`` node of a formatted plan."""
    blocks, cur = [], None
    for line in plan.splitlines():
        if line.startswith("(") and "Scan parquet" in line:
            cur = [line]
            blocks.append(cur)
        elif cur is not None:
            if line.startswith("("):
                cur = None
            else:
                cur.append(line)
    return ["\n".join(b) for b in blocks]
