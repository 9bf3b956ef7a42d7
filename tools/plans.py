"""Print the physical plan tree (the top of ``explain('formatted')``) of some
registered keys, plus the scan details that show pushdown and pruning.

    python tools/plans.py [sf_dir] key ...
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.plans import registered as R  # noqa: E402
from starmart.session import local_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark = local_session()
    for k in keys:
        text = formatted(R.QUERIES[k](spark, sf_dir))
        tree = text.split("\n\n\n")[0]
        scans = re.findall(r"^\(\d+\) Scan parquet.*?(?=^\(\d+\))", text, re.S | re.M)
        print(f"### `{k}`\n\n```\n{tree.strip()}\n```")
        details = []
        for s in scans:
            keep = [ln for ln in s.splitlines()
                    if ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema", "Location"))]
            details.append("\n".join(keep))
        if details:
            print("\n```\n" + "\n\n".join(details) + "\n```")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
