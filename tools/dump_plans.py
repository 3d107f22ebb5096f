"""Execute headline queries and save their FINAL adaptive physical plans.

    python tools/dump_plans.py [sf_dir] [out_dir]

Each query is collected first, so ``explain`` shows the plan AQE actually ran
(isFinalPlan=true: broadcast conversions, coalesced partitions, reused
exchanges), followed by the initial plan.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.abspath(os.path.join(os.path.dirname(__file__), "..")))

from tarmac.catalog import all_queries  # noqa: E402
from tarmac.session import build_session  # noqa: E402

HEADLINE = ["daily_airport_mart"]


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    out_dir = argv[1] if len(argv) > 1 else os.path.join(os.path.dirname(__file__), "..", "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = build_session(master="local[8]", app_name="dump-plans", shuffle_partitions=16)
    queries = all_queries()
    for name in HEADLINE:
        df = queries[name](spark, sf_dir)
        df.collect()
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(f"# {name} on {sf_dir}, local[8], after execution\n\n{text}")
        final = text.split("== Initial Plan ==")[0]
        print(
            f"{name}: exchanges={final.count('Exchange (')} reused={final.count('ReusedExchange (')} "
            f"broadcast_joins={final.count('BroadcastHashJoin ')} smj={final.count('SortMergeJoin ')}"
        )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
