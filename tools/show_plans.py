"""Print the formatted physical plan of registered queries (review aid).

Usage: python tools/show_plans.py [--sf DIR] [--run] name [name ...]
With --run the query is executed first, so the adaptive plan shown is final.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--run", action="store_true")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    from campaignlake.plans import catalog
    from campaignlake.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in args.names:
        df = catalog.QUERIES[name](spark, args.sf)
        if args.run:
            df.write.format("noop").mode("overwrite").save()
        print(f"===== {name} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
