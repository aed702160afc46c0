"""Print the formatted physical plan of registered queries.

    python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyframe.plans.registry import QUERIES  # noqa: E402
from skyframe.session import get_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    for name in args:
        print(f"==== {name}")
        QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
