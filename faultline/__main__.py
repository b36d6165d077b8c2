"""Run a registered query: ``python -m faultline <key> [table_folder] [rows]``.

Without a key, lists the registered keys.
"""

from __future__ import annotations

import sys

from .plans.registered import QUERIES
from .session import get_spark


def main(argv: list[str]) -> int:
    if len(argv) < 2 or argv[1] not in QUERIES:
        print("registered queries:\n  " + "\n  ".join(sorted(QUERIES)))
        return 0 if len(argv) < 2 else 2
    key = argv[1]
    folder = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    rows = int(argv[3]) if len(argv) > 3 else 20
    spark = get_spark("local[*]")
    QUERIES[key](spark, folder).show(rows, truncate=80)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
