"""Write PLANS.md: the final adaptive physical plan of every registered query.

    python tools/plans.py [sf_dir]

Each query runs once (so AQE's final plan is shown); the operator tree is
printed without the per-node details.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultline.session import get_spark  # noqa: E402

from faultline.plans.registered import QUERIES  # noqa: E402

NOTES = """# PLANS

Final physical plans (after adaptive re-planning) of the registered queries on `{sf}`, `local[8]`,
`spark.sql.shuffle.partitions=8`, generated by `tools/plans.py`. Only the operator trees are kept.
What to look for: scans read only the needed columns (`ReadSchema`), dimension joins are
`BroadcastHashJoin` inside the scan stage, aggregates appear as partial + final `HashAggregate` around one
`Exchange hashpartitioning`, `Exchange SinglePartition` only carries one-row aggregates, top-n
(`TakeOrderedAndProject`), or the per-partition offset table of the distributed rank, and checkpointed
inputs show as `Scan ExistingRDD`. Scalar subqueries (global statistics) run as separate small jobs and are not shown.

What each family moves at 100 TB:

| queries | data-proportional work | shuffled | bounded (proof) |
| --- | --- | --- | --- |
| frequency, ratio, dominance, difficulty, shares, split | one scan of the fact's key columns | partial aggregates: one row per group per task (eager path: per foreign-key combination) | broadcast dimensions (exact count <= 2M rows), rank offsets (one per partition) |
| top-N, worklist, head | one scan of the grouping columns | partial counts | n rows per task (`TakeOrderedAndProject`), n ids to the driver (the report's limit) |
| word counts, top words, weights | one scan of the text | per-task vocabularies | top n |
| histogram, density | one scan of the text | one row per distinct value (checkpointed) | bins / 200 grid points per distinct value |
| key and reference checks | one scan per checked key | key columns (uniqueness needs them), distinct foreign keys | dimension counts |
| dimensions, encoding, ids | one scan of the member columns / the fact | distinct members; fact only when a dimension is too large to broadcast | per-partition offsets; file-order ids shuffle nothing |
| upsert, append, CSV | the tables written | merge by unique key (no skew possible) | — |

Counts below are taken from the main query's final plan (subqueries and the helper jobs of size checks and
checkpoints excluded). A single-partition exchange here only ever carries a one-row aggregate, a top-n, a
per-partition offset table or a rank input of proven small size.
"""


def _scan_details(text: str) -> dict[str, str]:
    """Node id -> 'table  ReadSchema  PushedFilters' for parquet scans."""
    out = {}
    for block in re.split(r"\n(?=\(\d+\) )", text):
        m = re.match(r"\((\d+)\) Scan parquet", block)
        if not m:
            continue
        loc = re.search(r"Location: \S+ \[file:[^\]]*/([^/\]]+)\.parquet\]", block)
        schema = re.search(r"ReadSchema: (struct<.*>)", block)
        pushed = re.search(r"PushedFilters: (\[.*\])", block)
        bits = [loc.group(1) if loc else "?", schema.group(1) if schema else ""]
        if pushed and pushed.group(1) != "[]":
            bits.append("pushed " + pushed.group(1))
        out[m.group(1)] = "  ".join(bits)
    return out


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    scans = _scan_details(text)
    keep = []
    for line in text.splitlines():
        if line.startswith("(") or line.startswith("+- == Initial Plan =="):
            break
        m = re.search(r"Scan parquet\s*\((\d+)\)$", line)
        if m and m.group(1) in scans:
            line = line[:m.start()] + "Scan parquet " + scans[m.group(1)]
        keep.append(re.sub(r" \(\d+\)(?=$|,)", "", line))
    return "\n".join(keep).strip()


def counts(plan: str) -> tuple[int, int, int, int, int, int]:
    final = plan.split("== Initial Plan ==")[0]
    own = "\n".join(line for line in final.splitlines() if "ReusedExchange" not in line)
    return (own.count("Exchange hashpartitioning"), own.count("Exchange rangepartitioning"),
            own.count("Exchange SinglePartition"), final.count("ReusedExchange"),
            own.count("BroadcastExchange"), final.count("Scan ExistingRDD"))


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", partitions=8)
    parts, table = [NOTES.format(sf=sf)], []
    for key, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        h, r, one, reused, b, ck = counts(buf.getvalue())
        table.append(f"| `{key}` | {h} | {r} | {one} | {reused} | {b} | {ck} |")
        parts.append(f"## {key}\n\n```\n{tree(df)}\n```\n")
    parts.insert(1, "| query | hash exchanges | range exchanges | single-partition exchanges | reused exchanges "
                    "| broadcasts | checkpoint scans |\n| --- | --- | --- | --- | --- | --- | --- |\n"
                    + "\n".join(table) + "\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
