"""Write QUERIES.md: every registered query, its module (survey section) and
whether it has a DuckDB oracle.

    python scripts/list_queries.py > QUERIES.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeshard.plans.registry import entries  # noqa: E402

SECTIONS = {
    "core": "2.A1 inverted index",
    "maintenance": "2.A2-A5, B19, B22-B25, J5 maintenance operators",
    "storage": "2.B scans, sources, sinks",
    "relational": "2.C projections, filters, predicates",
    "joins": "2.D joins",
    "aggregates": "2.E aggregations",
    "windows": "2.F windows",
    "ordering": "2.G sort, limit, distribution",
    "setops": "2.H set operations",
    "scalars": "2.I scalar syntax",
    "generators": "2.J generators and UDFs",
}


def main() -> None:
    rows = []
    for name, e in entries().items():
        mod = e.plan.__module__.rsplit(".", 1)[-1]
        sec = e.group if e.group in SECTIONS else mod
        doc = (e.plan.__doc__ or "").strip().splitlines()
        rows.append((list(SECTIONS).index(sec) if sec in SECTIONS else 99, sec, name,
                     "yes" if e.oracle else "rows only", doc[0] if doc else ""))
    print("# Registered queries\n")
    print("Generated by `scripts/list_queries.py` from `lakeshard.plans.registry`.\n")
    print(f"{len(rows)} queries, {sum(r[3] == 'yes' for r in rows)} with a DuckDB oracle.\n")
    cur = None
    for _, sec, name, orc, doc in sorted(rows):
        if sec != cur:
            print(f"\n## {SECTIONS.get(sec, sec)}\n\n| query | oracle | note |\n| --- | --- | --- |")
            cur = sec
        print(f"| `{name}` | {orc} | {doc} |")


if __name__ == "__main__":
    main()
