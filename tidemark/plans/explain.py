"""Physical-plan summary of every registered query.

    python -m tidemark.plans.explain [/root/testdata/sf0.1] > PLANS.md

For each query: the operator tree of ``explain("formatted")`` (before
adaptive re-planning; the final shapes of small sides may become broadcasts
at run time) and the scans' read schemas and pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    tree, details = [], []
    in_tree = True
    for line in text.splitlines():
        if line.startswith("(") and in_tree:
            in_tree = False
        if in_tree:
            if line.strip() and not line.startswith("=="):
                tree.append(line)
        elif re.match(r"^(ReadSchema|PushedFilters|Join type|Join condition):", line):
            details.append(line)
    seen, uniq = set(), []
    for d in details:
        if d not in seen:
            seen.add(d)
            uniq.append(d)
    return "\n".join(tree + [""] + uniq)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidemark.plans.queries import QUERIES
    from tidemark.session import get_session
    spark = get_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    print(f"# Physical plans ({sf}, before adaptive re-planning)\n")
    for name, q in QUERIES.items():
        print(f"## {name}\n\n```\n{summarize(plan_text(q(spark, sf)))}\n```\n")


if __name__ == "__main__":
    main()
