"""Print a plan summary (exchanges, joins, pushed filters, read schemas) per query.

    python scripts/plans.py [sf_dir] [name ...]   # --full: formatted plans, --md: table rows
"""
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"^\(\d+\) Exchange", plan, re.M)),
        "bhj": len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)),
        "smj": len(re.findall(r"^\(\d+\) SortMergeJoin", plan, re.M)),
        "windows": len(re.findall(r"^\(\d+\) Window", plan, re.M)),
        "expand": len(re.findall(r"^\(\d+\) Expand", plan, re.M)),
        "cartesian": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[(.*)\]", plan)) - {""}),
    }


def main(argv):
    args = [a for a in argv[1:] if not a.startswith("--")]
    full = "--full" in argv
    md = "--md" in argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    from kestrel.queries import QUERIES
    from kestrel.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        if full:
            print(f"===== {name}\n{plan}")
        sm = summary(plan)
        if md:
            pushed = "; ".join(sm["pushed"]) or "–"
            print(f"| `{name}` | {sm['exchanges']} | {sm['bhj']} | {sm['smj']} | {sm['windows']} | "
                  f"{sm['expand']} | {sm['cartesian']} | {sm['python']} | {pushed} |")
        else:
            print(name, sm)


if __name__ == "__main__":
    main(sys.argv)
