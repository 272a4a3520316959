"""Print the formatted physical plan of registered queries and a one-line
summary of pushed filters and read schemas.

    python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from reclab.plans.registry import load_all
    from reclab.session import build_session

    spark = build_session("local[8]", 8)
    queries, _ = load_all()
    for name in names or ["scan_interactions", "metric_map", "ordered_label_list"]:
        df = queries[name](spark, sf)
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        print(f"==== {name}")
        print(text)
        pushed = sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", text)))
        schemas = sorted(set(re.findall(r"ReadSchema: [^\n]*", text)))
        print(f"---- {name}: pushed={pushed} read={schemas}")

if __name__ == "__main__":
    main()
