"""Write PLANS.md: the physical plan shape of every registered query.

For each query, from ``explain("formatted")`` of the initial adaptive plan:
the exchanges (hash keys / single partition / broadcast), the columns read
(``ReadSchema``) and the filters pushed into the scan.  Run:

    python -m eventide.plans.report /root/testdata/sf0.1 PLANS.md
"""

from __future__ import annotations

import re
import sys

from eventide.plans.catalog import QUERIES
from eventide.plans.verify import plan_text
from eventide.session import get_session


def summarize(plan: str) -> dict:
    args = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]\nArguments: ([^\n]*)", plan)
    hashed, single = [], 0
    for _, a in args:
        if a.startswith("hashpartitioning("):
            keys = a[len("hashpartitioning("):].split(", ENSURE")[0]
            keys = re.sub(r"#\d+L?", "", keys).rsplit(",", 1)[0]
            hashed.append(keys)
        elif a.startswith("SinglePartition"):
            single += 1
    reads = sorted(set(re.sub(r"#\d+L?", "", r) for r in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    return {
        "hash_exchanges": hashed, "single_partition": single,
        "windows": plan.count(") Window"), "generates": plan.count(") Generate"),
        "python": plan.count("MapInArrow") + plan.count("ArrowEvalPython"),
        "reads": reads, "pushed": pushed,
    }


def main(sf_dir: str, out: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=8)
    lines = [
        "# PLANS",
        "",
        f"Physical plan shape of every registered query (`explain(\"formatted\")`, initial adaptive plan, "
        f"{sf_dir}). Generated by `python -m eventide.plans.report`. `(k, _bkt)` exchanges move raw rows hashed "
        "on key and order bucket (keys with more rows than the query's width are split); exchanges on the key "
        "alone or a single partition move bucket-summary or aggregated tables only. A second `(k, _bkt)` exchange "
        "is either the partially aggregated totals of split keys or the same raw-row exchange, which AQE reuses "
        "at run time (`ReusedExchange`); tests/test_plans.py counts them in executed plans. Predicates on the event type stay inside `count_if` "
        "(a window with no match still reports 0), so only `IsNotNull` filters reach those scans. Bounds and "
        "carries of split keys are broadcast; else AQE broadcasts only what it has measured under 64 MB.",
        "",
        "| query | hash exchanges (keys) | single-partition | windows | reads | pushed filters |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for name, q in QUERIES.items():
        s = summarize(plan_text(q(spark, sf_dir)))
        ex = "; ".join(f"({k})" for k in s["hash_exchanges"]) or "-"
        lines.append(f"| `{name}` | {ex} | {s['single_partition']} | {s['windows']} | "
                     f"{'<br>'.join('`' + r + '`' for r in s['reads'])} | "
                     f"{'<br>'.join(s['pushed']) or '-'} |")
    open(out, "w").write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1",
         sys.argv[2] if len(sys.argv) > 2 else "PLANS.md")
