"""Write PLANS.md: the physical plan shape of every registered query (AQE off, so the static plan shows;
at scale AQE may still turn a small side into a broadcast or split a skewed partition at runtime)."""

from __future__ import annotations

import re
import sys


def main(sf_dir: str, out: str) -> None:
    sys.path.insert(0, "/root/repo")
    from rawmart.queries import QUERIES
    from rawmart.session import build_session

    spark = build_session("local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    lines = [
        "# PLANS",
        "",
        f"Static physical plans of the registered queries on `{sf_dir}` (AQE off; `tools_plans.py` regenerates this).",
        "Exchanges = shuffles; `WGL partial` = `WindowGroupLimit` before the shuffle (at most one row per key per task);",
        "`BHJ` = broadcast hash join (static choice: the side's size estimate is under `autoBroadcastJoinThreshold`),",
        "`SMJ` = sort-merge join. Write-side queries (`full_run`, `stream_merge`, ...) run several jobs and are not listed.",
        "Each driver table here is one file with one row group, so its scan is spread round-robin over the cores",
        "(`driver_tables.table`): that is one exchange per table read; an input of many files has none.",
        "",
        "| query | exchanges | joins | WGL partial | codegen stages | scan columns |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    skip = {"full_run", "stream_merge", "stream_merge_hourly", "stream_mart", "dead_letter_sink", "raw_roundtrip", "drift_read"}
    skip |= {"landing_dispositions", "upsert_existing", "bi_mart_read", "raw_append_runs"} | {q for q in QUERIES if q.startswith("run_") and q != "run_metrics"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan))
        joins = []
        for kind, short in (("BroadcastHashJoin", "BHJ"), ("SortMergeJoin", "SMJ"), ("ShuffledHashJoin", "SHJ"),
                            ("BroadcastNestedLoopJoin", "BNLJ"), ("CartesianProduct", "CP")):
            n = plan.count(kind)
            if n:
                joins.append(f"{short}×{n}")
        partial = len(re.findall(r"WindowGroupLimit \[.*?Partial", plan))
        stages = len(set(re.findall(r"\*\((\d+)\)", plan)))
        schemas = sorted(set(re.findall(r"ReadSchema: struct<([^>\n]*)>", plan)))
        cols = "; ".join(",".join(c.split(":")[0] for c in s.split(",")) for s in schemas)
        lines.append(f"| `{name}` | {exchanges} | {' '.join(joins) or '-'} | {partial} | {stages} | {cols} |")
    open(out, "w").write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1", sys.argv[2] if len(sys.argv) > 2 else "PLANS.md")
