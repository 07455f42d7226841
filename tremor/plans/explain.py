"""Plan audit: run each query and summarise its final (adaptive) physical plan.

``python -m tremor.plans.explain [sf_dir] [--md PATH] [name ...]`` counts, per
query, the file scans, shuffle exchanges, broadcast exchanges, sort-merge and
nested-loop joins, Python UDF evaluations, subqueries and reused exchanges /
subqueries, so plan regressions (an extra shuffle, a cross join, a lost
broadcast) are visible at a glance.
"""

from __future__ import annotations

import re
import sys

# What is counted: a pattern of the node's name (joined with its description).
PATTERNS = {
    "scans": r"^(FileSourceScan|BatchScan|InMemoryTableScan)",
    "shuffles": r"^ShuffleExchange",
    "broadcasts": r"^BroadcastExchange",
    "smj": r"^(SortMergeJoin|ShuffledHashJoin)",
    "bhj": r"^BroadcastHashJoin",
    "nested_loop": r"^(BroadcastNestedLoopJoin|CartesianProduct)",
    "python": r"Python|InPandas|InArrow",
    "subqueries": r"^Subquery",
    "reused": r"^Reused",
}


def nodes(plan) -> list[str]:
    """Class names of an executed plan's nodes: through adaptive plans and query
    stages to what ran, subquery plans included, reused parts as one node."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return nodes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return nodes(plan.plan())
    out = [name.removesuffix("Exec")]
    if name.startswith("Reused"):
        return out
    below = [plan.children(), plan.subqueries()]
    if name == "SubqueryExec":
        below = below[:1]
    for seq in below:
        for k in range(seq.size()):
            out += nodes(seq.apply(k))
    return out


def executed_nodes(df) -> list[str]:
    """Run ``df`` and list the nodes of the plan that ran."""
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and not plan.isFinalPlan():
        raise RuntimeError("the plan did not run")
    return nodes(plan)


def summarize(names: list[str]) -> dict:
    return {k: sum(bool(re.search(p, n)) for n in names) for k, p in PATTERNS.items()}


def nearest_parts(spark, sf_dir: str) -> dict:
    """The frames inside a nearest search, which the search itself runs as it is built."""
    from tremor.operators import cells, geo
    from tremor.plans import catalog
    from tremor.sources import fixture
    from pyspark.sql import functions as F

    ev = catalog.quakes(spark, sf_dir)
    points = fixture.points(spark, sf_dir).select(
        "point_id", F.col("latitude").alias("_plat"), F.col("longitude").alias("_plon")
    )
    index = cells.build_index(ev, "Latitude", "Longitude")
    cand = cells.candidates(points, index, 1.0)
    return {
        "nearest: candidates": cells.open_cells(points, index, 1.0),
        "nearest: pairs": geo.candidate_pairs(cand, ev, index, ["ID", "Latitude", "Longitude"], "ID", "Latitude", "Longitude"),
    }


def main(argv) -> int:
    from tremor.plans.catalog import QUERIES
    from tremor.session import build_session

    md = None
    if "--md" in argv:
        i = argv.index("--md")
        md = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    rows = []
    frames = {name: QUERIES[name](spark, sf_dir) for name in names}
    if len(argv) <= 2:
        frames |= nearest_parts(spark, sf_dir)
    for name, frame in frames.items():
        s = summarize(executed_nodes(frame))
        rows.append((name, s))
        print(name, s, flush=True)
    if md:
        cols = list(PATTERNS)
        with open(md, "w") as f:
            f.write("# Plan audit\n\n")
            f.write(
                f"Physical plans as they ran (adaptive plans after their last change) at `{sf_dir}` on "
                "`local[8]`, generated by `python -m tremor.plans.explain`.  Counts are of plan nodes, "
                "subquery plans included and reused parts counted once as reused.  The nearest-search, "
                "label and model queries run jobs while they are built; their rows show the last plan, "
                "and the rows `nearest: ...` the frames inside a nearest search.\n\n"
            )
            f.write("| query | " + " | ".join(cols) + " |\n")
            f.write("| --- | " + " | ".join("---" for _ in cols) + " |\n")
            for name, s in rows:
                f.write(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |\n")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
