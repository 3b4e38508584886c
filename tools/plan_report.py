"""Run every registered query once and tabulate the shape of its final (adaptive) plan.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def shape(plan: str) -> dict:
    # An adaptive plan prints its final plan, then the initial one: keep the final part.
    plan = plan.split("== Initial Plan ==")[0]
    pushed = sorted({f for grp in re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
                     for f in re.findall(r"(GreaterThanOrEqual|LessThan|EqualTo|In)\((\w+)", grp)
                     for f in [f"{f[0]}({f[1]})"]})
    return {
        # A reused exchange repeats the text of the one it reads: count it once.
        "shuffles": sum(1 for line in plan.splitlines() if "ReusedExchange" not in line and
                        re.search(r"\bExchange (hashpartitioning|SinglePartition|"
                                  r"rangepartitioning|RoundRobin)", line)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "topk": "TakeOrderedAndProject" in plan,
        "window": "Window " in plan or "Window [" in plan,
        "cartesian": "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan,
        "pushed": ", ".join(pushed),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from shopgauge.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from shopgauge.plans import queries as shop_queries
    print(f"# Final plan shapes ({sf}, local[8], AQE on)\n")
    print("Counts are read from the final adaptive plan after one run. `shuffles` counts "
          "hash/range/single-partition exchanges (broadcasts apart); AQE picks broadcast only for "
          "sides it measured under the threshold, so at scale more joins stay sort-merge.\n")
    print("`static` is the shuffle count of the plan built with broadcast joins disabled and AQE "
          "off, i.e. the shape when every side is large: it counts the exchanges the operators "
          "themselves need (each aggregation and each join of raw tables); member-keyed join "
          "chains add none.\n")
    print("| query | shuffles | static | broadcasts | SMJ | BHJ | top-k | window | cartesian | "
          "pushed time/eq filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in shop_queries().items():
        df = fn(spark, sf)
        df.collect()
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        static_df = fn(spark, sf)
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # the entry point turns it on
        static = shape(static_df._jdf.queryExecution().executedPlan().toString())
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        print(f"| {name} | {s['shuffles']} | {static['shuffles']} | {s['broadcasts']} | "
              f"{s['smj']} | {s['bhj']} | "
              f"{'yes' if s['topk'] else ''} | {'yes' if s['window'] else ''} | "
              f"{'YES' if s['cartesian'] else ''} | {s['pushed']} |", flush=True)
    print("\n## user_tags, static plan when every side is large\n")
    print("Every exchange belongs to an aggregation or to a join of raw tables; the member-keyed "
          "left joins of the wide table meet sides already hash-partitioned on the member key.\n")
    print("```")
    for line in skeleton(spark, shop_queries()["user_tags"], sf):
        print(line)
    print("```")


def skeleton(spark, fn, sf: str) -> list[str]:
    """Exchange / join / aggregate / scan lines of the static (no broadcast, no AQE) plan."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = fn(spark, sf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    keep = ("Exchange", "Join", "Aggregate", "FileScan", "Union", "Window", "Expand")
    out = []
    for line in text.splitlines():
        if any(k in line for k in keep):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"(FileScan parquet \[[^\]]*\]).*?Location: [^\[]*\[file:[^\]]*/([^/\]]+)\].*",
                          r"\1 \2", line)
            out.append(line[:150])
    return out


if __name__ == "__main__":
    main()
