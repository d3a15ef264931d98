"""Summarise the physical plan of every registered query (markdown table).

    python scripts/plan_report.py [sf_dir] > PLANS.md

Per query: tables scanned with their read columns and pushed filters, the
number of shuffles, spreads (`session.spread` repartitions, only for
inputs with fewer splits than the parallelism, as the one-row-group test
files; none at scale), broadcasts, single-partition exchanges, Python evaluation nodes
and partial window limits. Plans are the optimizer's
initial physical plans (AQE may still coalesce partitions or switch a join
to broadcast at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from verso.plans.catalog import QUERIES  # noqa: E402

# Queries that fit a model, or write before they read: their plan is of the written table.
SKIP = {"train_and_evaluate", "train_with_year", "model_round_trip", "score_batch", "score_json", "score_stream", "score_stream_split", "score_conversations",
        "tune_classifier", "train_merged", "csv_round_trip", "csv_by_name", "job_counts"}


def scans(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan):
        cols, loc, pushed = m.groups()
        table = os.path.basename(loc).replace(".parquet", "")
        cols = ",".join(c.split("#")[0] for c in cols.split(",") if c)
        out.append(f"{table}({cols or '-'})" + (f" pushed: {pushed}" if pushed else ""))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | scans (columns read, pushed filters) | shuffles | spreads | broadcasts | single-partition | python | partial top-k |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)[^\n]*", plan)
        spreads = sum("REPARTITION_BY_NUM" in e for e in exchanges)
        shuffles = len(exchanges) - spreads
        bcast = plan.count("BroadcastExchange")
        single = plan.count("Exchange SinglePartition")
        python = "yes" if re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan) else "no"
        partial = "yes" if "WindowGroupLimit" in plan and "Partial" in plan else "-"
        print(f"| {name} | {'; '.join(scans(plan)) or 'checkpoint/derived'} | {shuffles} | {spreads} | {bcast} | {single} | {python} | {partial} |")
    spark.stop()


if __name__ == "__main__":
    main()
