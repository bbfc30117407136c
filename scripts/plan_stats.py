"""Shuffle / scan counts of the headline reports' executed plans.

    python scripts/plan_stats.py [sf_dir] [--no-broadcast]

``--no-broadcast`` disables broadcast joins, which is what the plans look
like once every input is too large to broadcast (the 100 TB case).
"""
import re
import sys

sys.path.insert(0, ".")
import bench  # noqa: E402
from visitflow.plans import registry  # noqa: E402
from visitflow.session import local_session  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    extra = None
    if "--no-broadcast" in sys.argv:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = local_session(8, shuffle_partitions=8, extra=extra)
    print("| query | shuffles | broadcasts | scans | partial aggregates / group limits |")
    print("| --- | ---: | ---: | ---: | ---: |")
    for key in bench.HEADLINE:
        df = registry.QUERIES[key](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", p))
        partial = p.count("partial_") + p.count("WindowGroupLimit") // 2
        print(f"| `{key}` | {shuffles} | {p.count('BroadcastExchange')} | {p.count('FileScan parquet')} | {partial} |")


if __name__ == "__main__":
    main()
