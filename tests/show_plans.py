"""Write PLANS.md: executed (final adaptive) physical plans of the headline jobs.

usage: python tests/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOBS = ["gold_feature_store", "cleaning_funnel_features", "monthly_rate", "monthly_auc", "psi_report",
        "stratified_split", "factorize_codes"]


def plan_text(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summary(text: str) -> str:
    tree = text.split("\n\n")[0]
    keep = [ln for ln in text.splitlines()
            if re.match(r"^(ReadSchema|PushedFilters|PartitionFilters|Location)", ln.strip())]
    return tree + "\n" + "\n".join(sorted(set(keep)))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from __spark_entry__ import queries
    from churnlake.operators import stores
    from churnlake.plans.datasets import Datamart
    from churnlake.session import local_session, shared_path
    from churnlake.sources import feeds

    spark = local_session(8, 16)
    out = ["# Physical plans", "",
           f"Executed plans (final adaptive plans) at `{os.path.basename(sf_dir)}`, `local[8]`, 16 shuffle partitions.",
           "Generated by `python tests/show_plans.py`.", ""]
    qs = queries()
    for name in JOBS:
        df = qs[name](spark, sf_dir)
        df.collect()
        out += [f"## {name}", "", "```", summary(plan_text(df)), "```", ""]
    # partition pruning on a written, Snapshot_Date-partitioned store
    dm = Datamart(spark, sf_dir)
    root = shared_path(spark, "plans_store")
    feeds.write_partitioned(dm.gold_features, f"{root}/feature_store")
    feeds.write_partitioned(dm.gold_labels, f"{root}/label_store")
    mset = stores.modelling_set(feeds.read_store(spark, f"{root}/label_store"),
                                feeds.read_store(spark, f"{root}/feature_store"), "1998-08-01")
    mset.collect()
    out += ["## modelling_set over written stores (partition pruning)", "", "```", summary(plan_text(mset)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
