"""Print the physical plans of the operators that matter at scale.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(sf_dir: str) -> None:
    from pyspark.sql import functions as F

    from tierload import fixtures as fx
    from tierload import registry as R
    from tierload.operators import key_violations, latest_per_key, upsert_overwrite
    from tierload.plans import silver_frames as sf
    from tierload.plans.crawl import crawl
    from tierload.plans.tables import SnapshotTable
    from tierload.session import build_session
    from tierload.sources.paths import dataset_summary, parse_keys

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    tag = R._run_tag(spark)

    def show(title, df):
        print(f"\n==== {title}")
        df.explain("formatted")

    root = fx.write_bronze_files(spark, sf_dir)
    db = f"plans_{tag}"
    spark.sql(f"CREATE DATABASE {db}")
    crawl(spark, root, "", db).collect()
    bronze = spark.table(f"{db}.events")
    state = ("2024-01-28", "20240128120000000_20240128125959999")
    show("merge source over the catalog Bronze table (partition pruning, pushdown, partial top-1)",
         sf.merge_source(bronze, R.EVENTS_DATASET, R.VALIDATION, state, fx.AS_OF))

    silver = SnapshotTable(spark, f"silver_plans_{tag}", key=fx.EVENTS_PK, buckets=8)
    silver.write(sf.initial_load(bronze.where(F.col("ingestion_date") <= fx.SPLIT_DATE),
                                 R.EVENTS_DATASET, R.VALIDATION, fx.AS_OF, fx.RUN_TS_1))
    show("MERGE into the bucketed Silver version (only the source is shuffled)",
         sf.merge_load(silver.read(), bronze, R.EVENTS_DATASET, R.VALIDATION, state, fx.AS_OF,
                       fx.RUN_TS_2))

    gold = SnapshotTable(spark, f"gold_plans_{tag}", key=fx.ORDERS_PK, buckets=8)
    gold.write(fx.gold_target(spark, sf_dir))
    show("Gold upsert into the bucketed table", upsert_overwrite(gold.read(), R._gold_source(spark, sf_dir),
                                                                  fx.ORDERS_PK))
    show("latest row per composite key", latest_per_key(fx.table(spark, sf_dir, "lineitem"),
                                                        fx.LINEITEM_PK, fx.LINEITEM_CURSOR,
                                                        fx.LINEITEM_TIE))
    show("key check", key_violations(fx.table(spark, sf_dir, "lineitem"), fx.LINEITEM_PK))
    show("dataset summary", dataset_summary(parse_keys(fx.bronze_paths(spark, sf_dir), "key")))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
