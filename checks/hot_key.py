"""Best match when one phone number is everywhere: all pairs against reduced keys.

``python -m checks.hot_key [sf_dir]``. All transactions get one phone number and
no email; a third of the customers has that number.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.compare import local_session
from checks.queries import Feeds, output_folder
from rollcall.operators import all_matches, best_match

HOT = "+447900000000"


def pairwise(crm: DataFrame, trx: DataFrame) -> DataFrame:
    """Rank every pair a customer is part of."""
    order = Window.partitionBy("crm_customer_id").orderBy(
        F.desc("confidence_score"), "transaction_id"
    )
    ranked = all_matches(crm, trx).withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    feeds = Feeds(spark, sf_dir)
    shared = F.xxhash64("customer_id") % 3 == 0
    phone = F.when(shared, HOT).otherwise(F.col("normalized_phone"))
    scratch = output_folder(spark)
    crm = scratch.stage(feeds.crm.withColumn("normalized_phone", phone), "crm")
    everyone = {"normalized_phone": F.lit(HOT), "normalized_email": F.lit(None).cast("string")}
    trx = scratch.stage(feeds.trx.withColumns(everyone), "trx")
    for name, find in (("reduced", best_match), ("pairwise", pairwise)):
        for _ in range(2):
            start = time.perf_counter()
            find(crm, trx).write.format("noop").mode("overwrite").save()
            print(f"{name}: {time.perf_counter() - start:.2f} s", flush=True)
    scratch.remove()
    spark.stop()


if __name__ == "__main__":
    main()
