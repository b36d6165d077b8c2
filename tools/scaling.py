"""Scaling and skew check (not part of the bench).

    python tools/scaling.py [sf_dir]

Derives from ``lineitem`` (with Spark, under the session's shared folder) a
10x copy in 40 files and a skewed variant where a third of the rows share
one supplier key, then times operators on all three (median of three).
"""

import os
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultline.operators import analysis as A  # noqa: E402
from faultline.plans import registered as R  # noqa: E402
from faultline.session import get_spark, scratch_path  # noqa: E402

spark = get_spark("local[8]", partitions=8, extra={"spark.driver.memory": "16g"})
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
out = scratch_path(spark, "scaling")
li = spark.read.parquet(f"{sf}/lineitem.parquet")
x10 = reduce(DataFrame.unionAll, [li.withColumn("l_orderkey", F.col("l_orderkey") + i * 10**7) for i in range(10)])
x10.repartition(40).write.parquet(f"{out}/big")
skew = spark.read.parquet(f"{out}/big").withColumn(
    "l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_suppkey")))
skew.write.parquet(f"{out}/skew")

def run(name, fn, fact):
    fn(fact).write.format("noop").mode("overwrite").save()
    ts = []
    for _ in range(3):
        t = time.time(); fn(fact).write.format("noop").mode("overwrite").save(); ts.append(time.time() - t)
    return sorted(ts)[1]

ops = {
    "frequency_by_keys": lambda f: A.frequency_by_keys(f, ["p_type", "n_name", "r_name"], dims=R.snowflake_dims(spark, sf)),
    "frequency_eager": lambda f: A.frequency_by_keys(f, ["p_type", "n_name", "r_name"], dims=R.snowflake_dims(spark, sf), broadcast_max_rows=0),
    "difficulty_rank": lambda f: A.difficulty_rank(f, "p_brand", "l_suppkey", "r_name", {"ASIA": "a", "EUROPE": "e"},
                                                   dims=R.snowflake_dims(spark, sf, part_cols=("p_brand",), geo_cols=("r_name",))),
    "dominant_member": lambda f: A.dominant_member(f, "l_suppkey", "l_returnflag", 25),
    "share_within_group": lambda f: A.share_within_group(f, "l_suppkey", "l_linestatus"),
    "unique_violations": lambda f: A.value_counts(f, ["l_orderkey", "l_linenumber"]).filter("count > 1"),
}
base = spark.read.parquet(f"{sf}/lineitem.parquet")
big = spark.read.parquet(f"{out}/big")
sk = spark.read.parquet(f"{out}/skew")
print("rows", base.count(), big.count(), "files/partitions", big.rdd.getNumPartitions())
for k, fn in ops.items():
    a, b, c = run(k, fn, base), run(k, fn, big), run(k, fn, sk)
    print(f"{k:20s} sf0.1={a:.2f}s  x10={b:.2f}s ({b/a:.1f}x)  x10+skew={c:.2f}s")
