"""A customer owning a third of all lines: results stay whole and AQE splits
the hot partition of the lineitem join instead of one task taking it all."""

import pytest
from pyspark.sql import functions as F

from gapscope.session import fresh_dir
from gapscope.sources.households import customer_counts


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = fresh_dir(spark, "t-skew")
    n_orders, hot_lines = 400, 6000
    spark.createDataFrame([(k, f"NATION_{k}", 0) for k in range(5)],
                          "n_nationkey int, n_name string, n_regionkey int") \
        .write.parquet(f"{d}/nation.parquet")
    spark.range(50).select(F.col("id").alias("c_custkey"),
                           F.concat(F.lit("C#"), F.col("id").cast("string")).alias("c_name"),
                           (F.col("id") % 5).cast("int").alias("c_nationkey")) \
        .write.parquet(f"{d}/customer.parquet")
    # order 0 belongs to customer 7 and carries a third of all lines
    spark.range(n_orders).select(F.col("id").alias("o_orderkey"),
                                 F.when(F.col("id") == 0, 7).otherwise(F.col("id") % 50)
                                 .alias("o_custkey")) \
        .write.parquet(f"{d}/orders.parquet")
    # random cells keep the hot partition large after shuffle compression
    hot = spark.range(hot_lines).select(F.lit(0).cast("long").alias("l_orderkey"),
                                        F.floor(F.rand(1) * 50 + 1).alias("l_quantity"),
                                        F.round(F.rand(2) * 0.1, 2).alias("l_discount"))
    cold = spark.range(2 * hot_lines).select(((F.col("id") % (n_orders - 1)) + 1).alias("l_orderkey"),
                                             ((F.col("id") % 50) + 1).cast("double").alias("l_quantity"),
                                             F.lit(0.01).alias("l_discount"))
    hot.unionByName(cold).repartition(8).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_counts_whole_under_skew(spark, skewed_dir):
    """Against a pandas brute force over the same small fixture."""
    pd_ = {t: spark.read.parquet(f"{skewed_dir}/{t}.parquet").toPandas()
           for t in ("lineitem", "orders", "customer")}
    hh = (pd_["lineitem"].merge(pd_["orders"], left_on="l_orderkey", right_on="o_orderkey")
          .merge(pd_["customer"], left_on="o_custkey", right_on="c_custkey"))
    b = 37 + hh.c_nationkey % 10
    hh = hh.assign(bb=hh.l_quantity <= b, off=hh.l_discount >= 0.085)
    want = hh.groupby("c_custkey").agg(total=("l_quantity", "count"), bb=("bb", "sum"),
                                       off=("off", "sum"))
    got = {r.c_custkey: r for r in customer_counts(spark, skewed_dir).collect()}
    assert len(got) == 50 and sum(r.total_households for r in got.values()) == 18000
    for k, w in want.iterrows():
        assert (got[k].total_households, got[k].households_broadband_any,
                got[k].households_no_internet) == (w.total, w.bb, w.off)
    assert got[7].total_households >= 6000                   # the hot customer is whole


def test_aqe_splits_the_hot_partition(spark, skewed_dir):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = customer_counts(spark, skewed_dir)
        rows = df.collect()            # runs this DataFrame's own adaptive plan
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 50
    assert "isFinalPlan=true" in final and "skew=true" in final
