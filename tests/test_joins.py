import pytest
from pyspark.sql import functions as F

from quireworks.operators.joins import lookup


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_lookup_under_a_hot_key(spark, how, broadcast):
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50)
    left = spark.range(3000).withColumn("key", key)
    right = spark.range(-1, 20).select(F.col("id").alias("key"), F.col("id").alias("value"))
    right = right.filter("key <> 7").unionAll(spark.createDataFrame([(None, 0)], "key long, value long"))
    known = {k for k in range(-1, 20) if k != 7}
    keys = [-1 if i % 3 == 0 else i % 50 for i in range(3000)]
    want = sorted(k for k in keys if (k in known) == (how != "left_anti"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert sorted(r.key for r in lookup(left, right, "key", how).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_rows_are_not_copied(spark):
    left, right = spark.range(50), spark.range(20)
    assert "Generate" not in lookup(left, right, "id", "left_semi")._jdf.queryExecution().toString()
