"""The exploded keys of the fingerprints are never broadcast, however small Spark believes them to be."""

from pyspark.sql import functions as F

from cinelake.llm import simhash


def test_exploded_keys_are_not_broadcast(spark, tmp_path):
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(str(tmp_path / "classes"))
    links = simhash.links(spark.read.parquet(str(tmp_path / "classes")))
    links.write.format("noop").mode("overwrite").save()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
