"""The filter of repeated keys, and clustered tables."""

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from procurelens.operators import duplicates, quality
from procurelens.sources import clustered


@pytest.mark.parametrize("most_bytes", [duplicates.FILTER_BYTES, 0])
def test_repeats_are_those_of_a_plain_grouping(spark, most_bytes):
    rng = np.random.default_rng(3)
    data = [(int(i), f"k{i % 997}" if i % 5 else None, float(i)) for i in rng.integers(0, 1 << 40, 4000)]
    data += data[:40] + data[:5] + [(None, None, 0.0)] * 3 + [(1, "a", 0.0), (1, "a", -0.0), (2, "b", float("nan")), (2, "b", float("nan"))]
    df = spark.createDataFrame(data, "a long, b string, c double").repartition(9)
    for keys in (["a", "b"], ["b"], ["a", "b", "c"], ["c"]):
        got, want = duplicates.repeated_keys(df, keys, most_bytes=most_bytes), quality.duplicate_keys(df, keys)
        assert list(map(str, rows(got))) == list(map(str, rows(want)))  # as text, for NaN
    assert duplicates.repeated_keys(df.limit(0), ["a"]).count() == 0


def test_few_unique_keys_pass_the_filter(spark):
    df = spark.range(200_000, numPartitions=6).select(F.when(F.col("id") < 10, 0).otherwise(F.col("id")).alias("id"))
    left = duplicates.possible_repeats(df, ["id"])
    n = left.count()
    assert 10 <= n < 0.2 * 200_000 and left.where("id = 0").count() == 10
    assert duplicates.slots_for(1 << 40) is None and duplicates.slots_for(0) == 64


def scanned(df):
    """Rows that the scan of a collected frame gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_vendor_is_read_without_the_others(spark, tmp_path):
    df = spark.range(400_000, numPartitions=2).selectExpr("id % 500 AS vendor", "id", "repeat(cast(id AS string), 4) AS note")
    plain, path = str(tmp_path / "plain"), str(tmp_path / "clustered")
    df.write.parquet(plain)
    clustered.write_clustered(df, path, "vendor", group_bytes=1 << 20)
    one = clustered.read_clustered(spark, path).where("vendor = 7")
    assert scanned(one) < 0.15 * scanned(spark.read.parquet(plain).where("vendor = 7"))
    assert one.count() == 800 and clustered.read_clustered(spark, path).count() == 400_000
