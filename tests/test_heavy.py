"""Top names from bounded counters, and joins that split measured hot keys."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import functions as F

from procurelens.operators import heavy, joins, ranking


def plain(df, name, value=None, top=10):
    total = F.count("*") if value is None else F.sum(value)
    return ranking.top_rows(df.groupBy(F.col(name).alias("name")).agg(total.alias("total")), "total", "name", top)


def test_counters_never_exceed_the_true_sums_and_miss_at_most_what_was_taken_off():
    rng = np.random.default_rng(5)
    names, weights = rng.zipf(1.3, 20_000) % 5000, rng.integers(0, 50, 20_000).astype(float)
    kept, lost = None, 0.0
    for at in range(0, 20_000, 700):
        part = pa.table({"name": names[at : at + 700], "weight": weights[at : at + 700]})
        kept, off = heavy.reduced(part if kept is None else pa.concat_tables([kept, part]), 64)
        lost += off
        assert kept.num_rows <= 64
    counted = dict(zip(kept["name"].to_pylist(), kept["weight"].to_pylist(), strict=True))
    assert lost <= weights.sum() / 65
    for name in np.unique(names):
        true = weights[names == name].sum()
        assert counted.get(name, 0.0) <= true <= counted.get(name, 0.0) + lost


@pytest.fixture(scope="module")
def skewed(spark):
    # Hot names with ties, many names that are alone, and NULLs among names and values.
    return spark.range(60_000, numPartitions=7).selectExpr(
        "CASE WHEN id % 2 = 0 THEN concat('h', id % 34) WHEN id % 5 = 0 THEN NULL ELSE concat('u', id) END AS n",
        "CASE WHEN id % 9 > 0 THEN cast(id % 100 AS decimal(9,2)) END AS w",
        "id AS alone",
        "cast(id % 3 AS double) AS real",
    )


@pytest.mark.parametrize("value", [None, "w"])
@pytest.mark.parametrize("capacity", [1, 40, heavy.CAPACITY])
def test_top_names_are_those_of_a_plain_grouping(skewed, value, capacity):
    for top in (1, 10, 18, 25):
        got, want = heavy.top_names(skewed, "n", value, top, capacity).collect(), plain(skewed, "n", value, top).collect()
        assert got == want


def test_few_names_reach_the_second_pass(skewed):
    some = heavy.candidates(skewed, "n", None, 10, capacity=1000)
    assert 18 <= some.count() < 100 and skewed.select("n").distinct().count() > 20_000


def test_names_that_the_bound_cannot_tell_apart_are_grouped_plainly(spark, skewed):
    assert heavy.candidates(skewed, "alone", None, 10, capacity=50) is None  # all of one size
    assert heavy.candidates(skewed, "n", None, 10, capacity=1000, most=3) is None  # too many to send
    assert heavy.candidates(skewed, "real", None, 2) is None  # floating names
    negative = skewed.withColumn("w", -F.col("w"))
    assert heavy.candidates(negative, "n", "w", 10) is None
    assert heavy.top_names(negative, "n", "w").collect() == plain(negative, "n", "w").collect()
    assert heavy.top_names(skewed, "alone", None, 5, 50).collect() == plain(skewed, "alone", None, 5).collect()
    few = spark.createDataFrame([("a", None), ("a", 2), (None, None)], "n string, w int")
    for value in (None, "w"):
        assert heavy.top_names(few, "n", value).collect() == plain(few, "n", value).collect()
        assert heavy.top_names(few.limit(0), "n", value).collect() == []


def test_only_hot_keys_are_repeated(spark):
    facts = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id END AS k", "id AS row")
    lookup = spark.range(0, 9000, 2).selectExpr("id AS k", "id * 10 AS v").unionByName(
        spark.createDataFrame([(1, 10), (None, 99)], "k bigint, v bigint"))
    hot = joins.hot_keys(facts, "k").head()["parts"]
    share = 3000 / facts.where("k IS NOT NULL").count()
    assert set(hot) == {1} and 64 * share <= hot[1] <= 64 * share + 2
    want = rows(facts.join(lookup, "k", "left").select("k", "row", "v"))
    assert rows(joins.skew_join(facts, lookup, "k", ["row"])) == want
    inner = rows(facts.join(lookup, "k").select("k", "row", "v"))
    assert rows(joins.skew_join(facts, lookup, "k", ["row"], how="inner", share=0.2)) == inner
    # A table that stands for the facts decides the parts, not the rows; so do tables without rows.
    assert rows(joins.skew_join(facts, lookup, "k", ["row"], measured=lookup)) == want
    assert rows(joins.skew_join(facts, lookup, "k", ["row"], measured=facts.limit(0))) == want
    assert joins.skew_join(facts.limit(0), lookup, "k", ["row"]).count() == 0
    text = facts.withColumn("k", F.col("k").cast("string"))
    named = lookup.withColumn("k", F.col("k").cast("string"))
    assert joins.skew_join(text, named, "k", ["row"]).where("v IS NOT NULL").count() == len(inner)
