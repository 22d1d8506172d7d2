from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import keys, lookup, pick, profile


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a sixth none at all."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(6000).select("id", key.cast("int").alias("key"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("key"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_broadcast_join(skewed, dim, how):
    plain = lookup.lookup(skewed, dim, ["key"], how, small=True)
    split = lookup.lookup(skewed, dim, ["key"], how, small=False, pieces=20)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    assert plain.count() == split.count()


def test_split_join_spreads_the_hot_key(spark, skewed, dim):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        split = lookup.split_join(skewed, dim, ["key"], "left", pieces=20)
        sizes = [r[0] for r in split.groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = skewed.join(dim.hint("merge"), ["key"], "left")
        worst = plain.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(sizes) == 6000
    assert worst > 2000 and max(sizes) < worst / 2


def test_chained_lookups_draw_no_salt_from_a_generated_id(skewed, dim):
    """A salt from a row's place above a shuffle would change when a task runs again."""
    second = dim.withColumnsRenamed({"key": "other", "name": "other_name"})
    facts = skewed.withColumn("other", F.col("key"))
    once = lookup.split_join(facts, dim, ["key"], "left", pieces=20)
    twice = lookup.split_join(once, second, ["other"], "left", keys_of=facts, pieces=20)
    assert "monotonically_increasing_id" not in twice._jdf.queryExecution().optimizedPlan().toString()
    moved = lookup.split_join(facts.repartition(7, "id"), dim, ["key"], "left", pieces=20)
    assert moved.exceptAll(once).isEmpty() and once.exceptAll(moved).isEmpty()


def test_salts_of_any_column_type(spark, dim):
    facts = spark.range(100).select(
        F.lit(7).alias("key"), F.create_map(F.lit("a"), "id").alias("m"), F.array("id").alias("odd`name")
    )
    assert lookup.split_join(facts, dim, ["key"], pieces=5).count() == 100
    assert lookup.split_join(facts, dim, ["key"], salt_by=["odd`name"], pieces=5).count() == 100


def test_lookup_checks_the_size(skewed, dim, monkeypatch):
    assert lookup.fits_broadcast(dim, 40) and not lookup.fits_broadcast(dim, 39)
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df: False)
    called = []
    monkeypatch.setattr(lookup, "split_join", lambda *a, **k: called.append(a))
    lookup.lookup(skewed, dim, ["key"])
    assert called


def test_split_join_of_nothing(spark, skewed, dim):
    assert lookup.split_join(skewed.where("id < 0"), dim, ["key"]).isEmpty()


def test_every_pair(spark):
    left = spark.createDataFrame([("s", 1), ("t", 2)], "series string, n int")
    right = spark.createDataFrame([(f"p{i}",) for i in range(100)], "place string")
    pairs = lookup.every_pair(left, right, "place")
    assert pairs.count() == 200 and pairs.distinct().count() == 200


def test_keys_follow_the_natural_order_whatever_the_size(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("a"), F.lit("").alias("b"))
    one, many = (keys.number_rows(df, ["a", "b"], "key", small=s) for s in (True, False))
    expected = [(a, "", i) for i, a in enumerate(sorted(r[0] for r in df.select("a").collect()), 1)]
    assert rows(one, "key") == expected
    assert rows(many.select("a", "b", "key"), "key") == expected


def test_top_groups_break_ties_by_key(spark):
    df = spark.createDataFrame([(2001,), (2001,), (2003,), (2003,), (2002,)], "y int")
    assert rows(pick.top_groups(df, ["y"], F.count("*"), "n", 2)) == [(2001, 2), (2003, 2)]


def test_peak_takes_the_earliest_of_equals(spark):
    weeks = [(date(2020, 1, 6 + 7 * i), v) for i, v in enumerate([1, 9, 9])]
    df = spark.createDataFrame(weeks, "week date, n long")
    got = df.agg(pick.peak("week", "n", "week"), pick.latest("n", "week")).first()
    assert tuple(got) == (date(2020, 1, 13), 9)


def test_sample_is_exact_seeded_and_only_if_larger(spark):
    df = spark.range(20000).withColumn("lat", F.lit(1.0))
    picked = pick.sample_rows(df, 500, ["id"], seed=0)
    ids = {r[0] for r in picked.select("id").collect()}
    assert len(ids) == 500 and picked.columns == df.columns
    assert ids == {r[0] for r in pick.sample_rows(df.repartition(7), 500, ["id"], seed=0).select("id").collect()}
    assert ids != {r[0] for r in pick.sample_rows(df, 500, ["id"], seed=1).select("id").collect()}
    by_digest = df.orderBy(F.md5(F.concat(F.lit("0:"), F.col("id").cast("string")))).limit(500)
    assert ids == {r[0] for r in by_digest.select("id").collect()}
    assert pick.sample_rows(df, 20000, ["id"]) is df


def test_sample_with_too_few_below_the_threshold(spark):
    # All rows share one digest, so a threshold keeps all or none of them.
    df = spark.range(1000).withColumn("same", F.lit("x"))
    assert pick.sample_rows(df, 100, ["same"]).count() == 100


def test_grid_density_counts_located_points(spark):
    df = spark.createDataFrame(
        [(22.91, 120.2), (22.94, 120.24), (None, 120.2), (22.9, None), (23.0, 120.2)], "lat double, lon double"
    )
    assert rows(pick.grid_density(df, "lat", "lon", 1), "lat") == [(22.9, 120.2, 2), (23.0, 120.2, 1)]


def test_profiles(spark):
    df = spark.createDataFrame([("a", "1"), ("a", ""), ("台北市", None), ("b", "1")], "x string, y string")
    assert rows(profile.value_counts(df, ["x", "y"]), "column_name", F.col("value").asc_nulls_last()) == [
        ("x", "a", 2), ("x", "b", 1), ("x", "台北市", 1), ("y", "", 1), ("y", "1", 2), ("y", None, 1),
    ]
    assert rows(profile.extent(df, ["x", "y"]), "column_name") == [
        ("x", "a", "台北市", 3, 0, 4), ("y", "", "1", 2, 2, 4),
    ]
    assert rows(profile.length_histogram(df, "x"), "len") == [(1, 3), (3, 1)]
    assert rows(profile.shortest_values(df, "x", 2, 1)) == [("a", 2)]
    found = profile.values_containing({"one": (df, "x"), "two": (df, "y")}, "%北%")
    assert rows(found) == [("one", "台北市")]
    assert rows(profile.distinct_union([(df, "x"), (df, "y")], "v"), "v") == [("1",), ("a",), ("b",), ("台北市",)]
