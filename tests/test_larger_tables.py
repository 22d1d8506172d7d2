"""What a build and the landing do once per row, per source and per file, on rows of their own."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bindings import feeds, registry
from bindings import warehouse as bound
from conftest import rows
from panelwatch.functions import clean
from panelwatch.operators import checks
from panelwatch.plans import dimensions, quality
from panelwatch.plans import staging as c
from panelwatch.plans.dimensions import RawTables
from panelwatch.plans.schema import TABLES
from panelwatch.sources.text_csv import read_text_csv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_tables(spark, tmp_path):
    day = datetime(1998, 3, 4)
    made = {
        "nation": ([(0, "N0"), (1, "N1")], "n_nationkey int, n_name string"),
        "customer": ([(1, 0, "BUILDING"), (2, 1, "MACHINERY"), (None, 1, "MACHINERY")], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "orders": (
            [(1, 1, "F", 50000.0, day, "2-HIGH"), (2, 2, "O", 900.0, day, "1-URGENT"), (3, None, "P", 1.0, day, "5-LOW")],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
    }
    for name, (values, schema) in made.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_numbers_are_those_of_the_decimal(spark):
    texts = ["7", " 7 ", "+7", "-7", "-0", "007", "\t7", "7\x7f", "1.5", "-2.5", "1e3", "2147483647", "2147483648", "٧", "", " ", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    told = df.select(
        clean.lenient_int(F.col("t")).alias("now"), F.round(F.trim("t").try_cast("decimal(38,18)")).try_cast("int").alias("decimal")
    )
    assert all(now == decimal for now, decimal in rows(told))
    assert [r[0] for r in rows(told)][:6] == [7, 7, 7, -7, 0, 7]


def test_dates_are_those_of_the_pattern(spark):
    texts = ["2015/9/1", "2015/09/01", " 2015/9/1 ", "0001/1/1", "9999/12/31", "2016/2/29", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    told = df.select(clean.strict_slash_date(F.col("t")), F.try_to_date(F.trim("t"), clean.SLASH_DATE))
    assert all(now == pattern for now, pattern in rows(told))
    for text in ("2015/2/29", "2015/9/1T", "2015-9/1", "2015/9", "2015/9/1 1", "\t2015/9/1"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(text,)], "t string").select(clean.strict_slash_date(F.col("t"))).collect()


def test_missing_values_are_looked_for_by_a_filter_on_the_files(spark, tmp_path):
    schema = TABLES["fact_covid_cases"]
    names = [part.split()[0] for part in schema.split(", ")]
    full = spark.range(4).select(*[F.lit(1).cast(part.split()[1]).alias(part.split()[0]) if part.split()[1] not in ("string", "boolean") else F.lit("true").cast(part.split()[1]).alias(part.split()[0]) for part in schema.split(", ")])
    holed = full.withColumn("case_count", F.lit(None).cast("int")).withColumn("geo_key", F.lit(None).cast(dict(full.dtypes)["geo_key"]))
    yearless = full.withColumn("onset_year", F.lit(None).cast("smallint")).limit(1)
    full.unionAll(holed).unionAll(yearless).write.partitionBy("onset_year").parquet(f"{tmp_path}/facts")
    table = spark.read.schema(schema).parquet(f"{tmp_path}/facts").select(*names)
    found = quality.not_null_constraints({"fact_covid_cases": table}, ["fact_covid_cases"])
    violated = {name: n for name, n in rows(found) if n}
    assert violated == {f"fact_covid_cases.{name} not null": n for name, n in (("case_count", 4), ("geo_key", 4), ("onset_year", 1))}
    assert found.count() == len(names)
    assert "PushedFilters: [Or(" in plan_of(found)


def test_no_row_is_counted_twice_by_its_conditions(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 1)], "a int, b int")
    assert dict(rows(checks.counted(df, {"a": "a IS NULL", "b": "b IS NULL"}))) == {"a": 1, "b": 2}
    assert dict(rows(checks.counted(df.where("a = 1 AND b = 1"), {"a": "a IS NULL"}))) == {"a": 0}


def raw_of(spark):
    def one(names, *values):
        return spark.createDataFrame(list(values), ", ".join(f"`{n}` string" for n in names))

    return RawTables(
        flu=one([c.VISIT_AGE, c.COUNTY, c.COUNTY_CODE], ("0~2", "A", "1"), ("0-2", "A", "1"), ("65+", "B", None)),
        ev=one([c.VISIT_AGE], ("3~4",), (None,)),
        covid=one([c.AGE, c.COUNTY, c.TOWN, c.TOWN_CODE], ("0", "A", "t", "9"), ("0", "A", "t", "9")),
        dengue=one([c.AGE, c.HOME_COUNTY, c.HOME_TOWN, c.INFECTION_COUNTY, c.INFECTION_TOWN], ("0", "A", "u", "B", ""), ("0", "A", "u", "C", "v")),
    )


def test_members_are_made_of_distinct_texts(spark):
    found = dimensions.members(raw_of(spark))
    assert {r for r in rows(found) if r[0] != "town"} == {
        ("age", "", "0-2", ""), ("age", "", "65+", ""), ("age", "", "3-4", ""), ("age", "", None, ""), ("age", "", "0", ""),
        ("county", "A", "", "1"), ("county", "B", "", None),
    }
    assert {r[1:] for r in rows(found) if r[0] == "town"} == {("A", "t", "9"), ("A", "u", ""), ("B", "", ""), ("C", "v", "")}
    assert found.count() == found.distinct().count() == 11
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    for i in (i for i, line in enumerate(plan) if "Generate" in line):
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        assert any("Aggregate" in line for line in plan[i:below])


def test_one_source_has_all_counties(spark):
    raw = raw_of(spark)
    alone = dimensions.county_map(dimensions.counties(raw.flu))
    assert sorted(rows(alone), key=str) == sorted(rows(dimensions.county_map(dimensions.members(raw))), key=str)


def test_only_what_is_read_is_landed(spark, small_tables):
    assert {r[0] for r in rows(registry.flu_values(spark, small_tables))} == {c.VISIT_TYPE, c.VISIT_AGE, c.COUNTY, c.WEEK}
    assert registry.QUERIES["ingested_flu"](spark, small_tables).count() == 2
    # There are no line items to land.
    assert set(bound._RAW[bound._state(spark, small_tables)]) == {"flu", "placed_orders"}


def test_many_suppliers_of_two_numbers_are_broadcast(spark, small_tables):
    spark.range(300_000).selectExpr("id AS s_suppkey", "CAST(id % 2 AS int) AS s_nationkey").write.parquet(f"{small_tables}/supplier.parquet")
    lines = spark.range(5).select(F.col("id").alias("l_suppkey"))
    lines.write.parquet(f"{small_tables}/lineitem.parquet")
    supplied = feeds._with_supplier(spark, small_tables, lines)
    assert "SortMergeJoin" not in plan_of(supplied)
    assert [r[0] for r in rows(supplied.orderBy("l_suppkey").select("s_county"))] == ["N0", "N1", "N0", "N1", "N0"]


def test_a_csv_file_has_a_bounded_number_of_records(spark, tmp_path):
    df = spark.range(7).selectExpr("CAST(id AS string) AS a", "'x\n\"y\"' AS b").coalesce(1)
    registry._to_csv(df, f"{tmp_path}/csv", 3)
    assert len(list(tmp_path.glob("csv/part-*.csv"))) == 3
    assert sorted(rows(read_text_csv(spark, f"{tmp_path}/csv"))) == sorted(rows(df))
