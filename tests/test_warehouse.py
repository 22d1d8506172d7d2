from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators import checks, lookup
from panelwatch.plans import analytics, api, dimensions, facts, quality, staging, warehouse
from panelwatch.plans.dimensions import RawTables
from panelwatch.plans.schema import DIMENSIONS, FACTS, TABLES
from panelwatch.sources.ingest import DATASETS
from panelwatch.sources.store import RawStore
from panelwatch.session import shared_dir

FLU = ["年", "週", "就診類別", "年齡別", "縣市", "縣市別代碼", "類流感健保就診人次", "健保就診總人次"]
EV = [*FLU[:6], "腸病毒健保就診人次", "健保就診總人次"]
COVID = ["發病年份", "發病月份", "縣市", "鄉鎮", "鄉鎮別代碼", "性別", "年齡層", "是否為境外移入", "確定病例數"]
DENGUE = [
    "發病日", "個案研判日", "通報日", "性別", "年齡層", "居住縣市", "居住鄉鎮", "感染縣市", "感染鄉鎮",
    "是否境外移入", "感染國家", "血清型", "最小統計區中心點X", "最小統計區中心點Y", "確定病例數",
]
FLU_ROWS = [
    ("2015", "36", "門診", "0~2", "台南市", "67000", "4", "100"),
    ("2015", "36", "住院", "65+", "台南市", "67000", "6", "100"),
    ("2015", "38", "門診", "0~2", "台北市", "63000", "5", "0"),
    # 2014 has no week 53: this is week 1 of 2015.
    ("2014", "53", "門診", "0~2", "台北市", "63000", "7", "10"),
]
EV_ROWS = [("2015", "37", "門診", "3~4", "台北市", "63000", "2", "50")]
COVID_ROWS = [
    ("2022", "4", "台北市", "", "", "M", "0", "1", "100"),
    ("2022", "4", "台南市", "東區", "6701", "", "30-34", "0", "50"),
    ("2022", "4", "台南市", "東區", "", "X", "70+", "0", "50"),
    ("2022", "6", "台北市", "", "", "F", "不詳", "0", "300"),
]
DENGUE_ROWS = [
    ("2015/09/01", "2015/9/3", "", "M", "30-34", "台南市", "東區", "台南市", "北區", "否", "", "第二型", "120.21", "22.99", "1"),
    ("2015/9/1", "", "2015/09/05", "F", "0", "台南市", "東區", "", "", "是", "泰國", "", "120.22", "", "1"),
    ("2015/09/15", "", "", "X", "不詳", "", "東區", "外島", "某鎮", "否", "", "", "", "", "1"),
    ("2016/01/01", "", "", "M", "0", "台北市", "", "台北市", "", "否", "", "", "121.5", "25.0", "1"),
]


def raw_of(spark, flu=FLU_ROWS, ev=EV_ROWS, covid=COVID_ROWS, dengue=DENGUE_ROWS):
    def table(names, data):
        return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))

    return RawTables(table(FLU, flu), table(EV, ev), table(COVID, covid), table(DENGUE, dengue))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


@pytest.fixture(scope="module")
def tables(spark, root):
    return warehouse.build(raw_of(spark), root)


def test_tables_have_the_declared_types(spark, tables):
    for name, ddl in TABLES.items():
        assert [f"{c} {t}" for c, t in tables[name].dtypes] == ddl.split(", "), name


def test_default_calendar(spark):
    days = dimensions.calendar_dimension(spark)
    assert days.count() == 10592
    weeks = dimensions.iso_weeks(days)
    assert weeks.agg(F.count("*"), F.min("week_start_date"), F.max("week_start_date")).first() == (
        1514, date(1997, 12, 29), date(2026, 12, 28),
    )
    first = days.where("date_key = 20210101").first()
    assert tuple(first) == (20210101, date(2021, 1, 1), 2021, 1, 1, 1, 2020, 53, 5, True, False)


def test_geography(tables):
    got = rows(tables["dim_geography"].drop("geo_key"), "county_name", "town_name")
    assert got == sorted(
        [
            ("63000", "台北市", "", "", "county"),
            ("67000", "台南市", "", "", "county"),
            ("67000", "台南市", "", "北區", "town"),
            ("67000", "台南市", "6701", "東區", "town"),
            ("00000", "未知", "", "", "county"),
        ],
        key=lambda r: (r[1].encode(), r[3].encode()),
    )
    assert rows(tables["dim_geography"].select("geo_key"), "geo_key") == [(i,) for i in range(1, 6)]


def test_ages_and_seeds(tables):
    ages = {r["age_label"]: (r["age_lower"], r["age_upper"]) for r in tables["dim_age_group"].collect()}
    assert ages == {
        "0-2": (0, 2), "65+": (65, None), "3-4": (3, 4), "0": (0, 0), "30-34": (30, 34), "70+": (70, None),
        "不詳": (None, None),
    }
    assert rows(api.diseases(tables)) == [
        ("FLU", "流感"), ("EV", "腸病毒感染併發重症"), ("19CoV", "嚴重特殊傳染性肺炎"), ("DENGUE", "登革熱"),
    ]
    assert [r["gender_code"] for r in tables["dim_gender"].orderBy("gender_key").collect()] == ["M", "F", "U"]


def test_visits_keep_the_source_week(tables):
    got = rows(tables["fact_nhi_visits"].select("date_key", "iso_year", "iso_week", "visit_count"), "date_key")
    assert got[0] == (20141229, 2014, 53, 7)
    assert {r[0] for r in got} == {20141229, 20150831, 20150907, 20150914}


def test_case_geography_in_two_roles(tables):
    geo = {r["geo_key"]: (r["county_name"], r["town_name"]) for r in tables["dim_geography"].collect()}
    cases = tables["fact_dengue_cases"].orderBy("onset_date_key", "gender_key").collect()
    places = [(geo[c["residence_geo_key"]], geo.get(c["infection_geo_key"])) for c in cases]
    assert places == [
        (("台南市", "東區"), ("台南市", "北區")),
        (("台南市", "東區"), None),
        (("未知", ""), None),
        (("台北市", ""), ("台北市", "")),
    ]
    first = cases[0]
    assert (first["determined_date_key"], first["reported_date_key"]) == (20150903, None)
    assert (first["infection_country"], first["serotype"]) == (None, "第二型")
    assert [c["is_imported"] for c in cases] == [False, True, False, False]


def test_weekly_layers(tables):
    sparse = {r[:2]: r[2:] for r in rows(
        tables["agg_weekly"].where("disease_code = 'DENGUE'")
        .select("county_name", "week_start_date", "metric_value", "denominator")
    )}
    assert sparse == {
        ("台南市", date(2015, 8, 31)): (2, None),
        ("未知", date(2015, 9, 14)): (1, None),
        ("台北市", date(2015, 12, 28)): (1, None),
    }
    dense = analytics.weekly_dense(tables).where("disease_code = 'DENGUE'")
    # 18 weeks, two counties, the unknown one left out.
    assert dense.count() == 36 and dense.agg(F.sum("metric_value")).first()[0] == 3
    # The calendar's week, not the source's.
    assert rows(tables["agg_weekly"].where("week_start_date = '2014-12-29'").select("iso_year", "iso_week")) == [(2015, 1)]


def test_invariants_of_the_layers(tables):
    dense = analytics.weekly_dense(tables)
    counties = api.counties(tables).count()
    spans = tables["agg_weekly"].groupBy("disease_code").agg(
        (F.date_diff(F.max("week_start_date"), F.min("week_start_date")) / 7 + 1).alias("n")
    )
    assert dense.count() == counties * spans.agg(F.sum("n")).first()[0]
    shown = tables["agg_weekly"].where("county_name <> '未知'")
    assert dense.agg(F.sum("metric_value")).first() == shown.agg(F.sum("metric_value")).first()
    groups = analytics.weekly_rank(tables).groupBy("disease_code", "week_start_date").agg(
        F.min("county_rank"), F.sum("pct_of_national"), F.count("pct_of_national"), F.count("*")
    )
    for _, _, first, share, shares, n in groups.collect():
        assert first == 1
        assert (shares == 0) or (shares == n and abs(share - 100) < 0.2)


def test_rate_needs_a_denominator(tables):
    trend = analytics.weekly_trend(tables).where("disease_code = 'FLU'")
    got = {(r["county_name"], r["week_start_date"]): r["visit_rate"] for r in trend.collect()}
    assert got[("台南市", date(2015, 8, 31))] == 0.05
    assert got[("台北市", date(2015, 9, 14))] is None
    assert got[("台南市", date(2015, 9, 14))] is None


def test_monthly_layers(tables):
    got = rows(analytics.monthly_trend(tables).drop("onset_year", "onset_month"), "county_name", "month_start")
    assert got == [
        ("台北市", date(2022, 4, 1), 100, 100.0, None, None, None),
        ("台北市", date(2022, 5, 1), 0, 50.0, 100, -100, -100.0),
        ("台北市", date(2022, 6, 1), 300, 133.3, 0, 300, None),
        ("台南市", date(2022, 4, 1), 100, 100.0, None, None, None),
        ("台南市", date(2022, 5, 1), 0, 50.0, 100, -100, -100.0),
        ("台南市", date(2022, 6, 1), 0, 33.3, 0, 0, None),
    ]
    ranked = analytics.monthly_rank(tables).where("month_start = '2022-04-01'")
    assert rows(ranked.select("county_name", "county_rank", "pct_of_national"), "county_name") == [
        ("台北市", 1, 50.0), ("台南市", 1, 50.0),
    ]


def test_kpis(tables):
    got = api.weekly_kpis(tables, "DENGUE", "台南市").first().asDict()
    assert got == {
        "latest_value": 0, "latest_week": date(2015, 12, 28), "latest_wow": None, "latest_ma4": 0.0,
        "peak_value": 2, "peak_week": date(2015, 8, 31), "total_value": 2,
    }
    assert tuple(api.weekly_kpis(tables, "DENGUE", "nowhere").first()) == (None,) * 7


def test_points_and_years(tables):
    assert rows(api.dengue_points(tables), "lat") == [(22.99, 120.21, 2015), (25.0, 121.5, 2016)]
    assert rows(api.dengue_points(tables, 2016)) == [(25.0, 121.5, 2016)]
    assert rows(api.dengue_years(tables)) == [(2015,), (2016,)]
    # A missing latitude counts here, but gives no point.
    assert tuple(api.dengue_top_year(tables).first()) == (2015, 2)
    assert rows(api.map_points(tables, 2015, 10)) == [(22.99, 120.21)]


def test_headline_questions(tables):
    assert api.fact_total(tables).first()[0] == 13
    assert tuple(api.onset_span(tables).first()) == (date(2015, 9, 1), date(2016, 1, 1), 1)
    assert tuple(api.peak_year(tables, "DENGUE", "台南市").first()) == (2015, 2)
    assert tuple(api.peak_month(tables).first()) == (2022, 6, 300)
    assert tuple(api.peak_week(tables, "DENGUE", 2015).first()) == (date(2015, 8, 31), 2)
    assert [r["county_name"] for r in api.peak_week_ranking(tables, "DENGUE", 2015).collect()] == ["台南市", "台北市"]
    bars = api.rank_bars(tables, "DENGUE", date(2015, 8, 31), "台北市", 1)
    assert rows(bars) == [("台南市", 2, 1, 100.0, False)]
    growth = api.growth_bars(tables, "DENGUE", "台南市")
    assert rows(growth) == [(date(2015, 9, 7), -100.0, "down")]


def test_week_list_equals_the_dense_weeks(tables):
    for disease in ("FLU", "EV", "DENGUE", "none"):
        dense = analytics.weekly_dense(tables).where(F.col("disease_code") == disease)
        expected = rows(dense.select("week_start_date").distinct(), "week_start_date")
        assert rows(api.weekly_weeks(tables, disease)) == expected


def test_quality_figures(tables):
    assert tuple(quality.geography_sizes(tables).first()) == (3, 2)
    assert quality.geocoded_share(tables).first()[0] == 75.0
    assert rows(quality.top_counties_by_visits(tables, "FLU")) == [("台北市", 12), ("台南市", 10)]
    counts = dict(rows(quality.row_counts(tables)))
    assert set(counts) == set(DIMENSIONS + FACTS) and counts["fact_dengue_cases"] == 4


def test_all_constraints_hold(spark, tables):
    parts = (quality.unique_constraints, quality.not_null_constraints, quality.reference_constraints)
    unique, not_null, references = (part(tables).collect() for part in parts)
    assert all(r["violations"] == 0 for r in [*unique, *not_null, *references])
    assert (len(unique), len(not_null), len(references)) == (12, 56, 17)


def test_build_report_has_all_checks(spark, tables):
    report = quality.build_report(warehouse.staged_tables(raw_of(spark)), tables)
    got = dict(rows(report))
    assert all(got.values()) and len(got) == 3 + 2 + 12 + 56 + 17


def test_ensure_builds_once(spark, root, tables):
    def never():
        raise AssertionError("built again")

    opened = warehouse.ensure(spark, root, never)
    assert opened["agg_weekly"].count() == tables["agg_weekly"].count()


def test_rebuild_gives_the_same_and_replaces(spark, root, tables):
    again = warehouse.build(raw_of(spark), root)
    for name in ("dim_geography", "dim_age_group", "agg_weekly", "agg_monthly"):
        assert tables[name].exceptAll(again[name]).isEmpty()
    assert warehouse.open_warehouse(spark, root)["dim_date"].inputFiles() == again["dim_date"].inputFiles()


def broken(rows_, column_names, column, value, at=0):
    out = [list(r) for r in rows_]
    out[at][column_names.index(column)] = value
    return [tuple(r) for r in out]


def test_a_failed_build_names_its_checks_and_publishes_nothing(spark, tmp_path):
    flu = broken(FLU_ROWS, FLU, "類流感健保就診人次", "abc")
    flu = broken(flu, FLU, "健保就診總人次", "", 1)
    flu = broken(flu, FLU, "類流感健保就診人次", "-3", 2)
    raw = raw_of(
        spark,
        flu=broken(flu, FLU, "縣市別代碼", "1", 1),
        covid=broken(COVID_ROWS, COVID, "縣市", "外島"),
        dengue=broken([r[:12] + ("", "", "1") for r in DENGUE_ROWS], DENGUE, "發病日", "1997/12/31"),
    )
    with pytest.raises(warehouse.QualityError) as failure:
        warehouse.build(raw, str(tmp_path))
    assert set(str(failure.value).split(", ")) >= {
        "fact_nhi_visits.visit_count not null",
        "fact_nhi_visits.total_visit_count not null",
        "no negative visit_count",
        "fact_covid_cases rows landed",
        "fact_dengue_cases.onset_date_key references dim_date",
        "some cases geocoded",
    }
    assert "dim_geography(county_name, town_name) unique" in str(failure.value)
    assert "dim_gender" not in str(failure.value)
    assert warehouse.open_warehouse(spark, str(tmp_path)) is None


def test_a_county_missing_from_the_map_loses_its_visits(spark, tables):
    raw = raw_of(spark, ev=broken(EV_ROWS, EV, "縣市", "外島"))
    staged = warehouse.staged_tables(raw)
    loaded = {**tables, "fact_nhi_visits": facts.load_nhi(staged["stg_nhi"], tables)}
    assert dict(rows(quality.rows_landed(staged, loaded))) == {
        "fact_nhi_visits rows landed": False,
        "fact_covid_cases rows landed": True,
        "fact_dengue_cases rows landed": True,
    }


@pytest.mark.parametrize("column", ["發病日", "通報日", "個案研判日"])
def test_malformed_dates_abort(spark, tables, column):
    raw = raw_of(spark, dengue=broken(DENGUE_ROWS, DENGUE, column, "bad"))
    with pytest.raises(PySparkException, match="malformed date: bad"):
        facts.load_dengue(staging.stage_dengue(raw.dengue), tables).collect()


def test_malformed_weeks_and_ages_abort(spark, tables):
    raw = raw_of(spark, flu=broken(FLU_ROWS, FLU, "年", "x"))
    with pytest.raises(PySparkException, match="malformed"):
        facts.load_nhi(staging.stage_nhi(raw.flu, raw.ev), tables).collect()
    raw = raw_of(spark, flu=broken(FLU_ROWS, FLU, "年齡別", "-"))
    with pytest.raises(PySparkException, match="malformed"):
        dimensions.age_dimension(dimensions.members(raw)).collect()


def test_views_can_be_queried_by_name(spark, tables):
    analytics.register_views(tables)
    got = spark.sql(
        "SELECT max(ma4) FROM v_weekly_trend WHERE disease_code = :d AND county_name = :c",
        args={"d": "DENGUE", "c": "台南市"},
    ).first()[0]
    assert got == 2.0
    analytics.register_views(tables)


def test_line_filter_reaches_the_scan(tables):
    line = api.weekly_trend(tables, "DENGUE", "台南市")
    text = line._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(county_name,台南市)" in text
    assert "disease_code" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_year_filter_prunes_partitions(tables):
    text = api.dengue_points(tables, 2015)._jdf.queryExecution().executedPlan().toString()
    assert "onset_year" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "serotype" not in text.split("ReadSchema")[1]


def test_disease_filter_drops_the_other_branch(spark):
    raw = raw_of(spark)
    staged = staging.stage_nhi(raw.flu, raw.ev).where("disease_code = 'EV'")
    assert "Union" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_fact_load_does_not_shuffle(spark, tables):
    staged = warehouse.staged_tables(raw_of(spark))
    for load, stage in ((facts.load_nhi, "stg_nhi"), (facts.load_covid, "stg_covid"), (facts.load_dengue, "stg_dengue")):
        text = load(staged[stage], tables)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") >= 3
        assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_dimensions_too_large_to_broadcast_give_the_same_facts(spark, tables, monkeypatch):
    for module in (lookup, facts):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    staged = warehouse.staged_tables(raw_of(spark))
    for load, stage, fact in (
        (facts.load_nhi, "stg_nhi", "fact_nhi_visits"),
        (facts.load_covid, "stg_covid", "fact_covid_cases"),
        (facts.load_dengue, "stg_dengue", "fact_dengue_cases"),
    ):
        picked = tables[fact].columns[1:]
        split = load(staged[stage], tables).select(picked)
        assert split.exceptAll(tables[fact].select(picked)).isEmpty()
        assert split.count() == tables[fact].count()


def test_fact_ids_are_made_below_all_joins(spark, tables, monkeypatch):
    for module in (lookup, facts):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    staged = warehouse.staged_tables(raw_of(spark))
    loaded = facts.load_dengue(staged["stg_dengue"], tables)
    plan = loaded._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(plan)}
    ids = [i for i, line in enumerate(plan) if "monotonically_increasing_id" in line]
    assert ids
    for i in ids:
        below = [j for j in range(i + 1, len(plan)) if depth[j] > depth[i]]
        assert below and not any("Join" in plan[j] for j in below[:1])


def test_constraints_hold_a_row_each_also_for_empty_tables(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    for constraints in (quality.unique_constraints, quality.reference_constraints, quality.not_null_constraints):
        full, none = constraints(tables).collect(), constraints(empty).collect()
        assert sorted(r.constraint for r in full) == sorted(r.constraint for r in none)
        assert {r.violations for r in none} == {0}


def test_duplicate_keys_keep_types_and_nulls_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, ""), (None, None), (None, "\u0001")], "k int, t string")
    keys = [("k", df, ["k"]), ("t", df, ["t"]), ("both", df, ["t", "k"])]
    assert rows(checks.duplicate_keys(keys), "constraint") == [("both", 0), ("k", 2), ("t", 0)]


def test_views_and_ranks_start_no_job(spark, tables):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    analytics.register_views(tables, warehouse.staged_tables(raw_of(spark)))
    api.county_rank_week(tables, "DENGUE", date(2015, 9, 7))
    assert jobs() == before
    assert spark.table("dim_iso_week").columns == ["iso_year", "iso_week", "week_start_date"]
    assert spark.table("stg_dengue").count() == 4


def test_sample_is_the_same_after_a_rebuild(spark, tables, tmp_path):
    again = warehouse.build(raw_of(spark), str(tmp_path), ("2010-01-01", "2024-12-31"))
    assert rows(api.map_points(tables, 2015, 1)) == rows(api.map_points(again, 2015, 1))


def test_raw_tables_from_the_store(spark, tmp_path):
    store = RawStore(str(tmp_path))
    raw = raw_of(spark)
    for role, (name, _) in DATASETS.items():
        store.add(getattr(raw, role), name, "20240101T000000000000Z")
    assert warehouse.raw_tables(spark, store).dengue.count() == 4


def test_shared_folder_comes_from_the_session():
    def session(named, master):
        context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
        return SimpleNamespace(conf={"spark.checkpoint.dir": named} if named else {}, sparkContext=context)

    assert shared_dir(session("hdfs://x/shared/", "yarn")) == "hdfs://x/shared"
    assert shared_dir(session("/shared", "local[4]")) == "/shared"
    assert "panelwatch-" in shared_dir(session(None, "local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"))
