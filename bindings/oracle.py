"""The registered queries in SQL, over the driver's tables only.

Every layer below is one or more common table expressions; a query is a final SELECT on
the layers it needs, from the derived sources up.
"""

from __future__ import annotations

from panelwatch.plans.schema import DIMENSIONS, FACTS, NULLABLE, REFERENCES, UNIQUE, columns

SOURCES = """
src_flu AS (
  SELECT isoyear(o_orderdate)::VARCHAR AS yr, week(o_orderdate)::VARCHAR AS wk,
         CASE o_orderstatus WHEN 'F' THEN '住院' WHEN 'O' THEN '門診' ELSE '急診' END AS kind,
         CASE c_mktsegment WHEN 'BUILDING' THEN '0~2' WHEN 'AUTOMOBILE' THEN '3~4'
              WHEN 'FURNITURE' THEN '5~14' WHEN 'HOUSEHOLD' THEN '15~64' ELSE '65+' END AS age,
         n_name AS county, (n_nationkey + 10001)::VARCHAR AS county_code,
         CASE o_orderstatus WHEN 'F' THEN floor(o_totalprice / 10000)::BIGINT::VARCHAR
              WHEN 'O' THEN ' 1 ' ELSE '0' END AS n,
         floor(o_totalprice / 1000)::BIGINT::VARCHAR AS n_all
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
src_ev AS (
  SELECT isoyear(l_shipdate)::VARCHAR AS yr, week(l_shipdate)::VARCHAR AS wk,
         CASE l_linestatus WHEN 'O' THEN '門診' ELSE '急診' END AS kind,
         CASE l_linenumber WHEN 1 THEN '0~2' WHEN 2 THEN '3~4' WHEN 3 THEN '5~14'
              WHEN 4 THEN '15~64' ELSE '65+' END AS age,
         n_name AS county, (n_nationkey + 10001)::VARCHAR AS county_code,
         CASE l_returnflag WHEN 'R' THEN l_linenumber::VARCHAR ELSE '0' END AS n,
         floor(l_quantity + l_linenumber)::BIGINT::VARCHAR AS n_all
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
src_covid AS (
  SELECT year(o_orderdate)::VARCHAR AS yr, month(o_orderdate)::VARCHAR AS mon, n_name AS county,
         CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE c_mktsegment END AS town,
         CASE WHEN c_mktsegment = 'BUILDING' OR o_orderstatus = 'P' THEN ''
              ELSE (n_nationkey + 10001)::VARCHAR || left(c_mktsegment, 1) END AS town_code,
         CASE WHEN o_orderstatus = 'O' THEN 'M' WHEN o_orderstatus = 'F' THEN 'F'
              WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'X' END AS gender,
         CASE o_orderpriority WHEN '1-URGENT' THEN '0' WHEN '2-HIGH' THEN '1~4'
              WHEN '3-MEDIUM' THEN '30-34' WHEN '4-NOT SPECIFIED' THEN '不詳' ELSE '70+' END AS age,
         CASE WHEN o_totalprice > 300000 THEN '1' ELSE '0' END AS imported,
         CASE o_orderstatus WHEN 'F' THEN floor(o_totalprice / 2000)::BIGINT::VARCHAR ELSE '0' END AS n
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
src_dengue AS (
  SELECT CASE l_linestatus WHEN 'F' THEN strftime(l_shipdate, '%Y/%-m/%-d')
              ELSE strftime(l_shipdate, '%Y/%m/%d') END AS onset,
         CASE l_returnflag WHEN 'N' THEN ''
              ELSE strftime(l_shipdate + INTERVAL 3 DAY, '%Y/%m/%d') END AS determined,
         CASE l_returnflag WHEN 'A' THEN '' ELSE strftime(o_orderdate, '%Y/%-m/%-d') END AS reported,
         CASE l_returnflag WHEN 'A' THEN 'M' WHEN 'R' THEN 'F' ELSE 'X' END AS gender,
         CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '1~4' WHEN 3 THEN '5-14' WHEN 4 THEN '30-34'
              WHEN 5 THEN '65+' WHEN 6 THEN '不詳' ELSE '70+' END AS age,
         CASE WHEN c_mktsegment = 'MACHINERY' AND l_linestatus = 'O' AND l_returnflag = 'N' THEN ''
              ELSE home.n_name END AS home_county,
         CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE c_mktsegment END AS home_town,
         CASE WHEN l_returnflag = 'R' THEN '' WHEN l_linenumber = 7 THEN 'OFFSHORE'
              ELSE away.n_name END AS inf_county,
         CASE l_linestatus WHEN 'O' THEN 'HARBOUR' ELSE '' END AS inf_town,
         CASE l_returnflag WHEN 'R' THEN '是' ELSE '否' END AS imported,
         CASE l_returnflag WHEN 'R' THEN away.n_name ELSE '' END AS country,
         CASE l_linenumber WHEN 1 THEN '第一型' WHEN 2 THEN '第二型' WHEN 3 THEN '第三型'
              WHEN 4 THEN '第四型' ELSE '' END AS serotype,
         CASE l_linestatus WHEN 'O' THEN '' ELSE '120.' || lpad((l_partkey % 100)::VARCHAR, 2, '0') END AS x,
         CASE WHEN l_linestatus = 'O' OR l_linenumber = 7 THEN ''
              ELSE '22.' || lpad((l_suppkey % 100)::VARCHAR, 2, '0') END AS y,
         CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN '1' ELSE '0' END AS n
  FROM lineitem
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation away ON away.n_nationkey = s_nationkey
  JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation home ON home.n_nationkey = c_nationkey)"""

STAGED = """
stg_nhi AS (
  SELECT code AS disease_code, yr AS iso_year, wk AS iso_week, kind AS visit_type,
         replace(age, '~', '-') AS age_label, county AS county_name,
         TRY_CAST(n AS INTEGER) AS visit_count, TRY_CAST(n_all AS INTEGER) AS total_visit_count
  FROM (SELECT 'FLU' AS code, * FROM src_flu UNION ALL SELECT 'EV', * FROM src_ev)),
stg_covid AS (
  SELECT TRY_CAST(yr AS INTEGER) AS onset_year, TRY_CAST(mon AS INTEGER) AS onset_month,
         county AS county_name, town AS town_name,
         coalesce((SELECT g FROM (VALUES ('M'), ('F')) known(g) WHERE g = gender), 'U') AS gender_code,
         replace(age, '~', '-') AS age_label, imported = '1' AS is_imported,
         TRY_CAST(n AS INTEGER) AS case_count
  FROM src_covid),
stg_dengue AS (
  SELECT strptime(onset, '%Y/%m/%d')::DATE AS onset_date,
         strptime(nullif(determined, ''), '%Y/%m/%d')::DATE AS determined_date,
         strptime(nullif(reported, ''), '%Y/%m/%d')::DATE AS reported_date,
         coalesce((SELECT g FROM (VALUES ('M'), ('F')) known(g) WHERE g = gender), 'U') AS gender_code,
         replace(age, '~', '-') AS age_label,
         home_county AS res_county, home_town AS res_town, inf_county, inf_town,
         imported = '是' AS is_imported, nullif(country, '') AS infection_country,
         nullif(serotype, '') AS serotype,
         TRY_CAST(nullif(x, '') AS DOUBLE) AS centroid_x, TRY_CAST(nullif(y, '') AS DOUBLE) AS centroid_y,
         TRY_CAST(n AS INTEGER) AS case_count
  FROM src_dengue)"""

DIMS = """
dim_disease(disease_key, disease_code, disease_name, disease_category) AS (
  VALUES (1, 'FLU', '流感', '第四類法定傳染病'), (2, 'EV', '腸病毒感染併發重症', '第三類法定傳染病'),
         (3, '19CoV', '嚴重特殊傳染性肺炎', '第五類法定傳染病'), (4, 'DENGUE', '登革熱', '第二類法定傳染病')),
dim_gender(gender_key, gender_code, gender_label) AS (
  VALUES (1, 'M', '男'), (2, 'F', '女'), (3, 'U', '不詳')),
dim_date AS (
  SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INTEGER AS date_key, d AS full_date,
         year(d)::SMALLINT AS year, quarter(d)::TINYINT AS quarter, month(d)::TINYINT AS month,
         day(d)::TINYINT AS day, isoyear(d)::SMALLINT AS iso_year, week(d)::TINYINT AS iso_week,
         isodow(d)::TINYINT AS day_of_week, day(d) = 1 AS is_month_start, isodow(d) = 1 AS is_iso_week_start
  FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2026-12-31', INTERVAL 1 DAY))::DATE AS d)),
labels AS (
  SELECT age_label FROM stg_nhi UNION SELECT age_label FROM stg_covid UNION SELECT age_label FROM stg_dengue),
dim_age_group AS (
  SELECT (row_number() OVER (ORDER BY age_label))::INTEGER AS age_key, age_label,
         nullif(regexp_extract(age_label, '^([0-9]+)(-[0-9]+|[+])?$', 1), '')::SMALLINT AS age_lower,
         nullif(regexp_extract(age_label, '^([0-9]+-)?([0-9]+)$', 2), '')::SMALLINT AS age_upper
  FROM labels),
county_map AS (SELECT DISTINCT county_code, county AS county_name FROM src_flu),
town_names AS (
  SELECT county, town, max(code) AS code
  FROM (SELECT county, town, town_code AS code FROM src_covid
        UNION ALL SELECT home_county, home_town, '' FROM src_dengue
        UNION ALL SELECT inf_county, inf_town, '' FROM src_dengue)
  WHERE town <> '' AND county <> '' GROUP BY ALL),
places AS (
  SELECT county_code, county_name, '' AS town_code, '' AS town_name, 'county' AS geo_level FROM county_map
  UNION ALL VALUES ('00000', '未知', '', '', 'county')
  UNION ALL SELECT county_code, county_name, code, town, 'town'
            FROM town_names JOIN county_map ON county_name = county),
dim_geography AS (
  SELECT row_number() OVER (ORDER BY county_name, town_name) AS geo_key, * FROM places)"""

LOADED = """
fact_nhi_visits AS (
  SELECT row_number() OVER () AS visit_id,
         (year(monday) * 10000 + month(monday) * 100 + day(monday))::INTEGER AS date_key,
         geo_key, disease_key, age_key, visit_type, 'WEEKLY' AS period_type,
         iso_year::SMALLINT AS iso_year, iso_week::TINYINT AS iso_week, visit_count, total_visit_count
  FROM (SELECT *, date_trunc('week', make_date(iso_year::INTEGER, 1, 4))::DATE
                  + 7 * (iso_week::INTEGER - 1) AS monday FROM stg_nhi)
  JOIN dim_disease USING (disease_code) JOIN dim_age_group USING (age_label)
  JOIN (SELECT geo_key, county_name FROM dim_geography WHERE town_name = '') USING (county_name)),
fact_covid_cases AS (
  SELECT row_number() OVER () AS covid_id, onset_year * 10000 + onset_month * 100 + 1 AS date_key,
         geo_key, 3 AS disease_key, age_key, gender_key, 'MONTHLY' AS period_type,
         onset_year::SMALLINT AS onset_year, onset_month::TINYINT AS onset_month, is_imported, case_count
  FROM stg_covid JOIN dim_geography USING (county_name, town_name)
  JOIN dim_age_group USING (age_label) JOIN dim_gender USING (gender_code)),
fact_dengue_cases AS (
  SELECT row_number() OVER () AS dengue_case_id,
         strftime(onset_date, '%Y%m%d')::INTEGER AS onset_date_key,
         strftime(determined_date, '%Y%m%d')::INTEGER AS determined_date_key,
         strftime(reported_date, '%Y%m%d')::INTEGER AS reported_date_key,
         home.geo_key AS residence_geo_key, away.geo_key AS infection_geo_key,
         4 AS disease_key, age_key, gender_key, is_imported, infection_country, serotype,
         centroid_x, centroid_y, case_count, year(onset_date)::SMALLINT AS onset_year
  FROM stg_dengue JOIN dim_age_group USING (age_label) JOIN dim_gender USING (gender_code)
  JOIN dim_geography home ON (home.county_name, home.town_name) =
       (CASE res_county WHEN '' THEN '未知' ELSE res_county END, CASE res_county WHEN '' THEN '' ELSE res_town END)
  LEFT JOIN dim_geography away
       ON inf_county <> '' AND away.county_name = inf_county AND away.town_name = inf_town)"""

WEEKLY = """
agg_weekly AS (
  SELECT disease_code, disease_name, county_name, isoyear(monday)::INTEGER AS iso_year,
         week(monday)::INTEGER AS iso_week, monday AS week_start_date,
         sum(n)::BIGINT AS metric_value, sum(n_all)::BIGINT AS denominator
  FROM (SELECT disease_key, geo_key, date_key, visit_count AS n, total_visit_count AS n_all FROM fact_nhi_visits
        UNION ALL
        SELECT disease_key, residence_geo_key, onset_date_key, case_count, NULL FROM fact_dengue_cases)
  JOIN dim_disease USING (disease_key) JOIN dim_geography USING (geo_key)
  JOIN (SELECT date_key, date_trunc('week', full_date)::DATE AS monday FROM dim_date) USING (date_key)
  GROUP BY ALL),
shown AS (SELECT county_name FROM dim_geography WHERE geo_level = 'county' AND county_name <> '未知'),
weeks AS (
  SELECT DISTINCT isoyear(full_date)::INTEGER AS iso_year, week(full_date)::INTEGER AS iso_week,
         date_trunc('week', full_date)::DATE AS week_start_date FROM dim_date),
weekly_dense AS (
  SELECT r.disease_code, r.disease_name, county_name, w.iso_year, w.iso_week, week_start_date,
         coalesce(a.metric_value, 0) AS metric_value, a.denominator
  FROM (SELECT disease_code, disease_name, min(week_start_date) AS lo, max(week_start_date) AS hi
        FROM agg_weekly GROUP BY ALL) r
  JOIN weeks w ON w.week_start_date >= lo AND w.week_start_date <= hi
  CROSS JOIN shown
  LEFT JOIN (SELECT disease_code, county_name, week_start_date, metric_value, denominator FROM agg_weekly) a
       USING (disease_code, county_name, week_start_date)),
weekly_trend AS (
  SELECT disease_code, disease_name, county_name, iso_year, iso_week, week_start_date, metric_value,
         round(metric_value::DOUBLE / nullif(denominator, 0), 5) AS visit_rate,
         round(mean4, 1) AS ma4, round(mean8, 1) AS ma8, before AS prev_week,
         metric_value - before AS wow_change,
         round(100.0 * (metric_value - before) / nullif(before, 0), 1) AS wow_growth_pct
  FROM (SELECT *, lag(metric_value) OVER line AS before,
               avg(metric_value) OVER (line ROWS 3 PRECEDING) AS mean4,
               avg(metric_value) OVER (line ROWS 7 PRECEDING) AS mean8
        FROM weekly_dense
        WINDOW line AS (PARTITION BY disease_code, county_name ORDER BY week_start_date))),
weekly_rank AS (
  SELECT disease_code, disease_name, county_name, iso_year, iso_week, week_start_date, metric_value,
         (rank() OVER (grp ORDER BY metric_value DESC))::INTEGER AS county_rank,
         round(100.0 * metric_value / nullif(sum(metric_value) OVER grp, 0), 1) AS pct_of_national
  FROM weekly_dense WINDOW grp AS (PARTITION BY disease_code, week_start_date))"""

MONTHLY = """
agg_monthly AS (
  SELECT county_name, onset_year::INTEGER AS onset_year, onset_month::INTEGER AS onset_month,
         make_date(onset_year, onset_month, 1) AS month_start, sum(case_count)::BIGINT AS cases
  FROM fact_covid_cases JOIN dim_geography USING (geo_key) GROUP BY ALL),
counties AS (SELECT county_name FROM dim_geography WHERE geo_level = 'county' AND county_name <> '未知'),
months AS (
  SELECT unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH))::DATE AS month_start
  FROM agg_monthly),
monthly_dense AS (
  SELECT county_name, year(month_start)::INTEGER AS onset_year, month(month_start)::INTEGER AS onset_month,
         month_start, coalesce(cases, 0) AS cases
  FROM months CROSS JOIN counties
  LEFT JOIN (SELECT county_name, month_start, cases FROM agg_monthly) USING (county_name, month_start)),
monthly_trend AS (
  SELECT county_name, onset_year, onset_month, month_start, cases, round(mean3, 1) AS ma3,
         before AS prev_month, cases - before AS mom_change,
         round(100.0 * (cases - before) / nullif(before, 0), 1) AS mom_growth_pct
  FROM (SELECT *, lag(cases) OVER line AS before, avg(cases) OVER (line ROWS 2 PRECEDING) AS mean3
        FROM monthly_dense WINDOW line AS (PARTITION BY county_name ORDER BY month_start))),
monthly_rank AS (
  SELECT county_name, onset_year, onset_month, month_start, cases,
         (rank() OVER (grp ORDER BY cases DESC))::INTEGER AS county_rank,
         round(100.0 * cases / nullif(sum(cases) OVER grp, 0), 1) AS pct_of_national
  FROM monthly_dense WINDOW grp AS (PARTITION BY month_start))"""

ORDERS_PANEL = """
sparse AS (
  SELECT o_orderpriority, n_name, date_trunc('week', o_orderdate)::DATE AS week_start_date,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS metric_value, count(*) AS denominator
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
dense AS (
  SELECT o_orderpriority, n_name, week_start_date, coalesce(metric_value, 0) AS metric_value, denominator
  FROM (SELECT o_orderpriority, unnest(generate_series(min(week_start_date), max(week_start_date),
               INTERVAL 7 DAY))::DATE AS week_start_date FROM sparse GROUP BY 1)
  CROSS JOIN (SELECT n_name FROM nation)
  LEFT JOIN sparse USING (o_orderpriority, n_name, week_start_date))"""

ORDER_POINTS = """
points AS (
  SELECT o_orderkey, year(o_orderdate)::INTEGER AS onset_year,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN 22 + (o_custkey % 1000) / 1000.0::DOUBLE END AS lat,
         CASE WHEN o_orderstatus <> 'P' THEN 120 + (o_orderkey % 1000) / 1000.0::DOUBLE END AS lon
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

FACT_LAYERS = (SOURCES, STAGED, DIMS, LOADED)
WEEKLY_LAYERS = (*FACT_LAYERS, WEEKLY)
MONTHLY_LAYERS = (*FACT_LAYERS, MONTHLY)


def on(layers: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(layers) + "\n" + select


def _columns_but_id(fact: str) -> str:
    return ", ".join(columns(fact)[1:])


def _unique() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{t}({", ".join(key)}) unique' AS "constraint", count(*) AS violations
FROM (SELECT 1 FROM {t} GROUP BY {", ".join(key)} HAVING count(*) > 1)"""
        for t in DIMENSIONS + FACTS
        for key in UNIQUE[t]
    )


def _not_null() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{t}.{c} not null' AS "constraint", count(*) AS violations FROM {t} WHERE {c} IS NULL"""
        for t in DIMENSIONS + FACTS
        for c in columns(t)
        if c not in NULLABLE.get(t, ())
    )


def _references() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{t}.{c} references {dim}' AS "constraint", count(DISTINCT {c}) AS violations
FROM {t} WHERE {c} NOT IN (SELECT {key} FROM {dim})"""
        for t, refs in REFERENCES.items()
        for c, (dim, key) in refs.items()
    )


def _landed() -> str:
    pairs = (
        ("fact_nhi_visits", "stg_nhi"), ("fact_covid_cases", "stg_covid"), ("fact_dengue_cases", "stg_dengue")
    )
    return "\nUNION ALL ".join(
        f"""SELECT '{f} rows landed' AS "check", (SELECT count(*) FROM {f}) = (SELECT count(*) FROM {s}) AS ok"""
        for f, s in pairs
    )


def _report() -> str:
    """Every check, the rows of every table and the sum of every disease, as text."""
    constraints = "\nUNION ALL ".join((_unique(), _not_null(), _references()))
    rows = "\nUNION ALL ".join(f"SELECT 'rows', '{t}', count(*)::VARCHAR FROM {t}" for t in DIMENSIONS + FACTS)
    return f"""SELECT 'check' AS section, "check" AS name, CASE WHEN ok THEN 'true' ELSE 'false' END AS value FROM (
{_landed()}
UNION ALL SELECT 'no negative visit_count', count(*) = 0 FROM fact_nhi_visits WHERE visit_count < 0
UNION ALL SELECT 'some cases geocoded', count(centroid_x) > 0 FROM fact_dengue_cases
UNION ALL SELECT "constraint", violations = 0 FROM ({constraints}))
UNION ALL {rows}
UNION ALL SELECT 'disease', disease_name, sum(metric_value)::BIGINT::VARCHAR FROM agg_weekly GROUP BY disease_name"""


RAW_NAMES = {
    "flu": "yr AS 年, wk AS 週, kind AS 就診類別, age AS 年齡別, county AS 縣市, county_code AS 縣市別代碼, "
    "n AS 類流感健保就診人次, n_all AS 健保就診總人次",
    "dengue": "onset AS 發病日, determined AS 個案研判日, reported AS 通報日, gender AS 性別, age AS 年齡層, "
    "home_county AS 居住縣市, home_town AS 居住鄉鎮, inf_county AS 感染縣市, inf_town AS 感染鄉鎮, "
    "imported AS 是否境外移入, country AS 感染國家, serotype AS 血清型, "
    "x AS 最小統計區中心點X, y AS 最小統計區中心點Y, n AS 確定病例數",
}


def _profile(source: str, names: dict[str, str]) -> str:
    cells = " UNION ALL ".join(f"SELECT '{label}' AS column_name, {c} AS value FROM {source}" for label, c in names.items())
    return f"SELECT column_name, value FROM ({cells})"


FLU_PROFILE = {"就診類別": "kind", "年齡別": "age", "縣市": "county", "週": "wk"}
COVID_PROFILE = {"性別": "gender", "是否為境外移入": "imported", "年齡層": "age", "縣市": "county", "發病月份": "mon"}
DENGUE_PROFILE = {
    "性別": "gender", "是否境外移入": "imported", "年齡層": "age", "居住縣市": "home_county",
    "血清型": "serotype", "最小統計區中心點X": "x", "最小統計區中心點Y": "y",
}

LINE = "disease_code = 'DENGUE' AND county_name = 'NATION_3'"


def statements() -> dict[str, str]:
    """SQL per registered query."""
    w, m, f = WEEKLY_LAYERS, MONTHLY_LAYERS, FACT_LAYERS
    dims = (SOURCES, STAGED, DIMS)
    located = "fact_dengue_cases WHERE centroid_x IS NOT NULL"
    sql = {
        # Panels straight on the tables.
        "orders_weekly_trend": on(
            (ORDERS_PANEL,),
            """SELECT o_orderpriority, n_name, isoyear(week_start_date)::INTEGER AS iso_year,
  week(week_start_date)::INTEGER AS iso_week, week_start_date, metric_value,
  round(metric_value::DOUBLE / nullif(denominator, 0), 5) AS visit_rate,
  round(avg(metric_value) OVER (line ROWS 3 PRECEDING), 1) AS ma4,
  round(avg(metric_value) OVER (line ROWS 7 PRECEDING), 1) AS ma8,
  lag(metric_value) OVER line AS prev_week, metric_value - lag(metric_value) OVER line AS wow_change,
  round(100.0 * (metric_value - lag(metric_value) OVER line) / nullif(lag(metric_value) OVER line, 0), 1)
    AS wow_growth_pct
FROM dense WINDOW line AS (PARTITION BY o_orderpriority, n_name ORDER BY week_start_date)""",
        ),
        "orders_weekly_rank": on(
            (ORDERS_PANEL,),
            """SELECT o_orderpriority, n_name, week_start_date, metric_value,
  (rank() OVER (PARTITION BY o_orderpriority, week_start_date ORDER BY metric_value DESC))::INTEGER AS nation_rank,
  round(100.0 * metric_value
        / nullif(sum(metric_value) OVER (PARTITION BY o_orderpriority, week_start_date), 0), 1) AS pct_of_total
FROM dense""",
        ),
        "orders_weekly_rank_wide": on(
            (ORDERS_PANEL,),
            """SELECT o_orderpriority, n_name, week_start_date, metric_value,
  (rank() OVER (PARTITION BY o_orderpriority, week_start_date ORDER BY metric_value DESC))::INTEGER AS nation_rank,
  round(100.0 * metric_value
        / nullif(sum(metric_value) OVER (PARTITION BY o_orderpriority, week_start_date), 0), 1) AS pct_of_total
FROM dense""",
        ),
        "lines_split_join": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, s_name
FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
        "order_days": on(
            (DIMS.split("labels AS")[0].rstrip().rstrip(","),),
            "SELECT * FROM dim_date WHERE full_date IN (SELECT o_orderdate::DATE FROM orders)",
        ),
        "order_weeks": """SELECT DISTINCT isoyear(o_orderdate)::INTEGER AS iso_year, week(o_orderdate)::INTEGER AS iso_week,
  date_trunc('week', o_orderdate)::DATE AS week_start_date FROM orders""",
        "order_points_grid": on(
            (ORDER_POINTS,),
            """SELECT onset_year, round(lat, 2) AS lat, round(lon, 2) AS lon, count(*) AS n_points
FROM points WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY ALL""",
        ),
        "order_points_sample": on(
            (ORDER_POINTS,),
            """SELECT o_orderkey, onset_year, lat, lon FROM points WHERE lat IS NOT NULL AND lon IS NOT NULL
ORDER BY md5('0:' || o_orderkey::VARCHAR) LIMIT 5000""",
        ),
        # Ingestion.
        "ingested_flu": on((SOURCES,), f"SELECT {RAW_NAMES['flu']} FROM src_flu"),
        "ingested_dengue": on((SOURCES,), f"SELECT {RAW_NAMES['dengue']} FROM src_dengue"),
        "ingest_report": on(
            (SOURCES,),
            """SELECT 'nhi_influenza_like_illness' AS name, '流感' AS disease, count(*) AS rows, 10 AS cols FROM src_flu
UNION ALL SELECT 'nhi_enteroviral_infection', '腸病毒', count(*), 10 FROM src_ev
UNION ALL SELECT 'covid_age_county_gender', 'COVID-19', count(*), 11 FROM src_covid
UNION ALL SELECT 'dengue_daily', '登革熱', count(*), 17 FROM src_dengue""",
        ),
        # Staging, dimensions, facts.
        "stg_nhi": on((SOURCES, STAGED), "SELECT * FROM stg_nhi"),
        "stg_covid": on((SOURCES, STAGED), "SELECT * FROM stg_covid"),
        "ingested_documents": """SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source, n_chars FROM documents""",
        "raw_history": """SELECT c_custkey::VARCHAR AS c_custkey, c_name, '' AS c_mktsegment, 'v1' AS ingest_ts FROM customer
UNION ALL SELECT c_custkey::VARCHAR, '', c_mktsegment, 'v2' FROM customer""",
        "newest_without_snapshot": "SELECT c_custkey::VARCHAR AS c_custkey, c_mktsegment FROM customer",
        "fallback_lineage": """SELECT n_nationkey::INTEGER AS n_nationkey, n_name, 'files' AS read_from,
  true AS primary_failed FROM nation""",
        "rebuilt_rows": """SELECT f AS fact, CASE WHEN n >= 0 THEN 0::BIGINT END AS different
FROM (SELECT 'fact_nhi_visits' AS f, count(*) AS n FROM orders UNION ALL SELECT 'fact_covid_cases', count(*) FROM orders
      UNION ALL SELECT 'fact_dengue_cases', count(*) FROM lineitem)""",
        "stg_dengue": on((SOURCES, STAGED), "SELECT * FROM stg_dengue"),
        "county_map": on(dims, "SELECT county_code, county_name FROM county_map"),
        "dim_age_group": on(dims, "SELECT * FROM dim_age_group"),
        "dim_geography": on(dims, "SELECT * FROM dim_geography"),
        **{fact: on(f, f"SELECT {_columns_but_id(fact)} FROM {fact}") for fact in FACTS},
        # Analytic layers.
        "agg_weekly": on(w, "SELECT * FROM agg_weekly"),
        "weekly_dense": on(w, "SELECT * FROM weekly_dense"),
        "weekly_trend": on(w, "SELECT * FROM weekly_trend"),
        "weekly_rank": on(w, "SELECT * FROM weekly_rank"),
        "agg_monthly": on(m, "SELECT * FROM agg_monthly"),
        "monthly_dense": on(m, "SELECT * FROM monthly_dense"),
        "monthly_trend": on(m, "SELECT * FROM monthly_trend"),
        "monthly_rank": on(m, "SELECT * FROM monthly_rank"),
        # Query API.
        "observed_diseases": on(
            f,
            """SELECT disease_code, disease_name FROM dim_disease WHERE disease_key IN (
  SELECT disease_key FROM fact_nhi_visits UNION SELECT disease_key FROM fact_covid_cases
  UNION SELECT disease_key FROM fact_dengue_cases) ORDER BY disease_key""",
        ),
        "counties": on(w, "SELECT county_name FROM shown ORDER BY county_name"),
        "county_count": on(w, "SELECT count(*) AS counties FROM shown"),
        "trend_line": on(
            w,
            f"""SELECT week_start_date, metric_value, ma4, ma8, wow_growth_pct FROM weekly_trend
WHERE {LINE} ORDER BY week_start_date""",
        ),
        "line_by_sql": on(
            w,
            """SELECT week_start_date, metric_value, ma4, ma8, wow_growth_pct FROM weekly_trend
WHERE disease_code = 'FLU' AND county_name = 'NATION_3' ORDER BY week_start_date""",
        ),
        "kpis": on(
            w,
            f"""SELECT max_by(metric_value, week_start_date) AS latest_value, max(week_start_date) AS latest_week,
  arg_max_null(wow_growth_pct, week_start_date) AS latest_wow, max_by(ma4, week_start_date) AS latest_ma4,
  max(metric_value) AS peak_value,
  (SELECT week_start_date FROM weekly_trend WHERE {LINE}
   ORDER BY metric_value DESC, week_start_date LIMIT 1) AS peak_week,
  sum(metric_value)::BIGINT AS total_value
FROM weekly_trend WHERE {LINE}""",
        ),
        "kpis_of_no_line": on(
            w,
            """SELECT max(metric_value) AS latest_value, max(week_start_date) AS latest_week,
  max(wow_growth_pct) AS latest_wow, max(ma4) AS latest_ma4, max(metric_value) AS peak_value,
  max(week_start_date) AS peak_week, sum(metric_value)::BIGINT AS total_value
FROM weekly_trend WHERE disease_code = 'DENGUE' AND county_name = 'NOWHERE'""",
        ),
        "disease_weeks": on(
            w, "SELECT DISTINCT week_start_date FROM weekly_dense WHERE disease_code = 'FLU' ORDER BY 1"
        ),
        "rank_in_week": on(
            w,
            """SELECT county_name, metric_value, county_rank, pct_of_national FROM weekly_rank
WHERE disease_code = 'EV' AND week_start_date = DATE '1998-03-02' ORDER BY county_rank, county_name""",
        ),
        "month_line": on(
            m,
            """SELECT month_start, cases, ma3, mom_growth_pct FROM monthly_trend
WHERE county_name = 'NATION_7' ORDER BY month_start""",
        ),
        "points": on(
            f,
            f"""SELECT centroid_y AS lat, centroid_x AS lon, onset_year FROM {located} AND centroid_y IS NOT NULL""",
        ),
        "points_of_year": on(
            f,
            f"""SELECT centroid_y AS lat, centroid_x AS lon, onset_year FROM {located} AND centroid_y IS NOT NULL
AND onset_year = 1998""",
        ),
        "point_years": on(f, f"SELECT DISTINCT onset_year FROM {located} ORDER BY 1"),
        "point_top_year": on(
            f,
            f"""SELECT onset_year, count(*) AS n_cases FROM {located}
GROUP BY 1 ORDER BY n_cases DESC, onset_year LIMIT 1""",
        ),
        "point_sample": on(
            f,
            f"""SELECT lat, lon FROM (
  SELECT centroid_y AS lat, centroid_x AS lon, onset_date_key,
         row_number() OVER (PARTITION BY centroid_y, centroid_x, onset_date_key) AS occurrence
  FROM {located} AND centroid_y IS NOT NULL AND onset_year = 1998)
ORDER BY md5(concat_ws(':', '0', lat::VARCHAR, lon::VARCHAR, onset_date_key::VARCHAR, occurrence::VARCHAR)) LIMIT 100""",
        ),
        "point_density": on(
            f,
            f"""SELECT round(centroid_y, 1) AS lat, round(centroid_x, 1) AS lon, count(*) AS n_points
FROM {located} AND centroid_y IS NOT NULL GROUP BY ALL""",
        ),
        "fact_total": on(
            f,
            """SELECT (SELECT count(*) FROM fact_nhi_visits) + (SELECT count(*) FROM fact_covid_cases)
  + (SELECT count(*) FROM fact_dengue_cases) AS facts""",
        ),
        "onset_span": on(
            f,
            """SELECT min(full_date) AS first_onset, max(full_date) AS last_onset,
  (year(max(full_date)) - year(min(full_date)))::INTEGER AS years
FROM dim_date WHERE date_key IN (SELECT onset_date_key FROM fact_dengue_cases)""",
        ),
        "peak_year": on(
            w,
            f"""SELECT iso_year, max(metric_value) AS peak_value FROM weekly_trend WHERE {LINE}
GROUP BY 1 ORDER BY peak_value DESC, iso_year LIMIT 1""",
        ),
        "peak_month": on(
            m,
            """SELECT onset_year, onset_month, sum(cases)::BIGINT AS total_cases FROM monthly_trend
GROUP BY 1, 2 ORDER BY total_cases DESC, onset_year, onset_month LIMIT 1""",
        ),
        "peak_week_ranking": on(
            w,
            """SELECT week_start_date, county_name, metric_value, county_rank, pct_of_national FROM weekly_rank
WHERE disease_code = 'DENGUE' AND week_start_date = (
  SELECT week_start_date FROM weekly_dense WHERE disease_code = 'DENGUE' AND year(week_start_date) = 1998
  GROUP BY 1 ORDER BY sum(metric_value) DESC, week_start_date LIMIT 1)
ORDER BY county_rank, county_name""",
        ),
        "curve": on(
            w,
            f"""SELECT iso_week, metric_value AS cases, ma4, wow_growth_pct FROM weekly_trend
WHERE {LINE} AND iso_year = 1999 AND iso_week BETWEEN 34 AND 44 ORDER BY iso_week""",
        ),
        "top_counties_in_week": on(
            w,
            """SELECT county_name, metric_value AS cases, county_rank, pct_of_national FROM weekly_rank
WHERE disease_code = 'DENGUE' AND iso_year = 1999 AND iso_week = 40 ORDER BY county_rank, county_name LIMIT 5""",
        ),
        "steepest_months": on(
            m,
            """SELECT county_name, month_start, cases, ma3, mom_growth_pct FROM monthly_trend WHERE prev_month >= 100
ORDER BY mom_growth_pct DESC, month_start, county_name LIMIT 5""",
        ),
        "top_counties_latest_month": on(
            m,
            """SELECT county_name, cases, county_rank, pct_of_national FROM monthly_rank
WHERE month_start = (SELECT max(month_start) FROM monthly_rank) ORDER BY county_rank, county_name LIMIT 5""",
        ),
        "rank_bars": on(
            w,
            """SELECT county_name, metric_value, county_rank, pct_of_national, county_name = 'NATION_3' AS selected
FROM weekly_rank WHERE disease_code = 'FLU' AND week_start_date = DATE '1998-03-02'
ORDER BY county_rank, county_name LIMIT 15""",
        ),
        "growth_bars": on(
            w,
            f"""SELECT week_start_date, wow_growth_pct, CASE WHEN wow_growth_pct >= 0 THEN 'up' ELSE 'down' END AS direction
FROM weekly_trend WHERE {LINE} AND wow_growth_pct IS NOT NULL ORDER BY week_start_date""",
        ),
        # Quality.
        "unique_constraints": on(f, _unique()),
        "not_null_constraints": on(f, _not_null()),
        "reference_constraints": on(f, _references()),
        "rows_landed": on(f, _landed()),
        "plausible_measures": on(
            f,
            """SELECT 'no negative visit_count' AS "check", count(*) = 0 AS ok FROM fact_nhi_visits WHERE visit_count < 0
UNION ALL SELECT 'some cases geocoded', count(centroid_x) > 0 FROM fact_dengue_cases""",
        ),
        "row_counts": on(
            f,
            "\nUNION ALL ".join(
                f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in DIMENSIONS + FACTS
            ),
        ),
        "geography_sizes": on(
            dims,
            """SELECT count(*) FILTER (WHERE geo_level = 'county') AS counties,
  count(*) FILTER (WHERE geo_level = 'town') AS towns FROM dim_geography""",
        ),
        "geocoded_share": on(
            f, "SELECT round(100.0 * count(centroid_x) / count(*), 1) AS geocoded_pct FROM fact_dengue_cases"
        ),
        "top_counties_by_visits": on(
            f,
            """SELECT county_name, sum(visit_count)::BIGINT AS visits FROM fact_nhi_visits JOIN dim_geography USING (geo_key)
WHERE disease_key = 1 GROUP BY 1 ORDER BY visits DESC, county_name LIMIT 3""",
        ),
        "sparse_and_dense_rows": on(
            w,
            """SELECT 'sparse' AS layer, count(*) AS n_rows FROM agg_weekly
UNION ALL SELECT 'dense', count(*) FROM weekly_dense""",
        ),
        "recomputed_mean": on(
            w,
            """SELECT count(*) AS n_rows, count(*) FILTER (WHERE ma4 = again) AS matching
FROM (SELECT ma4, round(avg(metric_value) OVER (ORDER BY week_start_date ROWS 3 PRECEDING), 1) AS again
      FROM weekly_trend WHERE disease_code = 'FLU' AND county_name = 'NATION_3' AND iso_year = 1999)""",
        ),
        # Profiles of the raw text.
        "labels_by_sql": on(
            (SOURCES, STAGED), "SELECT age_label, gender_code, count(*) AS n_rows FROM stg_dengue GROUP BY ALL"
        ),
        "onsets_by_sql": on(
            dims,
            """SELECT isoyear(onset_date)::INTEGER AS iso_year, week(onset_date)::INTEGER AS iso_week,
  count(*) AS n_rows, count(county_code) AS n_mapped
FROM stg_dengue LEFT JOIN county_map ON county_name = res_county GROUP BY 1, 2""",
        ),
        "flu_values": on(
            (SOURCES,), f"SELECT column_name, value, count(*) AS n_rows FROM ({_profile('src_flu', FLU_PROFILE)}) GROUP BY ALL"
        ),
        "covid_values": on(
            (SOURCES,),
            f"SELECT column_name, value, count(*) AS n_rows FROM ({_profile('src_covid', COVID_PROFILE)}) GROUP BY ALL",
        ),
        "dengue_extent": on(
            (SOURCES,),
            f"""SELECT column_name, min(value) AS min_value, max(value) AS max_value, count(DISTINCT value) AS n_distinct,
  count(*) FILTER (WHERE value IS NULL OR value = '') AS n_blank, count(*) AS n_rows
FROM ({_profile('src_dengue', DENGUE_PROFILE)}) GROUP BY 1""",
        ),
        "dengue_extent_sketched": on(
            (SOURCES,),
            f"""SELECT column_name, count(DISTINCT value) AS n_distinct, true AS within_bound
FROM ({_profile('src_dengue', {**DENGUE_PROFILE, "發病日": "onset"})}) GROUP BY 1""",
        ),
        "quality_report": on(w, _report()),
        "copied_snapshot": "SELECT c_custkey::VARCHAR AS c_custkey, c_name, true AS in_copy FROM customer",
        "onset_lengths": on((SOURCES,), "SELECT length(onset)::INTEGER AS len, count(*) AS n_rows FROM src_dengue GROUP BY 1"),
        "shortest_onsets": on(
            (SOURCES,),
            """SELECT onset AS value, count(*) AS n_rows FROM src_dengue WHERE length(onset) < 10
GROUP BY 1 ORDER BY 1 LIMIT 10""",
        ),
        "county_name_variants": on(
            (SOURCES,),
            """SELECT 'flu' AS src, county AS value FROM src_flu WHERE county LIKE '%_2_'
UNION SELECT 'covid', county FROM src_covid WHERE county LIKE '%_2_'
UNION SELECT 'dengue', home_county FROM src_dengue WHERE home_county LIKE '%_2_'""",
        ),
        "county_names": on(
            (SOURCES,),
            """SELECT DISTINCT county_name FROM (
  SELECT county AS county_name FROM src_flu UNION ALL SELECT county FROM src_covid
  UNION ALL SELECT home_county FROM src_dengue) WHERE county_name <> ''""",
        ),
    }
    return sql
