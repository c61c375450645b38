"""Every query by name: the Spark side, and the DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.catalog import binding as b
from skybasin.catalog import oracle as o
from skybasin.functions.rounding import steady_avg
from skybasin.operators import cleaning, gold, quality, watermarks
from skybasin.operators.joining import join_sources, source_keys
from skybasin.operators.latest import latest_rows
from skybasin.operators.upsert import last_write, upsert
from skybasin.plans import alerts, bi, dashboards, flows
from skybasin.schemas import RAW, TABLES
from skybasin.session import working_dir
from skybasin.sources import files, messages, payloads, reference
from skybasin.sources.tables import TableStore
from skybasin.streaming.bronze import ingest_batch, start_ingest
from skybasin.streaming.silver import start_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ORDER = ["_ingested_at", "message_id"]
MID_MONTH = "2024-01-15"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


# --- The layers over the test tables ------------------------------------------


def checked(spark: SparkSession, sf_dir: str, source: str, wide: bool = False) -> DataFrame:
    return cleaning.CHECKS[source](b.bronze(spark, sf_dir, source, wide), b.RUN_TS)


def silver(spark: SparkSession, sf_dir: str, source: str, wide: bool = False) -> DataFrame:
    return _silver(b.base(spark, sf_dir), source, wide)


def _silver(rows: DataFrame, source: str, wide: bool) -> DataFrame:
    cleaned = quality.valid(cleaning.CHECKS[source](b.records(rows, source, wide), b.RUN_TS))
    return last_write(cleaned, TABLES[fv.SILVER[source]].key, ORDER)


def joined(spark: SparkSession, sf_dir: str, wide: bool = False, as_of: str | None = None) -> DataFrame:
    rows = b.base(spark, sf_dir)
    inputs = [_silver(rows, source, wide) for source in fv.SOURCES]
    return join_sources(*inputs, run_ts=b.RUN_TS, as_of=as_of)


def places(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return b.stations(spark, sf_dir) if wide else reference.provinces(spark)


def fact(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return gold.build_fact(joined(spark, sf_dir, wide), b.RUN_TS, places(spark, sf_dir, wide))


def dim_time(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Built from the dates of the silver tables, which are those of the joined rows."""
    dates = source_keys(
        *(
            silver(spark, sf_dir, source, wide).withColumn("date", F.substring("hour_bucket", 1, 10))
            for source in ("air_quality", "weather")
        ),
        silver(spark, sf_dir, "flood", wide),
    )
    return gold.build_dim_time(dates, b.RUN_TS)


_STARS: dict[tuple[str, str, bool], TableStore] = {}


def star(spark: SparkSession, sf_dir: str, wide: bool = False) -> TableStore:
    """Stored fact and dimension tables over the test tables.

    Written once per application and table folder, as queries read stored tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir, wide)
    if key not in _STARS:
        store = TableStore(spark, working_dir(spark, "star"))
        locations = places(spark, sf_dir, wide)
        store.append(fv.FACT, gold.build_fact(joined(spark, sf_dir, wide), b.RUN_TS, locations))
        store.append(fv.DIM_LOCATION, gold.build_dim_location(locations, b.RUN_TS))
        store.append(fv.DIM_TIME, gold.build_dim_time(store.read(fv.FACT), b.RUN_TS))
        _STARS[key] = store
    return _STARS[key]


def _errors_text(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", F.array_join(quality.ERRORS, ";")).drop(quality.ERRORS)


# --- Cleaning and validation ---------------------------------------------------

_CHECKED = {"air_quality": "air_k", "weather": "wx_k", "flood": "fl_k"}
_SILVER = {"air_quality": "air_s", "weather": "wx_s", "flood": "fl_s"}
_SHORT = {"air_quality": "air", "weather": "weather", "flood": "flood"}


def _register_source(source: str) -> None:
    short = _SHORT[source]

    @register(f"clean_{short}", o.with_tables(f"SELECT * FROM {_CHECKED[source]}"))
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _errors_text(checked(spark, sf_dir, source))

    columns = ", ".join(TABLES[fv.SILVER[source]].schema.fieldNames())

    @register(f"silver_{short}", o.with_tables(f"SELECT {columns} FROM {_SILVER[source]}"))
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver(spark, sf_dir, source).drop("_ingested_at")


for _source in fv.SOURCES:
    _register_source(_source)


@register(
    "incremental_air",
    o.with_tables(
        f"SELECT * FROM air_k WHERE errors = '' AND _ingested_at > '{MID_MONTH}T12:00:00+00:00'"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = cleaning.since(b.bronze(spark, sf_dir, "air_quality"), f"{MID_MONTH}T12:00:00+00:00")
    cleaned = quality.valid(cleaning.check_air(new, b.RUN_TS))
    return cleaned.withColumn("errors", F.lit(""))


@register(
    "quarantine",
    o.with_tables(
        " UNION ALL ".join(
            f"SELECT '{source}' AS source, message_id, errors FROM {table} WHERE errors <> ''"
            for source, table in _CHECKED.items()
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        cleaning.quarantine(checked(spark, sf_dir, source), source, b.RUN_TS)
        for source in fv.SOURCES
    ]
    return parts[0].union(parts[1]).union(parts[2]).select(
        "source",
        F.get_json_object("record", "$.message_id").alias("message_id"),
        F.array_join("errors", ";").alias("errors"),
    )


@register(
    "run_metrics",
    o.with_tables(
        " UNION ALL ".join(
            f"""SELECT '{source}' AS source, count(*) AS read, count_if(errors = '')::BIGINT AS valid,
            count_if(errors <> '')::BIGINT AS dropped FROM {table}"""
            for source, table in _CHECKED.items()
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        cleaning.cleaning_counts(checked(spark, sf_dir, source), source) for source in fv.SOURCES
    ]
    return counts[0].union(counts[1]).union(counts[2])


# --- Message ids, name map, payloads -------------------------------------------

_READING = {
    "air_quality": ("air_b", "timestamp", "pm25"),
    "weather": ("wx_b", "timestamp", "temperature"),
    "flood": ("fl_b", "date", "flood_risk"),
}


@register(
    "message_ids",
    o.with_tables(
        " UNION ALL ".join(
            f"""SELECT '{source}' AS source, message_id AS record, md5(coalesce({when}, 'None') || '|' ||
            coalesce(province, 'None') || '|' || coalesce({reading}, 'None')) AS message_id FROM {table}"""
            for source, (table, when, reading) in _READING.items()
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for source in fv.SOURCES:
        records = b.bronze(spark, sf_dir, source).withColumnRenamed("message_id", "record")
        parts.append(
            payloads.with_message_id(records, source).select(
                F.lit(source).alias("source"), "record", "message_id"
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


_LOCAL_NAME = (
    "CASE event_type "
    + " ".join(
        f"WHEN '{kind}' THEN '{name}'"
        for kind, (name, _) in zip(("click", "view", "purchase", "signup"), fv.THAI_NAMES)
    )
    + " ELSE 'elsewhere' END"
)
_FIRST_LOCAL, _FIRST = fv.THAI_NAMES[-1]


@register(
    "name_map",
    o.with_tables(
        "SELECT event_id, n.province FROM (SELECT event_id, " + _LOCAL_NAME + " AS local_name FROM e) "
        "JOIN (VALUES " + ", ".join(f"('{x}', '{y}')" for x, y in fv.THAI_NAMES) + ") "
        "n(local_name, province) USING (local_name)"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = b.base(spark, sf_dir).selectExpr("event_id", f"{_LOCAL_NAME} AS province")
    return payloads.canonical_names(named).select("event_id", "province")


@register(
    "flatten_air",
    o.with_tables(
        "SELECT timestamp, n.province, pm25, pm10, unit, 'openaq_custom' AS source FROM ("
        f"SELECT iso || '+00:00' AS timestamp, {_LOCAL_NAME} AS local_name, value AS pm25, "
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 2e0 END AS pm10, "
        "CASE WHEN event_id % 4 = 0 THEN 'µg/m³' ELSE 'ug/m3' END AS unit FROM e UNION ALL "
        f"SELECT iso || '+00:00', '{_FIRST_LOCAL}', value / 2e0, NULL, 'µg/m³' FROM e) "
        "JOIN (VALUES " + ", ".join(f"('{x}', '{y}')" for x, y in fv.THAI_NAMES) + ") "
        "n(local_name, province) USING (local_name)"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = b.base(spark, sf_dir).selectExpr(
        f"""to_json(named_struct('data', array(
          named_struct('province', {_LOCAL_NAME}, 'pm25', value,
            'pm10', CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 2e0 END,
            'unit', CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'ug/m3' END,
            'datetime', named_struct('utc', iso || '+00:00')),
          named_struct('province', '{_FIRST_LOCAL}', 'pm25', value / 2e0, 'pm10', cast(NULL AS double),
            'unit', cast(NULL AS string), 'datetime', named_struct('utc', iso || '+00:00'))
        ))) AS payload"""
    )
    return payloads.flatten_air(answers)


@register(
    "flatten_weather",
    o.with_tables(
        "SELECT iso || '+00:00' AS timestamp, event_type AS province, value AS temperature, "
        "cast(k AS double) AS humidity, CASE WHEN event_id % 3 <> 0 THEN 'Rain' END AS weather_condition, "
        "CASE WHEN event_id % 3 <> 0 THEN 'light rain' END AS weather_description, "
        "'openweather' AS source FROM e"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = b.base(spark, sf_dir).selectExpr(
        "iso || '+00:00' AS timestamp",
        "event_type AS province",
        """to_json(named_struct('main', named_struct('temp', value, 'humidity', k), 'weather',
          CASE WHEN event_id % 3 = 0 THEN array()
            WHEN event_id % 3 = 1 THEN array(named_struct('main', 'Rain', 'description', 'light rain'))
            ELSE array(named_struct('main', 'Rain', 'description', 'light rain'),
                       named_struct('main', 'Mist', 'description', 'mist')) END)) AS payload""",
    )
    return payloads.flatten_weather(answers)


# --- Join and star schema ------------------------------------------------------


def _register_layers(wide: bool) -> None:
    suffix = "_wide" if wide else ""

    @register(f"silver_joined{suffix}", o.with_tables("SELECT * FROM joined", wide))
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        return joined(spark, sf_dir, wide)

    @register(f"fact{suffix}", o.with_tables("SELECT * FROM fact", wide))
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fact(spark, sf_dir, wide)


_register_layers(False)
_register_layers(True)


@register("silver_joined_as_of", o.with_tables(f"SELECT * FROM joined WHERE date = '{b.LAST_DAY}'", True))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark, sf_dir, True, b.LAST_DAY)


@register("source_keys", o.with_tables("SELECT DISTINCT province, date FROM joined", True))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    air, weather = (
        silver(spark, sf_dir, source, True)
        .withColumn("date", F.substring("hour_bucket", 1, 10))
        .filter(F.col("date").try_cast("date").isNotNull())
        for source in ("air_quality", "weather")
    )
    flood = silver(spark, sf_dir, "flood", True)
    return source_keys(air, weather, flood.filter(F.col("date").try_cast("date").isNotNull()))


@register("dim_time", o.with_tables("SELECT * FROM dim_time"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_time(spark, sf_dir)


@register(
    "invalid_dates",
    o.with_tables(
        f"SELECT date, count(*) AS rows FROM fl_b WHERE date IS NOT NULL AND NOT {o.real_date('date')} GROUP BY date"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.invalid_dates(b.bronze(spark, sf_dir, "flood"))


@register("dim_location", o.with_tables("SELECT * FROM dim_location", True))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_dim_location(b.stations(spark, sf_dir), b.RUN_TS)


# --- Business queries, cards and alerts ----------------------------------------

_NEWEST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY province ORDER BY date DESC) AS rn
  FROM fact WHERE {0} IS NOT NULL) WHERE rn = 1)"""
_COLOR = (
    "CASE {0} "
    + " ".join(f"WHEN '{level}' THEN '{color}'" for level, color in fv.LEVEL_COLORS.items())
    + " ELSE '#000' END"
)


def _one_decimal(x: str, unit: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' ELSE printf('%.1f {unit}', {x}) END"


_Q01 = f"""SELECT province, {o.half_even('l', 2)} AS latest_pm25, {o.half_even('a', 2)} AS avg_pm25,
  pm25_score, latest_date FROM (SELECT n.province, n.pm25 AS l, a, n.pm25_score, n.date AS latest_date
  FROM {_NEWEST.format('pm25')} n JOIN (SELECT province, {o.avg('pm25')} AS a FROM fact GROUP BY province)
  USING (province)) ORDER BY latest_pm25 DESC, province LIMIT 5"""
_Q02 = f"""SELECT province, {o.half_even('l', 1)} AS latest_temp, {o.half_even('a', 1)} AS avg_temp,
  temp_score, latest_date FROM (SELECT n.province, n.temperature AS l, a, n.temp_score, n.date AS latest_date
  FROM {_NEWEST.format('temperature')} n
  JOIN (SELECT province, {o.avg('temperature')} AS a FROM fact GROUP BY province)
  USING (province)) ORDER BY latest_temp DESC, province LIMIT 5"""
_Q03 = f"""SELECT province, flood_risk, flood_score, water_level_m AS water_level, date AS latest_date
  FROM {_NEWEST.format('flood_risk')} ORDER BY flood_score DESC, province LIMIT 5"""
_Q04 = f"""SELECT n.province, date AS latest_date, {o.half_even('pm25', 2)} AS pm25,
  {o.half_even('temperature', 1)} AS temperature, flood_risk, pm25_score, temp_score, flood_score,
  risk_score, risk_level, latitude, longitude
  FROM newest n LEFT JOIN dim_location d ON n.province = d.province"""
_Q05 = """SELECT date, pm25, temperature, flood_risk, risk_score, risk_level FROM fact
  WHERE province = '{0}' ORDER BY date DESC LIMIT 7"""
_Q06 = """SELECT province, risk_level, risk_score, date AS latest_date FROM newest
  WHERE risk_level IN ('Critical', 'High')"""


def _q07(fact_name: str, dim: str, where: str = "") -> str:
    return f"""SELECT year, month, province, {o.half_even('p', 2)} AS avg_pm25,
      {o.half_even('t', 1)} AS avg_temp, {o.half_even('r', 2)} AS avg_risk_score, record_count
    FROM (SELECT year, month, province, {o.avg('pm25')} AS p, {o.avg('temperature')} AS t,
      {o.avg('risk_score')} AS r, count(*) AS record_count
      FROM {fact_name} f LEFT JOIN {dim} d ON f.date = d.date {where} GROUP BY year, month, province)"""


_Q09 = """SELECT province AS Province, pm25 AS PM25_ugm3, pm25_score AS PM25_Score,
  risk_level AS Risk_Level, date AS Last_Updated FROM newest"""
_Q10 = f"""SELECT n.province AS Province, t AS Temp_C, h AS Humidity_pct, weather_condition AS Condition,
  temp_score AS Temp_Score, date AS Last_Updated FROM newest n JOIN (SELECT province,
  {o.avg('temperature')} AS t, {o.avg('humidity')} AS h FROM fact GROUP BY province) USING (province)"""
_Q11 = f"""SELECT n.province AS Province, flood_risk AS Flood_Risk, flood_score AS Flood_Score,
  x AS Affected_Area_km2, w AS Water_Level_m, date AS Last_Updated FROM newest n JOIN (SELECT province,
  {o.avg('affected_area_km2')} AS x, {o.avg('water_level_m')} AS w FROM fact GROUP BY province)
  USING (province)"""
_Q12 = """SELECT province AS Province, risk_score AS Risk_Score, risk_level AS Risk_Level,
  pm25_score AS PM25_Score, temp_score AS Temp_Score, flood_score AS Flood_Score,
  date AS Last_Updated FROM newest"""


def _pivot(names: list[tuple[str, str]]) -> str:
    return ", ".join(
        o.avg(f"CASE WHEN {test} THEN pm25 END") + f" AS {name}" for name, test in names
    )


_Q13 = f"""SELECT 'Avg PM2.5 by Weather Impact' AS Category, {_pivot([
    (n, f"weather_pm25_impact = '{n}'") for n in ("Lower", "Moderate", "Higher", "Neutral")])}
  FROM fact WHERE pm25 > 0 HAVING count(*) > 0"""
_Q14 = f"""SELECT 'Avg PM2.5 Rainy vs Non-Rainy' AS Category,
  {_pivot([('Non_Rainy', 'NOT is_rainy'), ('Rainy', 'is_rainy')])}
  FROM fact WHERE pm25 > 0 HAVING count(*) > 0"""
_Q15 = f"""SELECT date AS Date, {o.avg('pm25')} AS PM25, {o.avg('humidity')} AS Humidity FROM fact
  WHERE pm25 IS NOT NULL AND humidity IS NOT NULL GROUP BY date"""
_Q16 = """SELECT date AS Date, province AS Province, {0} AS PM25 FROM {1}
  WHERE pm25 IS NOT NULL GROUP BY date, province"""
_Q17 = f"""SELECT weather_condition AS Weather, flood_risk AS Flood_Risk,
  {o.avg('risk_score')} AS Avg_Risk_Score, count(*) AS Count FROM fact
  WHERE weather_condition IS NOT NULL AND flood_risk IS NOT NULL GROUP BY 1, 2"""
_Q18 = f"""SELECT substr(hour_bucket, 6, 11) AS Hour, PM25, Humidity FROM (SELECT hour_bucket,
  {o.avg('pm25')} AS PM25, {o.avg('humidity')} AS Humidity FROM fact WHERE hour_bucket IS NOT NULL
  GROUP BY hour_bucket ORDER BY hour_bucket DESC LIMIT 24)"""
_Q19 = f"""SELECT substr(hour_bucket, 6, 11) AS Hour, province AS Province, PM25 FROM (
  SELECT hour_bucket, province, {o.avg('pm25')} AS PM25 FROM fact WHERE hour_bucket IS NOT NULL
  GROUP BY hour_bucket, province ORDER BY hour_bucket DESC, province LIMIT 120)"""
_Q20 = "SELECT province, risk_score, risk_level FROM newest"
_Q21 = "SELECT province, {0} AS avg_pm25, max(pm25) AS max_pm25 FROM {1} GROUP BY province"
_Q22 = """SELECT date, risk_score, risk_level, pm25 FROM fact WHERE province = '{0}'
  ORDER BY date DESC LIMIT 7"""
_Q23 = f"""SELECT province, date, risk_score, risk_level, {_COLOR.format('risk_level')} AS color,
  {_one_decimal('pm25', 'µg/m³')} AS pm25, {_one_decimal('temperature', '°C')} AS temperature,
  coalesce(flood_risk, 'N/A') AS flood_risk FROM newest WHERE coalesce(risk_score, 0) > 50"""
_Q24 = f"""SELECT province, date, flood_risk, {_COLOR.format('flood_risk')} AS color,
  affected_area_km2, water_level_m, flood_score FROM newest
  WHERE flood_risk IN ('High', 'Very High')"""

_PLACE = {False: "Bangkok", True: "click_3"}


def _on_fact(name: str, sql: str, query: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query of the fact table for few and for many provinces."""
    for wide, key in ((False, name), (True, f"{name}_wide")):
        place = _PLACE[wide]
        text = o.with_tables(sql.replace("{place}", place), wide)

        def run(spark: SparkSession, sf_dir: str, wide: bool = wide, place: str = place) -> DataFrame:
            table = star(spark, sf_dir, wide).read(fv.FACT)
            return query(table, place) if "{place}" in sql else query(table)

        register(key, text)(run)


_on_fact("q01", _Q01, bi.pm25_by_province)
_on_fact("q02", _Q02, bi.temperature_by_province)
_on_fact("q03", _Q03, bi.flood_risk_by_province)
_on_fact("q05", _Q05.format("{place}"), bi.risk_trend)
_on_fact("q06", _Q06, bi.alerts)
for _label, _metric in dashboards.MAP_METRICS.items():
    _on_fact(
        f"q08_{_metric}",
        f'SELECT province AS "Province", lat, lon, {_metric} AS "{_label}" FROM newest',
        lambda table, label=_label: dashboards.metric_map(table, label),
    )
_on_fact("q09", _Q09, dashboards.pm25_table)
_on_fact("q10", _Q10, dashboards.weather_table)
_on_fact("q11", _Q11, dashboards.flood_table)
_on_fact("q12", _Q12, dashboards.risk_table)
_on_fact("q13", _Q13, dashboards.impact_bars)
_on_fact("q14", _Q14, dashboards.rainy_bars)
_on_fact("q15", _Q15, dashboards.daily_trend)
_on_fact("q16", _Q16.format(o.avg("pm25"), "fact"), dashboards.daily_trend_by_province)
_on_fact("q17", _Q17, dashboards.weather_by_flood)
_on_fact("q18", _Q18, dashboards.hourly_trend)
_on_fact("q19", _Q19, dashboards.hourly_trend_by_province)
_on_fact("q20", _Q20, bi.current_risk)
_on_fact("q21", _Q21.format(o.avg("pm25"), "fact"), bi.average_pm25)
_on_fact("q22", _Q22.format("{place}"), bi.recent_records)
_on_fact("q23", _Q23, alerts.overall_alert)
_on_fact("q24", _Q24, alerts.flood_alert)


def _on_star(name: str, sql: str, query: Callable[[TableStore], DataFrame]) -> None:
    """Register a query of several tables for few and for many provinces."""
    for wide, key in ((False, name), (True, f"{name}_wide")):

        def run(spark: SparkSession, sf_dir: str, wide: bool = wide) -> DataFrame:
            return query(star(spark, sf_dir, wide))

        register(key, o.with_tables(sql.replace("{place}", _PLACE[wide]), wide))(run)


_on_star("q04", _Q04, lambda t: bi.risk_dashboard(t.read(fv.FACT), t.read(fv.DIM_LOCATION)))
_on_star(
    "q07",
    _q07("fact", "dim_time"),
    lambda t: bi.monthly_summary(t.read(fv.FACT), t.read(fv.DIM_TIME)),
)


@register("q07_province", o.with_tables(_q07("fact", "dim_time", "WHERE province = 'Bangkok'")))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir)
    return bi.monthly_summary(tables.read(fv.FACT), tables.read(fv.DIM_TIME), "Bangkok")


# The same plans over lineitem, for volume: suppliers as provinces, ship dates as days.
_LINEITEM = {
    "province": "'S' || cast(l_suppkey AS string)",
    "date": "substring(cast(l_shipdate AS string), 1, 10)",
    "pm25": "l_quantity",
    "temperature": "l_discount * 100e0",
    "risk_score": "l_extendedprice",
}
_LINE_TABLES = {
    "line": f"SELECT {b.sql(_LINEITEM)} FROM lineitem",
    "line_time": o.dim_time("line"),
}


def _line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr(*(f"{text} AS {name}" for name, text in _LINEITEM.items()))


@register("q07_lineitem", o.with_tables(_q07("line", "line_time"), **_LINE_TABLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line(spark, sf_dir)
    return bi.monthly_summary(lines, gold.build_dim_time(lines, b.RUN_TS))


@register("q16_lineitem", o.with_tables(_Q16.format(o.avg("pm25"), "line"), **_LINE_TABLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.daily_trend_by_province(_line(spark, sf_dir))


@register("q21_lineitem", o.with_tables(_Q21.format(o.avg("pm25"), "line"), **_LINE_TABLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.average_pm25(_line(spark, sf_dir))


# Values of more than six decimals, small and large, one of them beyond 1e12.
_FINE = "CASE WHEN l_orderkey = 1 THEN 7e12 / 3e0 WHEN l_linenumber = 2 THEN 4e-7 ELSE l_quantity / 3e0 END"


@register(
    "avg_fine",
    # A group with the large value is compared in whole tenths.
    f"""SELECT l_linenumber, l_returnflag, CASE WHEN max({_FINE}) > 1e12 THEN round(favg({_FINE}), 1)
      ELSE round(favg({_FINE}) * 1e6, 1) END AS millionths, count(*) AS n
    FROM lineitem GROUP BY l_linenumber, l_returnflag
    UNION ALL SELECT NULL, 'large', round(favg({_FINE}), 1), count(*) FROM lineitem""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("x", F.expr(_FINE))
    groups = lines.groupBy("l_linenumber", "l_returnflag")
    every = lines.groupBy(F.lit(None).cast("int").alias("l_linenumber"), F.lit("large").alias("l_returnflag"))
    count = F.count("*").alias("n")
    average = steady_avg(F.col("x"))
    shown = F.when(F.max("x") > 1e12, F.round(average, 1)).otherwise(F.round(average * 1e6, 1))
    return groups.agg(shown.alias("millionths"), count).unionByName(
        every.agg(F.round(steady_avg(F.col("x")), 1).alias("millionths"), count)
    )


@register(
    "latest_orders",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
      AS rn FROM orders) WHERE rn = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return latest_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --- Upserts and keys ----------------------------------------------------------


def _set(old: str, new: str, keys: list[str], given: list[str], kept: list[str] = ()) -> str:
    """SELECT that sets the ``given`` columns of ``new`` on ``old`` and tells the change."""
    match = " AND ".join(f"u.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    columns = ", ".join(
        f"CASE WHEN u.is_new THEN u.{c} ELSE t.{c} END AS {c}" for c in given
    )
    survive = "".join(f", t.{c} AS {c}" for c in kept)
    same = " AND ".join(f"u.{c} IS NOT DISTINCT FROM t.{c}" for c in given)
    return f"""SELECT {columns}{survive}, CASE WHEN u.is_new IS NULL THEN 'kept'
        WHEN t.is_old IS NULL THEN 'inserted' WHEN {same} THEN 'matched' ELSE 'modified' END AS _change
      FROM (SELECT *, true AS is_old FROM {old}) t
      FULL OUTER JOIN (SELECT *, true AS is_new FROM {new}) u ON {match}"""


def _register_upsert(source: str) -> None:
    table = TABLES[fv.SILVER[source]]
    columns = table.schema.fieldNames()
    keys = ", ".join(table.key)
    checked_name = _CHECKED[source]
    parts = {
        "old_k": f"SELECT * FROM {checked_name} WHERE _ingested_at < '2024-01-21'",
        "new_k": f"SELECT * FROM {checked_name} WHERE _ingested_at >= '2024-01-10'",
        "old_s": o.last_write("old_k", keys),
        "new_s": o.last_write("new_k", keys),
    }

    @register(
        f"upsert_silver_{_SHORT[source]}",
        o.with_tables(_set("old_s", "new_s", list(table.key), columns), True, **parts),
    )
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = quality.valid(checked(spark, sf_dir, source, True))
        old = last_write(rows.filter("_ingested_at < '2024-01-21'"), table.key, ORDER)
        new = last_write(rows.filter("_ingested_at >= '2024-01-10'"), table.key, ORDER)
        return upsert(old.select(*columns), new.select(*columns), table.key, with_change=True)


for _source in fv.SOURCES:
    _register_upsert(_source)

_SET_FACT = ["province", "date", "pm25", "risk_score", "risk_level", "flood_risk"]


@register(
    "upsert_fact",
    o.with_tables(
        _set("old_f", "new_f", ["province", "date"], _SET_FACT, ["weather_description", "_layer"]),
        True,
        old_f="SELECT * FROM fact WHERE date < '2024-01-21'",
        new_f="""SELECT province, date, pm25, risk_score + 1e0 AS risk_score, risk_level,
          CASE WHEN flood_risk = 'Low' THEN NULL ELSE flood_risk END AS flood_risk
          FROM fact WHERE date >= '2024-01-10'""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star(spark, sf_dir, True).read(fv.FACT)
    old = rows.filter("date < '2024-01-21'").select(*_SET_FACT, "weather_description", "_layer")
    new = rows.filter("date >= '2024-01-10'").select(
        "province",
        "date",
        "pm25",
        (F.col("risk_score") + 1).alias("risk_score"),
        "risk_level",
        F.when(F.col("flood_risk") != "Low", F.col("flood_risk")).alias("flood_risk"),
    )
    return upsert(old, new, ["province", "date"], with_change=True)


_PLACE_COLUMNS = ["province", "latitude", "longitude", "country", "_updated_at"]


@register(
    "upsert_dim_location",
    o.with_tables(
        _set("old_d", "new_d", ["province"], _PLACE_COLUMNS),
        True,
        old_d="SELECT * FROM dim_location WHERE latitude < 45e0",
        new_d="""SELECT province, latitude, CASE WHEN longitude > 0e0 THEN 0e0 ELSE longitude END AS longitude,
          country, _updated_at FROM dim_location WHERE latitude >= -45e0""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_places = gold.build_dim_location(b.stations(spark, sf_dir), b.RUN_TS)
    old = all_places.filter("latitude < 45")
    new = all_places.filter("latitude >= -45").withColumn(
        "longitude", F.when(F.col("longitude") > 0, 0.0).otherwise(F.col("longitude"))
    )
    return upsert(old, new, ["province"], with_change=True)


_TIME_COLUMNS = TABLES[fv.DIM_TIME].schema.fieldNames()


@register(
    "upsert_dim_time",
    o.with_tables(
        _set("old_d", "new_d", ["date"], _TIME_COLUMNS),
        **_LINE_TABLES,
        old_d="SELECT * FROM line_time WHERE year <= 1998",
        new_d="SELECT * FROM line_time WHERE year >= 1996",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = gold.build_dim_time(_line(spark, sf_dir), b.RUN_TS)
    return upsert(
        days.filter("year <= 1998"), days.filter("year >= 1996"), ["date"], with_change=True
    )


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@register(
    "upsert_orders",
    "WITH old_o AS (SELECT * FROM orders WHERE o_orderdate < timestamp '1999-01-01'), "
    "new_o AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 2e0 AS o_totalprice "
    "FROM orders WHERE o_orderdate >= timestamp '1997-01-01') "
    + _set("old_o", "new_o", ["o_orderkey"], _ORDER_COLUMNS, ["o_orderpriority"]),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    old = orders.filter("o_orderdate < timestamp_ntz '1999-01-01'")
    new = orders.filter("o_orderdate >= timestamp_ntz '1997-01-01'").select(
        "o_orderkey",
        "o_custkey",
        F.lit("X").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
    )
    return upsert(old.select(*_ORDER_COLUMNS, "o_orderpriority"), new, ["o_orderkey"], with_change=True)


@register(
    "unique_report",
    o.with_tables(
        "SELECT province, hour_bucket, count(*) AS copies FROM air_k GROUP BY ALL HAVING count(*) > 1"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(checked(spark, sf_dir, "air_quality"), ["province", "hour_bucket"])


@register(
    "unique_report_lineitem",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.repeated_keys(lines, ["l_orderkey", "l_linenumber"])


@register(
    "high_water",
    o.with_tables(
        " UNION ALL ".join(
            f"""SELECT 'air_quality_flood_weather' AS flow, '{source}' AS source,
            max(_ingested_at) AS high_water FROM {table}"""
            for source, table in _CHECKED.items()
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = watermarks.flow_name(fv.SOURCES)
    marks = [
        watermarks.next_mark(b.bronze(spark, sf_dir, source), flow, source) for source in fv.SOURCES
    ]
    return marks[0].union(marks[1]).union(marks[2])


@register(
    "newer_than",
    o.with_tables(f"SELECT message_id, timestamp FROM wx_b WHERE timestamp > '{MID_MONTH}T00:00:00'"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = b.bronze(spark, sf_dir, "weather").select("message_id", "timestamp")
    return files.newer_than(records, f"{MID_MONTH}T00:00:00")


@register(
    "daily_guard",
    o.with_tables(
        f"""SELECT message_id, date, province, flood_risk FROM fl_b WHERE date IS NULL OR date NOT IN
        (SELECT date FROM fl_b WHERE _ingested_at < '{MID_MONTH}' AND date IS NOT NULL)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = b.bronze(spark, sf_dir, "flood")
    loaded = records.filter(F.col("_ingested_at") < MID_MONTH)
    fields = records.select("message_id", "date", "province", "flood_risk")
    return files.not_loaded(fields, loaded)


# --- Schema reports ------------------------------------------------------------


@register(
    "schema_report_bronze",
    o.with_tables(
        """SELECT * FROM (SELECT province, timestamp, concat_ws(';',
          CASE WHEN pm25 = 'n/a' THEN 'null:message_id' END,
          CASE WHEN unit IS NULL THEN 'enum:_layer' END) AS violations FROM air_b) WHERE violations <> ''"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.bronze(spark, sf_dir, "air_quality").withColumns(
        {
            "message_id": F.when(F.coalesce(F.col("pm25") != "n/a", F.lit(True)), F.col("message_id")),
            "_layer": F.when(F.col("unit").isNull(), "raw").otherwise(F.col("_layer")),
        }
    )
    report = quality.bronze_violations(raw)
    return report.select("province", "timestamp", F.array_join("violations", ";").alias("violations"))


@register(
    "schema_report_fact",
    o.with_tables(
        """SELECT * FROM (SELECT province, date, concat_ws(';',
          CASE WHEN pm25 IS NULL THEN 'null:risk_level' END,
          CASE WHEN pm25 IS NOT NULL AND flood_risk IS NULL THEN 'enum:risk_level' END,
          CASE WHEN is_rainy THEN 'enum:_layer' END) AS violations FROM fact) WHERE violations <> ''""",
        True,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("flood_risk").isNull(), "Severe").otherwise(F.col("risk_level"))
    rows = star(spark, sf_dir, True).read(fv.FACT).withColumns(
        {
            "risk_level": F.when(F.col("pm25").isNotNull(), level),
            "_layer": F.when(F.col("is_rainy"), "test").otherwise(F.col("_layer")),
        }
    )
    report = quality.fact_violations(rows)
    return report.select("province", "date", F.array_join("violations", ";").alias("violations"))


# --- Files ---------------------------------------------------------------------

_CSV_FIELDS = "date, province, flood_risk, affected_area_km2, water_level_m, source"
_CSV_READ = ", ".join(f"coalesce({name}, '') AS {name}" for name in _CSV_FIELDS.split(", "))


def _csv(spark: SparkSession, sf_dir: str) -> str:
    """Flood records appended to one CSV folder in two goes."""
    path = working_dir(spark, "csv")
    records = b.bronze(spark, sf_dir, "flood")
    first = F.col("_ingested_at") < MID_MONTH
    for part in (records.filter(first), records.filter(~first)):
        files.append_csv(part.select(*_CSV_FIELDS.split(", ")), path)
    return path


@register("csv_roundtrip", o.with_tables(f"SELECT {_CSV_READ} FROM fl_b"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_flood_csv(spark, _csv(spark, sf_dir))


@register("csv_of_day", o.with_tables(f"SELECT {_CSV_READ} FROM fl_b WHERE date = '{MID_MONTH}'"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_flood_csv(spark, _csv(spark, sf_dir), MID_MONTH)


@register("json_roundtrip", o.with_tables("SELECT *, NULL::VARCHAR AS _seeded_from FROM joined", True))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_dir(spark, "export")
    files.write_export(joined(spark, sf_dir, True), path)
    return files.read_export(spark, path)


# --- Stored tables and flows ---------------------------------------------------


def _store(spark: SparkSession) -> TableStore:
    store = TableStore(spark, working_dir(spark, "store"))
    store.create_all()
    return store


def _loaded(spark: SparkSession, sf_dir: str, wide: bool = False) -> TableStore:
    store = _store(spark)
    for source in fv.SOURCES:
        store.append(fv.BRONZE[source], b.bronze(spark, sf_dir, source, wide))
    return store


@register(
    "stored_tables",
    o.with_tables(
        """SELECT 'bronze_air_quality' AS name, count(*) AS rows FROM air_b
        UNION ALL SELECT 'bronze_weather', count(*) FROM wx_b
        UNION ALL SELECT 'bronze_flood', count(*) FROM fl_b"""
        + "".join(
            f" UNION ALL SELECT '{name}', 0"
            for name in TABLES
            if name not in ("bronze_air_quality", "bronze_weather", "bronze_flood")
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _loaded(spark, sf_dir)
    counts = None
    for name in TABLES:
        rows = store.read(name).agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        counts = rows if counts is None else counts.union(rows)
    return counts


_AIR_AND_WEATHER = """SELECT province, date, hour_bucket, pm25, temperature, humidity, weather_condition,
  weather_description, NULL::VARCHAR AS flood_risk, NULL::DOUBLE AS affected_area_km2,
  NULL::DOUBLE AS water_level_m FROM joined WHERE pm25 IS NOT NULL OR temperature IS NOT NULL"""
_NEWEST_DRY = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY province ORDER BY date DESC) AS rn
  FROM dry_fact) WHERE rn = 1"""


@register(
    "flow_hourly",
    o.with_tables(
        _Q23.replace("FROM newest", "FROM dry_newest").replace("> 50", "> 30"),
        dry=_AIR_AND_WEATHER,
        dry_fact=o.scored("dry", "places"),
        dry_newest=_NEWEST_DRY,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nothing in the test tables is above the threshold of 50.
    return flows.hourly_flow(_loaded(spark, sf_dir), b.RUN_TS, threshold=30)


def _metrics_sql(source: str, checked: str, silver: str) -> str:
    return f"""SELECT '{source}' AS source, count(*) AS read, count(*) FILTER (WHERE errors = '') AS valid,
      count(*) FILTER (WHERE errors <> '') AS dropped, (SELECT count(*) FROM {silver}) AS inserted,
      0::BIGINT AS modified FROM {checked}"""


@register(
    "flow_metrics",
    o.with_tables(" UNION ALL ".join(_metrics_sql(s, _CHECKED[s], _SILVER[s]) for s in fv.SOURCES)),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.run_flow(_loaded(spark, sf_dir), b.RUN_TS, fv.SOURCES)


@register(
    "flow_modified",
    o.with_tables(
        " UNION ALL ".join(
            _metrics_sql(s, _CHECKED[s], _SILVER[s]).replace("AS inserted", "AS modified").replace("0::BIGINT AS modified", "0::BIGINT AS inserted")
            for s in fv.SOURCES
        )
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records arrive again later: the second run sets every stored row anew and inserts none."""
    store = _loaded(spark, sf_dir)
    flows.run_flow(store, b.RUN_TS, fv.SOURCES)
    for source in fv.SOURCES:
        again = b.bronze(spark, sf_dir, source).withColumn(
            "_ingested_at", F.concat(F.lit("2025-"), F.substring("_ingested_at", 6, 20))
        )
        store.append(fv.BRONZE[source], again)
    return flows.run_flow(store, "2025-02-01T00:00:00+00:00", fv.SOURCES)


@register("flow_daily", o.with_tables(_Q24))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _loaded(spark, sf_dir)
    flows.hourly_flow(store, b.RUN_TS)
    return flows.daily_flow(store, b.RUN_TS)


_FACT_COLUMNS = ", ".join(n for n in TABLES[fv.FACT].schema.fieldNames() if n != "_seeded_from")


@register(
    "flow_all_sources", o.with_tables(f"SELECT {_FACT_COLUMNS}, NULL::VARCHAR AS _seeded_from FROM fact")
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _loaded(spark, sf_dir)
    flows.run_flow(store, b.RUN_TS, fv.SOURCES)
    return store.read(fv.FACT)


@register(
    "reseed",
    o.with_tables(
        f"""SELECT {_FACT_COLUMNS}, 'silver_environmental_joined' AS _seeded_from
        FROM fact WHERE province <> ''"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_dir(spark, "export")
    files.write_export(joined(spark, sf_dir), path)
    store = _store(spark)
    flows.reseed(store, files.read_export(spark, path).drop("_seeded_from"), b.RUN_TS)
    return store.read(fv.FACT)


# --- Streams -------------------------------------------------------------------

# What a topic can hold: repeated messages, broken JSON, an unknown topic, no id.
_BROKEN = "event_id % 131 = 5"
_ELSEWHERE = "event_id % 137 = 6"
_REPEATED = "event_id % 10 = 0"
_NO_ID = "event_id % 139 = 7"


# Of two copies of a message the second arrives first for half of the ids.
_ARRIVAL = "CASE WHEN event_id % 20 = 0 THEN copy ELSE 3 - copy END"


def topic_messages(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    """All records of all sources as messages, some of them twice.

    ``marked`` writes the number of the copy into its province.
    """
    parts = []
    for source in fv.SOURCES:
        fields = {"province": f"concat(coalesce({b.PROVINCE}, ''), '#', copy)" if marked else b.PROVINCE, **b.FIELDS[source]}
        raw = {name: fields[name] for name in RAW[source].fieldNames()}
        raw["message_id"] = f"CASE WHEN {_NO_ID} THEN NULL ELSE {raw['message_id']} END"
        rows = b.base(spark, sf_dir).filter(f"{b.SOURCE} = '{source}'")
        rows = rows.withColumn("copy", F.explode(F.expr(
            f"CASE WHEN {_REPEATED} THEN array(1, 2) ELSE array(1) END"
        )))
        records = rows.selectExpr(*(f"{text} AS {name}" for name, text in raw.items()), "event_id", "copy")
        parts.append(
            messages.envelope(records, source, beside=["event_id", "copy"]).selectExpr(
                f"CASE WHEN {_ELSEWHERE} THEN 'other' ELSE topic END AS topic",
                "key",
                f"CASE WHEN {_BROKEN} THEN '{{broken' ELSE value END AS value",
                "0 AS partition",
                f"event_id * 2 + {_ARRIVAL} AS offset",
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


def _ingested(spark: SparkSession, sf_dir: str, dedup: str, **options: str) -> tuple[TableStore, dict[str, int]]:
    folder = working_dir(spark, "topics")
    messages.send(topic_messages(spark, sf_dir), "parquet", f"{folder}/in")
    store = TableStore(spark, f"{folder}/store")
    totals: dict[str, int] = {}

    def add(_: int, counts: dict[str, int]) -> None:
        for name, n in counts.items():
            totals[name] = totals.get(name, 0) + n

    # Few files per batch, so that the stream needs several batches.
    stream = messages.read_stream(spark, "parquet", f"{folder}/in", max_per_trigger=8)
    query = start_ingest(
        stream,
        store,
        f"{folder}/checkpoint",
        dedup,
        available_now=True,
        clock=lambda: b.RUN_TS,
        on_batch=add,
        **options,
    )
    query.awaitTermination()
    return store, totals


def _stored_ids(store: TableStore) -> DataFrame:
    parts = [
        store.read(fv.BRONZE[source]).select("_source", "message_id", "_ingested_at", "_layer")
        for source in fv.SOURCES
    ]
    return parts[0].union(parts[1]).union(parts[2])


_KEPT = f"FROM e WHERE NOT ({_BROKEN}) AND NOT ({_ELSEWHERE})"
_STORED_IDS = f"""SELECT DISTINCT {b.SOURCE} AS _source, CASE WHEN {_NO_ID} THEN NULL
  ELSE 'm' || lpad(cast(event_id AS string), 12, '0') END AS message_id,
  '{b.RUN_TS}' AS _ingested_at, 'bronze' AS _layer {_KEPT}"""


@register("stream_ingest", o.with_tables(_STORED_IDS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _ingested(spark, sf_dir, "table")
    return _stored_ids(store)


@register("stream_dedup", o.with_tables(_STORED_IDS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _ingested(spark, sf_dir, "state")
    return _stored_ids(store)


@register("stream_indexed", o.with_tables(_STORED_IDS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _ingested(spark, sf_dir, "index")
    return _stored_ids(store)


@register("stream_watermark", o.with_tables(_STORED_IDS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records span a month; with a longer delay none is late, whatever the order of the batches."""
    store, _ = _ingested(spark, sf_dir, "watermark", delay="40 days")
    return _stored_ids(store)


@register(
    "envelope_stream",
    o.with_tables(
        f"SELECT {b.SOURCE} AS source, count(*) AS messages, count(DISTINCT event_id) AS ids FROM e GROUP BY 1"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records sent to a topic as a stream, which is started twice: the second time adds nothing."""
    folder = working_dir(spark, "outbox")
    for source in fv.SOURCES:
        b.bronze(spark, sf_dir, source).select(*RAW[source].fieldNames()).write.parquet(f"{folder}/records/{source}")
    for _ in range(2):
        for source in fv.SOURCES:
            records = spark.readStream.schema(RAW[source]).parquet(f"{folder}/records/{source}")
            sent = messages.envelope(records, source)
            messages.send_stream(
                sent, f"{folder}/checkpoint/{source}", f"{folder}/topics/{source}", available_now=True
            ).awaitTermination()
    parts = [messages.routed(spark.read.parquet(f"{folder}/topics/{source}")) for source in fv.SOURCES]
    return (
        parts[0].union(parts[1]).union(parts[2])
        .groupBy("source")
        .agg(F.count("*").alias("messages"), F.count_distinct("key").alias("ids"))
    )


@register(
    "stream_silver", o.with_tables(f"SELECT {_FACT_COLUMNS}, NULL::VARCHAR AS _seeded_from FROM fact")
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows arrive in two halves; the stream takes up what is new, through to the fact table."""
    store = _store(spark)
    folder = working_dir(spark, "silver")
    early = F.substring("_ingested_at", 9, 2) <= "15"
    for rows in (early, ~early):
        for source in fv.SOURCES:
            store.append(fv.BRONZE[source], b.bronze(spark, sf_dir, source).filter(rows))
        start_silver(store, folder, available_now=True, clock=lambda: b.RUN_TS).awaitTermination()
    return store.read(fv.FACT)


_STATS = f"""SELECT mode, total, written, total - errors - written AS duplicates, errors, unmapped
  FROM (VALUES ('state'), ('table')) AS m(mode) CROSS JOIN (SELECT
    sum(CASE WHEN {_ELSEWHERE} THEN 0 ELSE n END)::BIGINT AS total,
    sum(CASE WHEN ({_BROKEN}) AND NOT ({_ELSEWHERE}) THEN n ELSE 0 END)::BIGINT AS errors,
    sum(CASE WHEN {_ELSEWHERE} THEN n ELSE 0 END)::BIGINT AS unmapped
    FROM (SELECT *, CASE WHEN {_REPEATED} THEN 2 ELSE 1 END AS n FROM e)) CROSS JOIN (
    SELECT count(*) AS written FROM ids)"""
_COUNTS = ["total", "written", "duplicates", "errors", "unmapped"]


def _counts_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "mode string, " + ", ".join(f"{n} bigint" for n in _COUNTS))


@register("stream_stats", o.with_tables(_STATS, ids=_STORED_IDS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of a whole stream, the same in both modes."""
    rows = []
    for mode in ("state", "table"):
        _, totals = _ingested(spark, sf_dir, mode)
        rows.append((mode, *(totals[name] for name in _COUNTS)))
    return _counts_frame(spark, rows)


_FIRST = f"""SELECT DISTINCT {b.SOURCE} AS _source, 'm' || lpad(cast(event_id AS string), 12, '0') AS message_id,
  CASE WHEN ({_REPEATED}) AND event_id % 20 <> 0 THEN '2' ELSE '1' END AS copy
  {_KEPT} AND NOT ({_NO_ID})"""


@register("stream_first", o.with_tables(_FIRST))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a message differ; the one with the lower offset is stored, whatever the order in a batch."""
    store = _store(spark)
    ingest_batch(store, topic_messages(spark, sf_dir, marked=True), b.RUN_TS)
    parts = [
        store.read(fv.BRONZE[source])
        .filter("message_id IS NOT NULL")
        .select("_source", "message_id", F.substring_index("province", "#", -1).alias("copy"))
        for source in fv.SOURCES
    ]
    return parts[0].union(parts[1]).union(parts[2])


@register(
    "stream_sparse",
    o.with_tables(
        f"""SELECT _source AS source, count(*) AS rows FROM ids GROUP BY _source UNION ALL
        SELECT 'rejects', sum(CASE WHEN {_REPEATED} THEN 2 ELSE 1 END)::BIGINT FROM e
        WHERE {_BROKEN} AND NOT ({_ELSEWHERE})""",
        ids=_STORED_IDS,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with one source each, without rejects, with rejects alone and with nothing, each run twice."""
    store = _store(spark)
    sent = topic_messages(spark, sf_dir)
    broken = F.col("value") == "{broken"
    batches = [sent.filter(~broken & (F.col("topic") == topic)) for topic in (*fv.TOPICS.values(), "other", "none")]
    for batch in [*batches, sent.filter(broken), sent.limit(0)]:
        for _ in range(2):
            ingest_batch(store, batch, b.RUN_TS)
    stored = _stored_ids(store).groupBy(F.col("_source").alias("source")).agg(F.count("*").alias("rows"))
    return stored.union(store.read("bronze_rejects").agg(F.lit("rejects"), F.count("*")))


@register(
    "stream_routing",
    o.with_tables(
        f"""SELECT _source AS source, count(*) AS rows FROM ids GROUP BY _source UNION ALL
        SELECT 'rejects', sum(CASE WHEN {_REPEATED} THEN 2 ELSE 1 END)::BIGINT FROM e
        WHERE {_BROKEN} AND NOT ({_ELSEWHERE})""",
        ids=_STORED_IDS,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _ingested(spark, sf_dir, "table")
    stored = _stored_ids(store).groupBy(F.col("_source").alias("source"))
    rejects = store.read("bronze_rejects").agg(
        F.lit("rejects").alias("source"), F.count("*").alias("rows")
    )
    return stored.agg(F.count("*").alias("rows")).union(rejects)


# What arrives late wins over what was there: the last write of a flood day is the
# newest odd hour, if there is one.
_LATE_FLOOD = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY province, date
  ORDER BY substring(_ingested_at, 13, 1) IN ('1', '3', '5', '7', '9') DESC, _ingested_at DESC,
    message_id DESC) AS rn FROM fl_k WHERE errors = '') WHERE rn = 1"""


@register(
    "stream_late",
    o.with_tables(
        "SELECT province, date, hour_bucket, pm25, flood_risk, risk_score FROM fact", fl_s=_LATE_FLOOD
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd hours arrive only after the first run; their days are joined and scored again."""
    store = _store(spark)
    for late, arrival in ((False, "2024-02-01"), (True, "2024-02-02")):
        for source in fv.SOURCES:
            records = b.bronze(spark, sf_dir, source)
            odd = F.substring("_ingested_at", 13, 1).isin("1", "3", "5", "7", "9")
            # The stamp is the arrival; among the rows of one run the order stays.
            arrived = F.concat(F.lit(f"{arrival}T"), F.substring("_ingested_at", 6, 21))
            rows = records.filter(odd if late else ~odd).withColumn("_ingested_at", arrived)
            store.append(fv.BRONZE[source], rows)
        flows.run_flow(store, b.RUN_TS, fv.SOURCES)
    columns = ["province", "date", "hour_bucket", "pm25", "flood_risk", "risk_score"]
    return store.read(fv.FACT).select(*columns)
