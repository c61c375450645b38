"""DuckDB SQL that computes the same results another way.

``with_tables`` puts the common table expressions a query needs in front of it:
raw records, cleaned silver tables, joined rows, fact and dimensions.
"""

from __future__ import annotations

from skybasin import fixed_values as fv
from skybasin.catalog import binding as b


def avg(x: str) -> str:
    """Sum to nine decimals, which a double of up to nine million still tells apart, and one division."""
    return f"cast(sum(cast({x} AS decimal(28,9))) AS double) / nullif(count({x}), 0)"


def half_even(x: str, places: int) -> str:
    """Ties-to-even rounding of the exact binary value; ``x`` is a column name."""
    s = f"{10**places}e0"
    high = f"(134217729e0 * {x} - (134217729e0 * {x} - {x}))"
    error = f"(({high} * {s} - {x} * {s}) + ({x} - {high}) * {s})"
    base = f"floor({x} * {s})"
    side = f"(({x} * {s} - {base} - 0.5e0) + {error})"
    odd = f"({base} - 2e0 * floor({base} / 2e0) = 1e0)"
    return (
        f"(({base} + CASE WHEN {side} > 0e0 THEN 1e0 "
        f"WHEN {side} = 0e0 AND {odd} THEN 1e0 ELSE 0e0 END) / {s})"
    )


def hour_bucket(ts: str) -> str:
    return f"""CASE WHEN try_cast(replace(substring({ts}, 1, 19), 'T', ' ') AS timestamp) IS NOT NULL
      AND {ts} <> '' THEN substring({ts}, 1, 10) || 'T' || substring({ts}, 12, 2) || ':00:00+00:00'
      ELSE substring({ts}, 1, 13) || ':00:00+00:00' END"""


CLEAN_PROVINCE = (
    "CASE trim(coalesce(province, '')) WHEN 'Pattaya' THEN 'Chon Buri' "
    "ELSE trim(coalesce(province, '')) END"
)


def _lineage() -> str:
    return f"""message_id, coalesce(source, 'unknown') AS source,
      '{b.RUN_TS}' AS _processed_at, 'silver' AS _layer, _ingested_at"""


def _errors(*rules: tuple[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in rules)
    return f"concat_ws(';', {parts})"


def _values(rows: list[tuple]) -> str:
    def text(x: object) -> str:
        return f"'{x}'" if isinstance(x, str) else f"{x}e0"

    return ", ".join(f"({', '.join(text(x) for x in row)})" for row in rows)


def real_date(x: str) -> str:
    return f"(regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast({x} AS date) IS NOT NULL)"


def _score(x: str, bands: list[tuple[float, object]], above: object) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    tests = " ".join(f"WHEN {x} <= {bound} THEN {show(v)}" for bound, v in bands)
    return f"CASE {tests} ELSE {show(above)} END"


def scored(joined: str, places: str) -> str:
    """SELECT that builds fact rows from joined rows and places(name, lat, lon)."""
    t, h = "temperature", "humidity"
    heat = " ".join(
        f"{'+' if c >= 0 else '-'} {abs(c):.16g}e0{f' * ({t} * {t})' if i == 2 else f' * {t}' if i else ''}"
        f"{f' * ({h} * {h})' if j == 2 else f' * {h}' if j else ''}"
        for c, i, j in fv.HEAT_TERMS
    ).replace("e-06e0", "e-06")
    rain = "regexp_matches(lower(weather_condition), 'rain|drizzle|thunderstorm|shower')"
    return f"""SELECT province, date, lat, lon, pm25, temperature, humidity, weather_condition,
      weather_description, flood_risk, affected_area_km2, water_level_m, pm25_score, temp_score,
      flood_score, risk_score, {_score('risk_score', fv.RISK_LEVELS, fv.RISK_LEVEL_ABOVE)} AS risk_level,
      CASE WHEN pm25 IS NULL THEN 'Unknown' ELSE {_score('pm25', fv.PM25_CATEGORIES, fv.PM25_CATEGORY_ABOVE)} END
        AS pm25_category,
      {half_even('felt', 1)} AS heat_index,
      CASE WHEN humidity IS NULL THEN 'Unknown' WHEN humidity < 40 THEN 'Low'
        WHEN humidity <= 70 THEN 'Normal' ELSE 'High' END AS humidity_level,
      CASE WHEN coalesce(weather_condition, '') = '' THEN 'Unknown' WHEN {rain} THEN 'Lower'
        WHEN regexp_matches(lower(weather_condition), 'clear|sunny|hot') THEN 'Higher'
        WHEN regexp_matches(lower(weather_condition), 'cloud|overcast|mist|fog|haze') THEN 'Moderate'
        ELSE 'Neutral' END AS weather_pm25_impact,
      coalesce({rain}, false) AS is_rainy,
      hour_bucket, '{b.RUN_TS}' AS _processed_at, 'gold' AS _layer
    FROM (SELECT *, pm25_score * 0.5e0 + temp_score * 0.2e0 + flood_score * 0.3e0 AS risk_score
      FROM (SELECT j.*, p.lat, p.lon,
        CASE WHEN pm25 IS NULL THEN 0 ELSE {_score('pm25', fv.PM25_SCORES, fv.PM25_SCORE_ABOVE)} END AS pm25_score,
        CASE WHEN {t} IS NULL THEN 0 WHEN {t} < 20 OR {t} > 40 THEN 80
          ELSE {_score(t, fv.TEMPERATURE_SCORES, fv.TEMPERATURE_SCORE_ABOVE)} END AS temp_score,
        CASE flood_risk WHEN 'Low' THEN 20 WHEN 'Medium' THEN 50 WHEN 'High' THEN 80
          WHEN 'Very High' THEN 100 ELSE 0 END AS flood_score,
        CASE WHEN {t} IS NULL OR {h} IS NULL THEN NULL WHEN {t} < 27 OR {h} < 40 THEN {t}
          ELSE {heat} END AS felt
        FROM {joined} j LEFT JOIN {places} p ON j.province = p.name))"""


def daily_latest(silver: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, substring(hour_bucket, 1, 10) AS date, row_number() OVER (
        PARTITION BY province, substring(hour_bucket, 1, 10) ORDER BY hour_bucket DESC, message_id DESC) AS rn
      FROM {silver} WHERE {real_date('substring(hour_bucket, 1, 10)')}) WHERE rn = 1"""


def last_write(cleaned: str, keys: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY _ingested_at DESC, message_id DESC) AS rn FROM {cleaned} WHERE errors = '') WHERE rn = 1"""


def dim_time(dates: str) -> str:
    return f"""SELECT date, cast(year(d) AS int) AS year, cast(quarter(d) AS int) AS quarter,
      cast(month(d) AS int) AS month, monthname(d) AS month_name,
      cast(weekofyear(d) AS int) AS week_of_year, cast(day(d) AS int) AS day,
      dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend, '{b.RUN_TS}' AS _updated_at
    FROM (SELECT DISTINCT date, try_cast(date AS date) AS d FROM {dates} WHERE {real_date('date')})"""


def tables(wide: bool = False) -> dict[str, str]:
    """Every common table expression, in order of dependence."""
    province = b.province(wide)

    def raw(source: str) -> str:
        columns = b.sql({"province": province, **b.FIELDS[source]})
        return f"SELECT {columns} FROM e WHERE {b.SOURCE} = '{source}'"

    return {
        "e": f"SELECT {b.sql(b.BASE)} FROM events",
        "places": "SELECT * FROM (VALUES " + _values(fv.PROVINCES) + ") t(name, lat, lon, weather_query)",
        "stations": f"""SELECT {b.sql(b.STATIONS)} FROM (SELECT event_type, user_id,
          min(event_id) AS first_id FROM e GROUP BY event_type, user_id)""",
        "air_b": raw("air_quality"),
        "wx_b": raw("weather"),
        "fl_b": raw("flood"),
        "air_k": f"""SELECT *, {_errors(('timestamp IS NULL', 'null:timestamp'),
          ('pm25 IS NULL', 'null:pm25'), ('pm25 < 0', 'range:pm25'))} AS errors
          FROM (SELECT {CLEAN_PROVINCE} AS province, timestamp, {hour_bucket('timestamp')} AS hour_bucket,
            try_cast(pm25 AS double) AS pm25, coalesce(unit, 'µg/m³') AS unit, {_lineage()} FROM air_b)""",
        "wx_k": f"""SELECT *, {_errors(('timestamp IS NULL', 'null:timestamp'),
          ('temperature IS NULL', 'null:temperature'),
          ('temperature < -10 OR temperature > 60', 'range:temperature'))} AS errors
          FROM (SELECT {CLEAN_PROVINCE} AS province, timestamp, {hour_bucket('timestamp')} AS hour_bucket,
            try_cast(temperature AS double) AS temperature, try_cast(humidity AS double) AS humidity,
            weather_condition, weather_description, {_lineage()} FROM wx_b)""",
        "fl_k": f"""SELECT *, {_errors(('date IS NULL', 'null:date'),
          ("flood_risk NOT IN ('', 'Low', 'Medium', 'High', 'Very High')", 'category:flood_risk'))} AS errors
          FROM (SELECT {CLEAN_PROVINCE} AS province, date, trim(coalesce(flood_risk, '')) AS flood_risk,
            try_cast(affected_area_km2 AS double) AS affected_area_km2,
            try_cast(water_level_m AS double) AS water_level_m, {_lineage()} FROM fl_b)""",
        "air_s": last_write("air_k", "province, hour_bucket"),
        "wx_s": last_write("wx_k", "province, hour_bucket"),
        "fl_s": last_write("fl_k", "province, date"),
        "a1": daily_latest("air_s"),
        "w1": daily_latest("wx_s"),
        "f1": f"SELECT * FROM fl_s WHERE {real_date('date')}",
        "joined": f"""SELECT coalesce(a1.province, w1.province, f1.province) AS province,
          coalesce(a1.date, w1.date, f1.date) AS date,
          coalesce(a1.hour_bucket, w1.hour_bucket) AS hour_bucket, a1.pm25, w1.temperature, w1.humidity,
          w1.weather_condition, w1.weather_description, f1.flood_risk, f1.affected_area_km2,
          f1.water_level_m, '{b.RUN_TS}' AS _processed_at, 'silver' AS _layer
          FROM a1 FULL OUTER JOIN w1 ON a1.province = w1.province AND a1.date = w1.date
          FULL OUTER JOIN f1 ON coalesce(a1.province, w1.province) = f1.province
            AND coalesce(a1.date, w1.date) = f1.date""",
        "fact": scored("joined", "stations" if wide else "places"),
        "dim_location": f"""SELECT name AS province, lat AS latitude, lon AS longitude,
          'Thailand' AS country, '{b.RUN_TS}' AS _updated_at FROM {'stations' if wide else 'places'}""",
        "dim_time": dim_time("joined"),
        "newest": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY province
          ORDER BY date DESC) AS rn FROM fact) WHERE rn = 1""",
    }


def with_tables(query: str, wide: bool = False, **more: str) -> str:
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in {**tables(wide), **more}.items())
    return f"WITH {ctes}\n{query}"
