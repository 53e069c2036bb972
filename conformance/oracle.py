"""SQL answers for the registered queries, for DuckDB over the same Parquet tables.

Doubles are rounded through DECIMAL, which agrees with Spark's half-up rounding.  Nothing here
comes from the library: a wrong threshold or label there gives other rows than these.
"""

from __future__ import annotations


# --- Fixed values: labels, thresholds and colours -----------------------------------------
class V:
    SEASON_MONTHS = {"Invierno": (12, 1, 2), "Primavera": (3, 4, 5), "Verano": (6, 7, 8), "Otoño": (9, 10, 11)}
    NORMAL, YELLOW, ORANGE, RED = "Normal", "ALERTA AMARILLA", "ALERTA NARANJA", "ALERTA ROJA"
    HEAT_ALERTS = (
        (40, "ALERTA ROJA - Temperatura Extremadamente Alta"), (35, "ALERTA ROJA - Temperatura Muy Alta"),
        (30, "ALERTA NARANJA - Temperatura Alta"), (25, "ALERTA AMARILLA - Temperatura Elevada"),
    )
    COLD_ALERTS = (
        (-10, "ALERTA ROJA - Temperatura Extremadamente Baja"), (-5, "ALERTA NARANJA - Temperatura Baja"),
        (0, "ALERTA AMARILLA - Temperatura Fría"),
    )
    PRECIPITATION_ALERTS = (
        (100, "ALERTA ROJA - Precipitación Extremadamente Alta"), (50, "ALERTA NARANJA - Precipitación Alta"),
        (25, "ALERTA AMARILLA - Precipitación Moderada"),
    )
    HUMID_ABOVE, DRY_BELOW = 95, 20
    HUMID_ALERT, DRY_ALERT = "ALERTA AMARILLA - Humedad Muy Alta", "ALERTA AMARILLA - Humedad Muy Baja"
    # label, severity, maximum above, minimum below, precipitation above
    ALERT_GRADES = (("ALERTA ROJA", 5, 40, -10, 100), ("ALERTA NARANJA", 4, 35, -5, 50), ("ALERTA AMARILLA", 3, 30, 0, 25))
    WARM_ABOVE, MINOR_SEVERITY, NO_SEVERITY = 25, 2, 1
    # label, mean temperature above, total precipitation below
    CLIMATE_CLASSES = (
        ("Clima Mediterráneo Seco", 20, 500), ("Clima Mediterráneo", 18, 800), ("Clima Templado", 15, 1000), ("Clima Fresco", 10, None),
    )
    COLDEST_CLASS = "Clima Frío"
    # score, temperature, precipitation, humidity
    COMFORT_BANDS = (
        (100, (15, 25), (300, 800), (40, 70)), (80, (10, 30), (200, 1000), (30, 80)), (60, (5, 35), (100, 1200), (20, 90)),
    )
    LOWEST_COMFORT = 40
    HOT_DAY_ABOVE, COLD_DAY_BELOW, RAINY_DAY_ABOVE, WINDY_DAY_ABOVE, HUMID_DAY_ABOVE = 30, 0, 10, 30, 80
    MISSING_COLOR, HOTTEST_COLOR, WETTEST_COLOR = "gray", "red", "red"
    TEMPERATURE_COLORS = ((10, "blue"), (20, "green"), (30, "orange"))
    PRECIPITATION_COLORS = ((50, "yellow"), (100, "orange"))
    ALERT_COLORS = {"Normal": "green", "ALERTA AMARILLA": "yellow", "ALERTA NARANJA": "orange", "ALERTA ROJA": "red"}
    CLIMATE_COLORS = {
        "Clima Mediterráneo Seco": "red", "Clima Mediterráneo": "orange", "Clima Templado": "green", "Clima Fresco": "blue",
        "Clima Frío": "purple",
    }


LOAD_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
RAW_COLUMNS = (
    "date, tavg, tmin, tmax, prcp, wdir, wspd, wpgt, pres, snow, tsun, rhum, station, source, city, region, lat, lon"
)
_LANDED = "date, tavg, tmin, tmax, prcp, wdir, wspd, wpgt, pres, snow, tsun, rhum, station, source, city, region"
_LANDED_ORDER = [c for c in _LANDED.split(", ") if c not in ("date", "city", "source")]
STATION_MONTH = "city, region, station, year, month"


def r(value: str, digits: int = 2, scale: str = "28,10") -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL({scale})), {digits}) AS DOUBLE)"


def q(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'" if isinstance(text, str) else str(text)


def case(rules, default) -> str:
    arms = " ".join(f"WHEN {test} THEN {q(value)}" for test, value in rules)
    return f"CASE {arms} ELSE {q(default)} END"


def comma(column: str) -> str:
    return f"REPLACE(CAST({column} AS VARCHAR), '.', ',')"


def days(test: str) -> str:
    return f"COUNT(*) FILTER (WHERE {test})"


_ODD_HUMIDITY = f"humidity_percent > {V.HUMID_ABOVE} OR humidity_percent < {V.DRY_BELOW}"
_GRADES = [
    (label, severity, f"temp_max_c > {hot} OR temp_min_c < {cold} OR precip_mm > {wet}")
    for label, severity, hot, cold, wet in V.ALERT_GRADES
]
_TEMP_RULES = [(f"temp_max_c > {b}", label) for b, label in V.HEAT_ALERTS] + [
    (f"temp_min_c < {b}", label) for b, label in V.COLD_ALERTS
]
_RAIN_RULES = [(f"precip_mm > {b}", label) for b, label in V.PRECIPITATION_ALERTS]
_HUMID_RULES = [
    (f"humidity_percent > {V.HUMID_ABOVE}", V.HUMID_ALERT), (f"humidity_percent < {V.DRY_BELOW}", V.DRY_ALERT)
]
_OVERALL_RULES = [(test, label) for label, _, test in _GRADES] + [(_ODD_HUMIDITY, V.YELLOW)]
_SEVERITY_RULES = [(test, severity) for _, severity, test in _GRADES] + [
    (f"temp_max_c > {V.WARM_ABOVE} OR {_ODD_HUMIDITY}", V.MINOR_SEVERITY)
]
_CLIMATE_RULES = [
    (f"avg_temp_city > {t}" + (f" AND total_precip_city < {p}" if p is not None else ""), label)
    for label, t, p in V.CLIMATE_CLASSES
]
_COMFORT_RULES = [
    (
        " AND ".join(
            f"{column} >= {low} AND {column} <= {high}"
            for column, (low, high) in zip(("avg_temp_city", "total_precip_city", "avg_humidity_city"), bands)
        ),
        score,
    )
    for score, *bands in V.COMFORT_BANDS
]
_SEASON_RULES = [(f"month IN ({', '.join(map(str, months))})", name) for name, months in V.SEASON_MONTHS.items()]

_RANKED = {
    "heat": "avg_temp_city",
    "precip": "total_precip_city",
    "humidity": "avg_humidity_city",
    "wind": "avg_wind_city",
    "sunshine": "total_sunshine_city",
}


def _ranks() -> str:
    def rank(metric: str, by: str) -> str:
        return (
            f"ROW_NUMBER() OVER ({by}ORDER BY {metric} DESC NULLS LAST, city NULLS LAST, region NULLS LAST, "
            "station NULLS LAST, lat NULLS LAST, lon NULLS LAST)"
        )

    return ", ".join(
        f"{rank(metric, '')} AS {name}_rank_overall, {rank(metric, 'PARTITION BY region ')} AS {name}_rank_in_region"
        for name, metric in _RANKED.items()
    )


_SHARES = ", ".join(f"{r(f'{n} * 100.0e0 / total_days')} AS pct_{n}" for n in ("hot_days", "cold_days", "rainy_days", "windy_days"))

def _season_top(months: str, direction: str) -> str:
    return f"""SELECT city, {r('SUM(precip_mm)')} AS insight_precip, mm AS month
FROM (SELECT *, strftime(date, '%m') AS mm FROM silver) AS x WHERE CAST(mm AS INTEGER) IN ({months})
GROUP BY city, mm ORDER BY insight_precip {direction} NULLS LAST, city, month LIMIT 5"""


# name -> (relations it needs, SELECT)
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_rows": (
        (),
        f"""SELECT CAST(l_shipdate AS DATE) AS date, t AS tavg, t - l_linenumber AS tmin, t + l_linenumber AS tmax,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % (10 + l_suppkey % 40) = 0
       THEN FLOOR(l_extendedprice / 800) ELSE 0.0e0 END AS prcp,
  CAST(l_partkey % 360 AS DOUBLE) AS wdir, wind AS wspd, wind * 1.5e0 AS wpgt,
  CAST(990 + l_partkey % 40 AS DOUBLE) AS pres,
  CASE WHEN l_quantity <= 8 THEN CAST(l_linenumber AS DOUBLE) END AS snow,
  CAST(l_partkey % 720 AS DOUBLE) AS tsun,
  CASE WHEN l_linenumber <> 6 THEN
       CAST(LEAST(100, CAST(ROUND(l_discount * 100) AS INTEGER) * 5 + (l_suppkey % 6) * 15) AS DOUBLE) END AS rhum,
  s_name AS station, CASE WHEN l_returnflag = 'N' THEN 'aemet' ELSE 'meteostat' END AS source,
  n_name AS city, r_name AS region,
  CASE WHEN n_nationkey <> 24 THEN 36.0e0 + n_nationkey * 0.25e0 END AS lat,
  CASE WHEN n_nationkey <> 24 THEN -6.0e0 + n_nationkey * 0.5e0 END AS lon, {LOAD_ORDER}
FROM (SELECT *, CASE WHEN l_quantity <> 50 THEN l_quantity * 0.5e0 - 5 + (l_suppkey % 9) * 2 END AS t,
             CAST(CAST(ROUND(l_tax * 100) AS INTEGER) * 5 AS DOUBLE) AS wind FROM lineitem) AS l
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    ),
    "landed": (
        ("raw_rows",),
        """SELECT * REPLACE (CASE WHEN source = 'meteostat' THEN pres END AS pres,
  CASE WHEN source = 'meteostat' THEN snow END AS snow, CASE WHEN source = 'meteostat' THEN tsun END AS tsun),
  CASE WHEN source = 'meteostat' AND l_partkey % 50 = 7 THEN 'corrupt record'
       WHEN source = 'aemet' AND l_partkey % 50 = 1 THEN 'bad date' WHEN l_partkey % 50 = 0 THEN 'bad number'
       WHEN l_suppkey IN (3, 4) THEN 'unknown station' END AS reason FROM raw_rows""",
    ),
    "raw": (
        ("raw_rows",),
        f"""SELECT {RAW_COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, city, source
  ORDER BY {LOAD_ORDER}) AS copy_no FROM raw_rows) AS x WHERE copy_no = 1""",
    ),
    "silver": (
        ("raw",),
        """SELECT date, city, region, station, lat, lon, strftime(date, '%Y') AS year, tavg AS temp_avg_c,
  tmin AS temp_min_c, tmax AS temp_max_c, prcp AS precip_mm, wdir AS wind_dir_deg, wspd AS wind_avg_kmh,
  wpgt AS wind_gust_kmh, pres AS pressure_hpa, snow AS snow_depth_cm, tsun AS sunshine_min,
  rhum AS humidity_percent, source FROM raw
WHERE NOT (date IS NULL OR tavg IS NULL OR tmin IS NULL OR tmax IS NULL)""",
    ),
    "silver_m": (("silver",), "SELECT *, CAST(EXTRACT(MONTH FROM date) AS INTEGER) AS month FROM silver"),
    "summary": (
        ("silver_m",),
        f"""SELECT {STATION_MONTH}, COUNT(*) AS days, {r('AVG(temp_avg_c)')} AS avg_temp,
  {r('MAX(temp_max_c)')} AS max_temp, {r('MIN(temp_min_c)')} AS min_temp, {r('SUM(precip_mm)')} AS total_precip,
  {r('SUM(sunshine_min)')} AS total_sunshine, {r('AVG(humidity_percent)')} AS avg_humidity,
  {r('AVG(lat)', 6)} AS lat, {r('AVG(lon)', 6)} AS lon FROM silver_m GROUP BY {STATION_MONTH}""",
    ),
    "profiles": (
        ("silver",),
        f"""SELECT city, {r('AVG(temp_avg_c)', 1)} AS avg_temp, MAX(temp_max_c) AS record_high,
  MIN(temp_min_c) AS record_low, SUM(precip_mm) AS yearly_precip, AVG(sunshine_min) AS avg_sunshine,
  {r('AVG(humidity_percent)', 1)} AS avg_humidity FROM silver GROUP BY city""",
    ),
    "extreme": (
        ("silver_m",),
        f"""SELECT {STATION_MONTH}, {r('MAX(temp_max_c)')} AS max_temp_month, {r('MIN(temp_min_c)')} AS min_temp_month,
  {r('SUM(precip_mm)')} AS total_precip_month FROM silver_m GROUP BY {STATION_MONTH}""",
    ),
    "monthly": (
        ("silver",),
        f"""SELECT city, year, mm AS month, {r('AVG(temp_avg_c)')} AS avg_temp, SUM(precip_mm) AS total_precip,
  AVG(sunshine_min) AS avg_sunshine, AVG(snow_depth_cm) AS avg_snow_depth
FROM (SELECT *, strftime(date, '%m') AS mm FROM silver) AS x GROUP BY city, year, mm""",
    ),
    "trends": (
        ("silver",),
        f"SELECT city, year, {r('AVG(temp_avg_c)')} AS avg_temp, SUM(precip_mm) AS total_precip FROM silver GROUP BY city, year",
    ),
    "seasonal": (
        ("silver",),
        f"""SELECT {STATION_MONTH}, {case(_SEASON_RULES, None)} AS season, AVG(temp_avg_c) AS avg_temp_season,
  MAX(temp_max_c) AS max_temp_season, MIN(temp_min_c) AS min_temp_season, SUM(precip_mm) AS total_precip_season,
  AVG(humidity_percent) AS avg_humidity_season, AVG(wind_avg_kmh) AS avg_wind_season,
  AVG(pressure_hpa) AS avg_pressure_season, SUM(sunshine_min) AS total_sunshine_season,
  AVG(snow_depth_cm) AS avg_snow_season, COUNT(*) AS total_days,
  {days(f'temp_max_c > {V.HOT_DAY_ABOVE}')} AS hot_days, {days(f'temp_min_c < {V.COLD_DAY_BELOW}')} AS cold_days,
  {days(f'precip_mm > {V.RAINY_DAY_ABOVE}')} AS rainy_days, {days(f'wind_avg_kmh > {V.WINDY_DAY_ABOVE}')} AS windy_days,
  {days(f'humidity_percent > {V.HUMID_DAY_ABOVE}')} AS humid_days,
  {r('STDDEV_SAMP(temp_avg_c)', 6, '38,14')} AS temp_variability,
  QUANTILE_CONT(temp_avg_c, 0.75) AS temp_75th_percentile, QUANTILE_CONT(temp_avg_c, 0.25) AS temp_25th_percentile
FROM (SELECT * EXCLUDE (year), CAST(EXTRACT(YEAR FROM date) AS BIGINT) AS year,
             CAST(EXTRACT(MONTH FROM date) AS BIGINT) AS month FROM silver) AS x GROUP BY {STATION_MONTH}""",
    ),
    "alerts": (
        ("silver",),
        f"""SELECT city, region, station, date, CAST(EXTRACT(YEAR FROM date) AS BIGINT) AS year,
  CAST(EXTRACT(MONTH FROM date) AS BIGINT) AS month, temp_max_c AS temp_max, temp_min_c AS temp_min, precip_mm,
  humidity_percent, wind_avg_kmh, pressure_hpa, sunshine_min, {case(_TEMP_RULES, V.NORMAL)} AS temperature_alert,
  {case(_RAIN_RULES, V.NORMAL)} AS precipitation_alert, {case(_HUMID_RULES, V.NORMAL)} AS humidity_alert,
  {case(_OVERALL_RULES, V.NORMAL)} AS overall_alert,
  CAST({case(_SEVERITY_RULES, V.NO_SEVERITY)} AS INTEGER) AS alert_severity, source
FROM silver WHERE {case(_SEVERITY_RULES, V.NO_SEVERITY)} >= {V.MINOR_SEVERITY}""",
    ),
    "profile": (
        ("silver",),
        f"""SELECT city, region, station, lat, lon, AVG(temp_avg_c) AS avg_temp_city, MAX(temp_max_c) AS max_temp_city,
  MIN(temp_min_c) AS min_temp_city, SUM(precip_mm) AS total_precip_city, AVG(humidity_percent) AS avg_humidity_city,
  AVG(wind_avg_kmh) AS avg_wind_city, AVG(pressure_hpa) AS avg_pressure_city, SUM(sunshine_min) AS total_sunshine_city,
  COUNT(*) AS total_days, {days(f'temp_max_c > {V.HOT_DAY_ABOVE}')} AS hot_days,
  {days(f'temp_min_c < {V.COLD_DAY_BELOW}')} AS cold_days, {days(f'precip_mm > {V.RAINY_DAY_ABOVE}')} AS rainy_days,
  {days(f'wind_avg_kmh > {V.WINDY_DAY_ABOVE}')} AS windy_days
FROM silver WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city, region, station, lat, lon""",
    ),
    "comparison": (
        ("profile",),
        f"""SELECT *, {case(_CLIMATE_RULES, V.COLDEST_CLASS)} AS climate_classification, {_ranks()}, {_SHARES},
  CAST({case(_COMFORT_RULES, V.LOWEST_COMFORT)} AS INTEGER) AS climate_comfort_score FROM profile""",
    ),
    "wettest_summer": (("silver",), _season_top("6, 7, 8", "DESC")),
    "driest_winter": (("silver",), _season_top("12, 1, 2", "ASC")),
    "places": (
        ("silver",),
        "SELECT city, MIN(lat) AS lat, MIN(lon) AS lon FROM silver WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city",
    ),
    "cities": (
        (),
        """SELECT n_name AS city, r_name AS region, 36.0e0 + n_nationkey * 0.25e0 AS lat, -6.0e0 + n_nationkey * 0.5e0 AS lon
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 24""",
    ),
    # station positions from the numbers behind the degree-minute-second texts
    "stations": (
        (),
        """SELECT s_name AS station, s_suppkey AS pos,
  CASE WHEN s_suppkey % 25 <> 24 THEN
       36 + s_suppkey % 8 + (s_suppkey * 7 % 60) / 60.0e0 + (s_suppkey * 11 % 60) / 3600.0e0 END AS lat,
  (CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END)
       * (s_suppkey % 10 + (s_suppkey * 13 % 60) / 60.0e0 + (s_suppkey * 17 % 60) / 3600.0e0) AS lon FROM supplier""",
    ),
    "grid": (
        ("extreme",),
        """SELECT c.city, y.year, m.month FROM (SELECT DISTINCT city FROM extreme) AS c,
  (SELECT DISTINCT year FROM extreme) AS y, (SELECT DISTINCT month FROM extreme) AS m""",
    ),
    "missing": (("grid",), "SELECT * FROM grid EXCEPT SELECT city, year, month FROM extreme"),
}


def answer(select: str, *needs: str) -> str:
    """``select`` after the relations it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in RELATIONS[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n][1]})" for n in ordered) + "\n" + select


def _city_lines(relation: str) -> str:
    return answer(
        f"""SELECT city, year, {r('AVG(avg_temp)', 6)} AS avg_temp FROM {relation}
WHERE city IN (SELECT DISTINCT city FROM {relation} ORDER BY city LIMIT 5) GROUP BY city, year""",
        relation,
    )


def _histogram(column: str, relation: str = "summary") -> str:
    width = f"(hi - lo) / {20}"
    return answer(
        f"""SELECT bin, {r(f'lo + bin * ({width})', 6)} AS bin_start, {r(f'lo + (bin + 1) * ({width})', 6)} AS bin_end,
  COUNT(*) AS "rows" FROM (SELECT lo, hi, CAST(LEAST(FLOOR(({column} - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin
  FROM {relation}, (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {relation}) AS e WHERE {column} IS NOT NULL) AS b
GROUP BY bin, lo, hi""",
        relation,
    )


def _kpi_change(value: str) -> str:
    return f"(SELECT {value} FROM y WHERE rk = 1) - (SELECT {value} FROM y WHERE rk = 2)"


def _kpis() -> str:
    body = answer("", "summary")
    return body + f""",
y AS (SELECT year, AVG(avg_temp) AS t, SUM(total_precip) AS p, AVG(avg_humidity) AS h,
  ROW_NUMBER() OVER (ORDER BY year DESC) AS rk FROM summary GROUP BY year)
SELECT {r('AVG(avg_temp)', 6)} AS avg_temp, {r(_kpi_change('t'), 6)} AS temp_change,
  {r('SUM(total_precip)', 6)} AS total_precip, {r(_kpi_change('p'), 6)} AS precip_change,
  {r('AVG(avg_humidity)', 6)} AS avg_humidity, {r(_kpi_change('h'), 6)} AS humidity_change,
  CAST(0 AS BIGINT) AS active_alerts, CAST(0 AS BIGINT) AS alert_change FROM summary"""


def _kpis_alerts() -> str:
    body = answer("", "alerts")
    return body + f"""
SELECT 0.0e0 AS avg_temp, 0.0e0 AS temp_change, 0.0e0 AS total_precip, 0.0e0 AS precip_change, 0.0e0 AS avg_humidity,
  0.0e0 AS humidity_change, COUNT(*) FILTER (WHERE overall_alert <> '{V.NORMAL}') AS active_alerts,
  CAST(0 AS BIGINT) AS alert_change FROM alerts"""


def _mean(relation: str, key: str, column: str) -> str:
    return answer(f"SELECT {key}, {r(f'AVG({column})', 6)} AS {column} FROM {relation} GROUP BY {key}", relation)


def _counts(relation: str, column: str) -> str:
    return answer(
        f'SELECT {column}, COUNT(*) AS "rows" FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column}', relation
    )


_SEASON_MEASURES = ("avg_temp_season", "total_precip_season", "avg_humidity_season")


def _season_profile() -> str:
    means = ", ".join(f"{r(f'AVG({m})', 6)} AS {m}" for m in _SEASON_MEASURES)
    return answer(f"SELECT season, {means} FROM seasonal GROUP BY season", "seasonal")


def _season_radar() -> str:
    means = ", ".join(f"AVG({m}) AS {m}" for m in _SEASON_MEASURES)
    scaled = ", ".join(
        f"{r(f'({m} - MIN({m}) OVER ()) / (MAX({m}) OVER () - MIN({m}) OVER ()) * 100', 6)} AS {m}"
        for m in _SEASON_MEASURES
    )
    return answer(
        f"SELECT season, {scaled} FROM (SELECT season, {means} FROM seasonal GROUP BY season) AS p", "seasonal"
    )


_CAPITAL = "UPPER(SUBSTR(s.city, 1, 1)) || LOWER(SUBSTR(s.city, 2))"


def _bands(column: str, table, top: str) -> str:
    return case([(f"{column} IS NULL", V.MISSING_COLOR)] + [(f"{column} < {b}", c) for b, c in table], top)


def _lookup(column: str, table: dict[str, str]) -> str:
    return case([(f"{column} = {q(k)}", c) for k, c in table.items()], V.MISSING_COLOR)


def _clamp(column: str, divisor: int, low: int, high: int, missing: int) -> str:
    inner = f"GREATEST({low}, LEAST({high}, CAST(TRUNC({column} / {divisor}) AS INTEGER)))"
    return f"CAST(CASE WHEN {column} IS NULL THEN {missing} ELSE {inner} END AS INTEGER)"


def _map(relation: str, columns: str) -> str:
    return answer(f"SELECT s.city, p.lat, p.lon, {columns} FROM {relation} AS s JOIN places AS p ON s.city = p.city", relation, "places")


_DISPLAY_SUMMARY = {
    "city": "Ciudad", "region": "Región", "year": "Año", "month": "Mes", "avg_temp": "Temp. Promedio (°C)",
    "total_precip": "Precipitación Total (mm)", "avg_humidity": "Humedad Promedio (%)", "total_sunshine": "Horas Sol",
    "station": "Estación", "lat": "Latitud", "lon": "Longitud",
}
_TWO_DECIMALS = ("lat", "lon")


def _coverage(keys: str) -> str:
    head = keys + ", " if keys else ""
    tail = f" GROUP BY {keys}" if keys else ""
    located = "COUNT(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL)"
    return answer(
        f"SELECT {head}COUNT(*) AS total_rows, {located} AS with_coordinates, "
        f"{r(f'{located} * 100.0e0 / COUNT(*)', 1)} AS coverage_pct FROM raw{tail}",
        "raw",
    )


def _row_count(name: str, relation: str) -> str:
    return f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {relation}"


_LOG_LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END"
_LOG_TAG = (
    "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'CACHE' WHEN 'click' THEN 'DB' "
    "WHEN 'signup' THEN 'START' ELSE 'SUCCESS' END"
)

_TRAILING = """SELECT DISTINCT event_type AS source, ts, COUNT(*) OVER (PARTITION BY event_type, ts) AS requests,
  COUNT(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)
  AS trailing_requests FROM events"""

_RANGES = """SELECT s_name AS station, DATE '1995-01-01' + CAST(s_suppkey % 700 AS INTEGER) AS a,
  DATE '1995-01-01' + CAST(s_suppkey % 700 + s_suppkey * 37 % 1500 AS INTEGER) AS b FROM supplier"""


def statements() -> dict[str, str]:
    normalised = "date, tavg, tmin, tmax, prcp, wdir, wspd, wpgt, rhum, station, source, city, region"
    return {
        # ---- bronze
        "bronze_union_sources": answer(
            f"""SELECT {RAW_COLUMNS.replace('pres, snow, tsun', "CASE WHEN source = 'meteostat' THEN pres END AS pres, "
            "CASE WHEN source = 'meteostat' THEN snow END AS snow, CASE WHEN source = 'meteostat' THEN tsun END AS tsun")}
FROM raw_rows""",
            "raw_rows",
        ),
        "bronze_dedup_pk": answer("SELECT * FROM raw", "raw"),
        "bronze_upsert": answer("", "raw_rows")
        + f""",
first_of AS (SELECT *, l_linenumber >= 4 AS incoming, ROW_NUMBER() OVER (PARTITION BY date, city, source,
  l_linenumber >= 4 ORDER BY {LOAD_ORDER}) AS n FROM raw_rows)
SELECT {RAW_COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, city, source ORDER BY incoming DESC) AS k
  FROM first_of WHERE n = 1) AS x WHERE k = 1""",
        "bronze_second_load": answer("", "raw_rows")
        + f""",
first_of AS (SELECT *, l_linenumber >= 4 AS incoming, ROW_NUMBER() OVER (PARTITION BY date, city, source,
  l_linenumber >= 4 ORDER BY {LOAD_ORDER}) AS n FROM raw_rows)
SELECT {RAW_COLUMNS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, city, source ORDER BY incoming DESC) AS k
  FROM first_of WHERE n = 1) AS x WHERE k = 1""",
        "raw_rows_by_manifest": answer("SELECT strftime(date, '%Y-%m') AS ym, COUNT(*) AS row_count FROM raw GROUP BY 1", "raw"),
        "station_inventory_file": answer(f"SELECT station, {r('lat', 6)} AS lat, {r('lon', 6)} AS lon FROM stations", "stations"),
        "bronze_coord_enrich": answer(
            """SELECT raw.* EXCLUDE (lat, lon), c.lat, c.lon FROM raw LEFT JOIN cities AS c ON raw.city = c.city""",
            "raw", "cities",
        ),
        "provider_a_normalize": answer(
            f"SELECT {normalised} FROM raw_rows WHERE source = 'aemet' AND l_partkey % 50 > 1", "raw_rows"
        ),
        "provider_a_rejects": answer(
            f"""SELECT CASE WHEN l_partkey % 50 = 1 THEN '2024/13/01' ELSE CAST(date AS VARCHAR) END AS fecha,
  {comma('tavg')} AS tmed, {comma('tmin')} AS tmin, CASE WHEN l_partkey % 50 = 0 THEN 'abc' ELSE {comma('tmax')} END AS tmax,
  COALESCE({comma('prcp')}, 'Ip') AS prec, {comma('wdir')} AS dir, {comma('wspd')} AS velmedia, {comma('wpgt')} AS racha,
  COALESCE({comma('rhum')}, 'null') AS "hrMedia",
  station, CASE WHEN l_partkey % 50 = 1 THEN 'bad date' ELSE 'bad number' END AS reason FROM raw_rows WHERE source = 'aemet' AND l_partkey % 50 <= 1""",
            "raw_rows",
        ),
        "provider_b_normalize": answer(
            f"SELECT {normalised}, pres, snow, tsun FROM raw_rows WHERE source = 'meteostat' AND l_partkey % 50 <> 0",
            "raw_rows",
        ),
        "bronze_job_raw": answer(
            f"""SELECT x.* EXCLUDE (copy_no), c.lat, c.lon FROM (SELECT {_LANDED}, ROW_NUMBER() OVER (
  PARTITION BY date, city, source ORDER BY {', '.join(f'{c} NULLS LAST' for c in _LANDED_ORDER)}) AS copy_no
  FROM landed WHERE reason IS NULL) AS x LEFT JOIN cities AS c ON x.city = c.city WHERE copy_no = 1""",
            "landed", "cities",
        ),
        "bronze_job_rejects": answer(
            """SELECT source, CASE WHEN reason <> 'corrupt record' THEN station END AS station, reason, TRUE AS has_record
FROM landed WHERE reason IS NOT NULL""",
            "landed",
        ),
        "bronze_job_report": answer(
            """SELECT source, COUNT(*) AS read_rows, COUNT(DISTINCT k) AS kept_rows, COUNT(k) - COUNT(DISTINCT k) AS merged_rows,
  COUNT(reason) - COUNT(*) FILTER (WHERE reason = 'unknown station') AS rejected_rows,
  COUNT(*) FILTER (WHERE reason = 'unknown station') AS unmatched_rows
FROM (SELECT *, CASE WHEN reason IS NULL THEN CAST(date AS VARCHAR) || city END AS k FROM landed) AS x GROUP BY source""",
            "landed",
        ),
        "bronze_job_cities": answer(
            """SELECT source, city, COUNT(*) AS loaded_rows, MIN(date) AS first_day, MAX(date) AS last_day FROM landed
WHERE reason IS NULL GROUP BY source, city""",
            "landed",
        ),
        "bronze_repeated_cities": answer(
            """SELECT raw.* EXCLUDE (lat, lon), c.lat, c.lon FROM raw LEFT JOIN cities AS c ON raw.city = c.city""",
            "raw", "cities",
        ),
        "dms_to_decimal": answer(f"SELECT station, {r('lat', 6)} AS lat, {r('lon', 6)} AS lon FROM stations", "stations"),
        "station_coord_lookup": answer(
            f"SELECT raw.* EXCLUDE (lat, lon), {r('s.lat', 6)} AS lat, {r('s.lon', 6)} AS lon "
            "FROM raw LEFT JOIN stations AS s ON raw.station = s.station",
            "raw", "stations",
        ),
        "nearest_station": answer(
            f"""SELECT city, station, {r('d', 6)} AS distance FROM (SELECT c.city, s.station, d, ROW_NUMBER() OVER (
  PARTITION BY c.city ORDER BY d, pos) AS n FROM cities AS c, stations AS s,
  LATERAL (SELECT SQRT((c.lat - s.lat) * (c.lat - s.lat) + (c.lon - s.lon) * (c.lon - s.lon)) AS d) AS x
  WHERE s.lat IS NOT NULL) AS y WHERE n = 1""",
            "cities", "stations",
        ),
        "backfill_windows": f"""SELECT station, CAST(k + 1 AS INTEGER) AS window_no,
  CASE WHEN k = 0 THEN a ELSE CAST(date_trunc('month', a) + k * INTERVAL 6 MONTHS AS DATE) END AS window_start,
  CASE WHEN apart <= 6 THEN b
       ELSE LEAST(b, CAST(date_trunc('month', a) + (k + 1) * INTERVAL 6 MONTHS AS DATE) - 1) END AS window_end
FROM (SELECT *, UNNEST(generate_series(0, CASE WHEN apart <= 6 THEN 0 ELSE apart // 6 END)) AS k FROM
  (SELECT *, datediff('month', a, b) AS apart FROM ({_RANGES}) AS q) AS p) AS w""",
        "city_slugs": "SELECT n_name AS city, REPLACE(LOWER(n_name), ' ', '_') AS slug FROM nation",
        # ---- silver
        "silver_weather_cleaned": answer("SELECT * FROM silver", "silver"),
        "silver_snapshot": answer("SELECT *, TIMESTAMP '2025-01-02 00:00:00' AS snapshot_timestamp FROM silver", "silver"),
        # ---- gold
        "gold_city_yearly_summary": answer("SELECT * FROM summary", "summary"),
        "gold_climate_profiles": answer("SELECT * FROM profiles", "profiles"),
        "gold_city_extreme_days": answer("SELECT * FROM extreme", "extreme"),
        "gold_monthly_stats": answer("SELECT * FROM monthly", "monthly"),
        "gold_weather_trends": answer("SELECT * FROM trends", "trends"),
        "gold_seasonal_analysis": answer("SELECT * FROM seasonal", "seasonal"),
        "gold_weather_alerts": answer("SELECT * FROM alerts", "alerts"),
        "gold_climate_comparison": answer("SELECT * FROM comparison", "comparison"),
        "gold_climate_comparison_by_range": answer("SELECT * FROM comparison", "comparison"),
        "gold_layer_from_months": answer(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, {r(f'SUM({measure})', 6)} AS total FROM {relation}"
                for name, relation, measure in (
                    ("city_yearly_summary", "summary", "days"), ("climate_profiles", "profiles", "yearly_precip"),
                    ("city_extreme_days", "extreme", "total_precip_month"), ("monthly_stats", "monthly", "total_precip"),
                    ("weather_trends", "trends", "total_precip"), ("seasonal_analysis", "seasonal", "temp_75th_percentile"),
                    ("min_precipitation", "wettest_summer", "insight_precip"),
                    ("max_precipitation", "driest_winter", "insight_precip"),
                )
            ),
            "summary", "profiles", "extreme", "monthly", "trends", "seasonal", "wettest_summer", "driest_winter",
        ),
        **{
            f"months_{name}": answer(f"SELECT * FROM {relation}", relation)
            for name, relation in {
                "city_yearly_summary": "summary", "climate_profiles": "profiles", "city_extreme_days": "extreme",
                "monthly_stats": "monthly", "weather_trends": "trends", "seasonal_analysis": "seasonal",
                "min_precipitation": "wettest_summer", "max_precipitation": "driest_winter",
            }.items()
        },
        "gold_season_quartiles": answer(
            f"""SELECT city, {case(_SEASON_RULES, None)} AS season, QUANTILE_CONT(temp_avg_c, 0.75) AS temp_75th_percentile,
  QUANTILE_CONT(temp_avg_c, 0.25) AS temp_25th_percentile FROM silver_m GROUP BY 1, 2""",
            "silver_m",
        ),
        "gold_months_refreshed": answer("SELECT * FROM summary", "summary"),
        "first_weather_alerts": answer(
            "SELECT * FROM alerts ORDER BY date DESC NULLS LAST, alert_severity DESC NULLS LAST, city, station, source LIMIT 40", "alerts"
        ),
        "first_climate_comparison": answer(
            "SELECT * FROM comparison ORDER BY region NULLS LAST, avg_temp_city DESC NULLS LAST, city, station LIMIT 40", "comparison"
        ),
        "gold_min_precipitation": answer("SELECT * FROM wettest_summer", "wettest_summer"),
        "gold_max_precipitation": answer("SELECT * FROM driest_winter", "driest_winter"),
        # ---- serving
        "filter_options": answer(
            """SELECT 'years' AS option, year AS value FROM summary UNION SELECT 'months', LPAD(CAST(month AS VARCHAR), 2, '0')
FROM summary UNION SELECT 'regions', region FROM summary UNION SELECT 'cities', city FROM summary UNION """
            + " UNION ".join(f"SELECT 'seasons', {q(s)}" for s in V.SEASON_MONTHS)
            + " UNION "
            + " UNION ".join(f"SELECT 'alert_levels', {q(a)}" for a in (V.NORMAL, V.YELLOW, V.ORANGE, V.RED)),
            "summary",
        ),
        "filter_options_region": answer(
            "SELECT DISTINCT city FROM summary WHERE region = 'EUROPE'", "summary"
        ),
        "filter_summary": answer(
            """SELECT * FROM summary WHERE CAST(year AS INTEGER) IN (1996, 1997) AND month IN (1, 2, 7)
AND region IN ('EUROPE', 'ASIA') AND avg_temp >= 5 AND avg_temp <= 20 AND total_precip <= 500""",
            "summary",
        ),
        "filter_alerts": answer(
            f"""SELECT * FROM alerts WHERE overall_alert = '{V.RED}' AND source = 'aemet'
AND date >= DATE '1997-01-01' AND date <= DATE '1998-06-30' AND precip_mm <= 120""",
            "alerts",
        ),
        "filter_seasonal": answer(
            "SELECT * FROM seasonal WHERE season = 'Verano' AND avg_temp_season >= 0", "seasonal"
        ),
        "filter_silver": answer(
            """SELECT * FROM silver WHERE CAST(year AS INTEGER) = 1999 AND city IN ('NATION_1', 'NATION_3', 'NATION_24')
AND temp_max_c >= 30 AND source = 'meteostat'""",
            "silver",
        ),
        "page_summary": answer(
            """SELECT * FROM summary WHERE region = 'AFRICA' ORDER BY total_precip DESC NULLS LAST, city, region, station,
  year, month LIMIT 50 OFFSET 100""",
            "summary",
        ),
        "page_deep": answer(
            "SELECT * FROM alerts ORDER BY alert_severity DESC NULLS LAST, city, date, source LIMIT 500 OFFSET 9500",
            "alerts",
        ),
        "page_each_order": answer(
            " UNION ALL ".join(
                f"(SELECT *, '{c}' AS sorted_by, {up} AS ascending FROM summary ORDER BY {c} {'ASC' if up else 'DESC'} NULLS LAST, "
                "city, region, station, year, month LIMIT 3)"
                for c in ("city", "year", "month", "avg_temp", "total_precip", "avg_humidity")
                for up in (True, False)
            ),
            "summary",
        ),
        "page_after_key": answer(
            """SELECT * FROM trends WHERE city > 'NATION_15' OR (city = 'NATION_15' AND year > '1998')
ORDER BY city, year LIMIT 50""",
            "trends",
        ),
        "page_metadata": answer(
            """SELECT CAST(3 AS BIGINT) AS current_page, (n + 49) // 50 AS total_pages, n AS total_items,
  CAST(50 AS BIGINT) AS items_per_page, 3 < (n + 49) // 50 AS has_next, TRUE AS has_prev,
  CAST(CASE WHEN n > 100 THEN 101 ELSE 0 END AS BIGINT) AS start_item, CASE WHEN n > 100 THEN LEAST(150, n) ELSE 0 END AS end_item
FROM (SELECT COUNT(*) AS n FROM summary WHERE region = 'AFRICA') AS c""",
            "summary",
        ),
        "table_display": answer(
            "SELECT "
            + ", ".join(
                f'{r(c) if c in _TWO_DECIMALS else c} AS "{label}"' for c, label in _DISPLAY_SUMMARY.items()
            )
            + " FROM summary",
            "summary",
        ),
        "kpis": _kpis(),
        "kpis_alerts": _kpis_alerts(),
        "city_overview": answer(
            f"""SELECT city, {r('AVG(avg_temp)')} AS avg_temp, {r('COALESCE(SUM(total_precip), 0)')} AS total_precip,
  {r('AVG(avg_humidity)')} AS avg_humidity, COUNT(year) AS records FROM summary GROUP BY city""",
            "summary",
        ),
        "temp_by_year": _mean("summary", "year", "avg_temp"),
        "temp_by_month": _mean("summary", "month", "avg_temp"),
        "temp_by_city_year": answer(
            f"""SELECT city, year, {r('AVG(avg_temp)', 6)} AS avg_temp FROM summary
WHERE city IN (SELECT DISTINCT city FROM summary ORDER BY city LIMIT 5) GROUP BY city, year""",
            "summary",
        ),
        "temp_histogram": _histogram("avg_temp"),
        "precip_by_year": answer(
            f"SELECT year, {r('COALESCE(SUM(total_precip), 0)', 6)} AS total_precip FROM summary GROUP BY year", "summary"
        ),
        "precip_by_month": _mean("summary", "month", "total_precip"),
        "rainy_periods_by_city": answer(
            "SELECT city, COUNT(*) AS rainy_periods FROM summary WHERE total_precip > 0 GROUP BY city", "summary"
        ),
        "precip_histogram": _histogram("total_precip"),
        "trend_temp_by_year": _mean("trends", "year", "avg_temp"),
        "season_profile": _season_profile(),
        "season_radar": _season_radar(),
        "alerts_by_level": _counts("alerts", "overall_alert"),
        "alerts_by_severity": _counts("alerts", "alert_severity"),
        "alerts_top_cities": answer(
            'SELECT city, COUNT(*) AS "rows" FROM alerts GROUP BY city ORDER BY COUNT(*) DESC, city LIMIT 10', "alerts"
        ),
        "alerts_by_month": answer(
            "SELECT strftime(date, '%Y-%m') AS month_year, COUNT(*) AS alerts FROM alerts GROUP BY 1", "alerts"
        ),
        "climate_class_counts": _counts("comparison", "climate_classification"),
        "comparison_by_temp": answer("SELECT city, station, avg_temp_city FROM comparison", "comparison"),
        "comparison_by_precip": answer("SELECT city, station, total_precip_city FROM comparison", "comparison"),
        "comparison_scatter": answer("SELECT city, avg_temp_city, total_precip_city FROM comparison", "comparison"),
        # ---- every chart of every topic
        "topic_trends_temp_by_year": _mean("trends", "year", "avg_temp"),
        "topic_trends_temp_histogram": _histogram("avg_temp", "trends"),
        "topic_trends_temp_by_city_year": _city_lines("trends"),
        "topic_temperature_temp_by_year": _mean("summary", "year", "avg_temp"),
        "topic_temperature_temp_histogram": _histogram("avg_temp"),
        "topic_temperature_temp_by_month": _mean("summary", "month", "avg_temp"),
        "topic_temperature_temp_by_city_year": _city_lines("summary"),
        "topic_precipitation_precip_by_year": answer(
            f"SELECT year, {r('COALESCE(SUM(total_precip), 0)', 6)} AS total_precip FROM summary GROUP BY year", "summary"
        ),
        "topic_precipitation_precip_by_month": _mean("summary", "month", "total_precip"),
        "topic_precipitation_rainy_periods_by_city": answer(
            "SELECT city, COUNT(*) AS rainy_periods FROM summary WHERE total_precip > 0 GROUP BY city", "summary"
        ),
        "topic_precipitation_precip_histogram": _histogram("total_precip"),
        "topic_seasonal_season_profile": _season_profile(),
        "topic_seasonal_season_radar": _season_radar(),
        "topic_alerts_alerts_by_level": _counts("alerts", "overall_alert"),
        "topic_alerts_alerts_by_severity": _counts("alerts", "alert_severity"),
        "topic_alerts_alerts_top_cities": answer(
            'SELECT city, COUNT(*) AS "rows" FROM alerts GROUP BY city ORDER BY COUNT(*) DESC, city LIMIT 10', "alerts"
        ),
        "topic_alerts_alerts_by_month": answer(
            "SELECT strftime(date, '%Y-%m') AS month_year, COUNT(*) AS alerts FROM alerts GROUP BY 1", "alerts"
        ),
        "topic_comparison_comparison_by_temp": answer(
            f"SELECT city, station, {r('avg_temp_city', 6)} AS avg_temp_city FROM comparison", "comparison"
        ),
        "topic_comparison_comparison_by_precip": answer(
            f"SELECT city, station, {r('total_precip_city', 6)} AS total_precip_city FROM comparison", "comparison"
        ),
        "topic_comparison_climate_class_counts": _counts("comparison", "climate_classification"),
        "topic_comparison_comparison_scatter": answer(
            f"SELECT city, {r('avg_temp_city', 6)} AS avg_temp_city, {r('total_precip_city', 6)} AS total_precip_city FROM comparison",
            "comparison",
        ),
        # ---- maps
        "map_temperature": _map(
            "summary",
            f"""{_CAPITAL} || ': ' || COALESCE(CAST(s.avg_temp AS VARCHAR), 'N/A') || '°C' AS label, s.avg_temp AS value, {_bands('s.avg_temp', V.TEMPERATURE_COLORS, V.HOTTEST_COLOR)} AS color,
  {_clamp('s.avg_temp', 3, 5, 15, 5)} AS radius, s.avg_temp, s.max_temp, s.min_temp, s.total_precip, s.avg_humidity,
  s.year, s.month""",
        ),
        "map_precipitation": _map(
            "summary",
            f"""{_CAPITAL} || ': ' || COALESCE(CAST(s.total_precip AS VARCHAR), 'N/A') || ' mm' AS label,
  s.total_precip AS value, {_bands('s.total_precip', V.PRECIPITATION_COLORS, V.WETTEST_COLOR)} AS color,
  {_clamp('s.total_precip', 10, 5, 20, 5)} AS radius, s.total_precip, s.avg_temp, s.avg_humidity, s.total_sunshine,
  s.year, s.month""",
        ),
        "map_alerts": _map(
            "alerts",
            f"""{_lookup('s.overall_alert', V.ALERT_COLORS)} AS color, 8 + 2 * s.alert_severity AS radius,
  {_CAPITAL} || ': ' || s.overall_alert AS label, s.overall_alert, s.temperature_alert, s.precipitation_alert,
  s.humidity_alert, s.alert_severity, s.date, s.temp_max, s.precip_mm""",
        ),
        "map_comparison": _map(
            "comparison",
            f"""{_lookup('s.climate_classification', V.CLIMATE_COLORS)} AS color,
  {_clamp('s.avg_temp_city', 2, 6, 18, 8)} AS radius, {_CAPITAL} || ': ' || s.climate_classification AS label,
  s.station, s.avg_temp_city, s.total_precip_city, s.avg_humidity_city, s.climate_classification,
  s.heat_rank_in_region, s.precip_rank_in_region, s.hot_days, s.rainy_days""",
        ),
        "map_columns_precipitation": answer(
            "SELECT city, year, month, total_precip, lat, lon FROM summary", "summary"
        ),
        "dim_city_coordinates": answer(
            "SELECT DISTINCT city, lat, lon FROM silver WHERE lat IS NOT NULL AND lon IS NOT NULL", "silver"
        ),
        # ---- data quality
        "dq_coverage_overall": _coverage(""),
        "dq_coverage_by_city": _coverage("city"),
        "dq_coverage_by_source": _coverage("source"),
        "dq_extent": answer(
            """SELECT city, source, COUNT(*) AS located_rows, MIN(lat) AS lat_min, MAX(lat) AS lat_max, MIN(lon) AS lon_min,
  MAX(lon) AS lon_max FROM raw WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city, source""",
            "raw",
        ),
        "dq_station_counts": answer(
            """SELECT city, station, lat, lon, source, COUNT(*) AS station_rows FROM silver
WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city, station, lat, lon, source""",
            "silver",
        ),
        "dq_station_counts_raw": answer(
            """SELECT city, station, lat, lon, source, COUNT(*) AS station_rows FROM raw
WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY city, station, lat, lon, source""",
            "raw",
        ),
        "dq_source_counts": answer(
            "SELECT source, COUNT(*) AS source_rows, COUNT(DISTINCT city) AS cities FROM raw GROUP BY source", "raw"
        ),
        "dq_row_counts": answer(
            " UNION ALL ".join(
                _row_count(name, relation)
                for name, relation in {
                    "city_yearly_summary": "summary", "climate_profiles": "profiles", "city_extreme_days": "extreme",
                    "monthly_stats": "monthly", "weather_trends": "trends", "seasonal_analysis": "seasonal",
                    "weather_alerts": "alerts", "climate_comparison": "comparison",
                    "min_precipitation": "wettest_summer", "max_precipitation": "driest_winter",
                }.items()
            ),
            "summary", "profiles", "extreme", "monthly", "trends", "seasonal", "alerts", "comparison", "wettest_summer",
            "driest_winter",
        ),
        "dq_null_counts": answer(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM extreme"
                for c in ("max_temp_month", "min_temp_month", "total_precip_month")
            ),
            "extreme",
        ),
        "dq_missing_months": answer("SELECT * FROM missing", "missing"),
        "dq_missing_detail": answer(
            """SELECT city, year, month, max_temp_month, min_temp_month, total_precip_month
FROM grid LEFT JOIN extreme USING (city, year, month)
WHERE city IN (SELECT city FROM missing) AND year IN (SELECT year FROM missing) AND month IN (SELECT month FROM missing)
  AND (max_temp_month IS NULL OR min_temp_month IS NULL OR total_precip_month IS NULL)""",
            "missing",
        ),
        "dq_first_rows": answer(
            " UNION ALL ".join(
                f"(SELECT * FROM silver WHERE source = '{s}' ORDER BY city, date, year, station LIMIT 3)"
                for s in ("aemet", "meteostat")
            ),
            "silver",
        ),
        "dq_point_lookup": answer(
            "SELECT * FROM silver WHERE city = 'NATION_7' AND date >= DATE '1998-01-01' AND date < DATE '1998-02-01'",
            "silver",
        ),
        # ---- audit
        "audit_trailing_rate": _TRAILING,
        "audit_usage_level": f"""SELECT source, level AS usage_level, COUNT(*) AS instants,
  COUNT(*) FILTER (WHERE trailing_requests > 2) AS over_cap FROM (SELECT *,
  CASE WHEN trailing_requests * 100.0e0 / 2 > 80 THEN 'high' WHEN trailing_requests * 100.0e0 / 2 > 60 THEN 'moderate'
  ELSE 'normal' END AS level FROM ({_TRAILING}) AS t) AS u GROUP BY source, level""",
        "audit_usage_by_provider": answer("", "raw_rows")
        + """,
requests AS (SELECT source, date_trunc('month', date) + to_seconds((l_orderkey * 7 + l_linenumber) % 1200) AS ts FROM raw_rows),
t AS (SELECT DISTINCT source, ts, COUNT(*) OVER (PARTITION BY source ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING
  AND CURRENT ROW) AS trailing_requests, CASE source WHEN 'aemet' THEN 90 WHEN 'meteostat' THEN 25 END AS cap FROM requests)
SELECT source, CASE WHEN trailing_requests * 100.0e0 / cap > 80 THEN 'high' WHEN trailing_requests * 100.0e0 / cap > 60 THEN 'moderate'
  ELSE 'normal' END AS usage_level, COUNT(*) AS instants, COUNT(*) FILTER (WHERE trailing_requests > cap) AS over_cap,
  MAX(trailing_requests) AS most FROM t GROUP BY 1, 2""",
        "audit_log_tags": f"""SELECT CAST(ts AS DATE) AS day, {_LOG_LEVEL} AS level, {_LOG_TAG} AS tag, COUNT(*) AS records,
  CAST(SUM(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT) AS context_total FROM events
GROUP BY 1, 2, 3""",
    }
