"""Labels, thresholds and colours that results must carry exactly."""

# --- Fixed values: season names and their months -------------------------------------
SEASON_MONTHS = {
    "Invierno": (12, 1, 2),
    "Primavera": (3, 4, 5),
    "Verano": (6, 7, 8),
    "Otoño": (9, 10, 11),
}

# --- Fixed values: alert labels ------------------------------------------------------
NORMAL = "Normal"
RED = "ALERTA ROJA"
ORANGE = "ALERTA NARANJA"
YELLOW = "ALERTA AMARILLA"

# Daily maximum above the bound (°C).
HEAT_ALERTS = (
    (40, "ALERTA ROJA - Temperatura Extremadamente Alta"),
    (35, "ALERTA ROJA - Temperatura Muy Alta"),
    (30, "ALERTA NARANJA - Temperatura Alta"),
    (25, "ALERTA AMARILLA - Temperatura Elevada"),
)
# Daily minimum below the bound (°C).
COLD_ALERTS = (
    (-10, "ALERTA ROJA - Temperatura Extremadamente Baja"),
    (-5, "ALERTA NARANJA - Temperatura Baja"),
    (0, "ALERTA AMARILLA - Temperatura Fría"),
)
# Daily precipitation above the bound (mm).
PRECIPITATION_ALERTS = (
    (100, "ALERTA ROJA - Precipitación Extremadamente Alta"),
    (50, "ALERTA NARANJA - Precipitación Alta"),
    (25, "ALERTA AMARILLA - Precipitación Moderada"),
)
HUMID_ABOVE = 95
DRY_BELOW = 20
HUMID_ALERT = "ALERTA AMARILLA - Humedad Muy Alta"
DRY_ALERT = "ALERTA AMARILLA - Humedad Muy Baja"

# Overall grades: (label, severity, tmax above, tmin below, precipitation above).
ALERT_GRADES = (
    (RED, 5, 40, -10, 100),
    (ORANGE, 4, 35, -5, 50),
    (YELLOW, 3, 30, 0, 25),
)
WARM_ABOVE = 25
MINOR_SEVERITY = 2
NO_SEVERITY = 1

# --- Fixed values: climate classes (label, mean temperature above, total precipitation below)
CLIMATE_CLASSES = (
    ("Clima Mediterráneo Seco", 20, 500),
    ("Clima Mediterráneo", 18, 800),
    ("Clima Templado", 15, 1000),
    ("Clima Fresco", 10, None),
)
COLDEST_CLASS = "Clima Frío"

# --- Fixed values: comfort score (score, temperature, precipitation, humidity; bounds inclusive)
COMFORT_BANDS = (
    (100, (15, 25), (300, 800), (40, 70)),
    (80, (10, 30), (200, 1000), (30, 80)),
    (60, (5, 35), (100, 1200), (20, 90)),
)
LOWEST_COMFORT = 40

# --- Fixed values: day classes used by the seasonal and comparison tables ------------
HOT_DAY_ABOVE = 30
COLD_DAY_BELOW = 0
RAINY_DAY_ABOVE = 10
WINDY_DAY_ABOVE = 30
HUMID_DAY_ABOVE = 80

# --- Fixed values: map colours -------------------------------------------------------
MISSING_COLOR = "gray"
TEMPERATURE_COLORS = ((10, "blue"), (20, "green"), (30, "orange"))
HOTTEST_COLOR = "red"
PRECIPITATION_COLORS = ((50, "yellow"), (100, "orange"))
WETTEST_COLOR = "red"
ALERT_COLORS = {
    "Normal": "green",
    "ALERTA AMARILLA": "yellow",
    "ALERTA NARANJA": "orange",
    "ALERTA ROJA": "red",
}
CLIMATE_COLORS = {
    "Clima Mediterráneo Seco": "red",
    "Clima Mediterráneo": "orange",
    "Clima Templado": "green",
    "Clima Fresco": "blue",
    "Clima Frío": "purple",
}

# --- Fixed values: texts a provider sends for "no value" ------------------------------
NO_VALUE_TEXTS = ("", "null", "Ip")

# --- Fixed values: request caps per trailing 60 seconds -------------------------------
REQUEST_WINDOW_SECONDS = 60
REQUEST_CAPS = {"aemet": 90, "meteostat": 25}
HIGH_USAGE_ABOVE = 80
MODERATE_USAGE_ABOVE = 60

# --- Fixed values: column labels of the table view ------------------------------------
# (the season column has a label of its own so that it cannot collide with the station)
DISPLAY_LABELS = {
    "city": "Ciudad",
    "region": "Región",
    "year": "Año",
    "month": "Mes",
    "date": "Fecha",
    "temp_max_c": "Temp. Máxima (°C)",
    "temp_min_c": "Temp. Mínima (°C)",
    "avg_temp": "Temp. Promedio (°C)",
    "precip_mm": "Precipitación (mm)",
    "total_precip": "Precipitación Total (mm)",
    "humidity_percent": "Humedad (%)",
    "avg_humidity": "Humedad Promedio (%)",
    "total_sunshine": "Horas Sol",
    "source": "Fuente",
    "station": "Estación",
    "lat": "Latitud",
    "lon": "Longitud",
    "overall_alert": "Alerta General",
    "alert_severity": "Severidad",
    "temperature_alert": "Alerta Temperatura",
    "precipitation_alert": "Alerta Precipitación",
    "humidity_alert": "Alerta Humedad",
    "season": "Estación del año",
    "climate_classification": "Clasificación Climática",
    "heat_rank_in_region": "Ranking Calor",
    "precip_rank_in_region": "Ranking Precipitación",
}
ROUNDED_LABEL_WORDS = ("Temp.", "Precipitación", "Humedad", "Latitud", "Longitud")

# --- Fixed values: the default cities (name, latitude, longitude, elevation, region) --
DEFAULT_CITIES = (
    ("Sevilla", 37.3886, -5.9823, 7.0, "Andalucia"),
    ("Malaga", 36.7213, -4.4217, 11.0, "Andalucia"),
    ("Cordoba", 37.8882, -4.7794, 106.0, "Andalucia"),
    ("Granada", 37.1773, -3.5986, 738.0, "Andalucia"),
    ("Almeria", 36.8340, -2.4637, 21.0, "Andalucia"),
    ("Cadiz", 36.5163, -6.2994, 6.0, "Andalucia"),
    ("Huelva", 37.2614, -6.9447, 54.0, "Andalucia"),
    ("Jaen", 37.7796, -3.7849, 573.0, "Andalucia"),
    ("Barcelona", 41.3874, 2.1686, 12.0, "Cataluña"),
    ("Girona", 41.9794, 2.8214, 70.0, "Cataluña"),
    ("Lleida", 41.6176, 0.6200, 199.0, "Cataluña"),
    ("Tarragona", 41.1189, 1.2445, 70.0, "Cataluña"),
    ("Manresa", 41.7282, 1.8239, 238.0, "Cataluña"),
    ("Reus", 41.1561, 1.1069, 117.0, "Cataluña"),
    ("Figueres", 42.2672, 2.9617, 39.0, "Cataluña"),
    ("Vic", 41.9301, 2.2549, 484.0, "Cataluña"),
)
DEFAULT_START = "2020-01-01"
DEFAULT_END = "2024-12-31"
