"""Scalar expressions F1-F23: Column in, Column out, all built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V


def first_match(rules, default) -> Column:
    """The value of the first rule whose condition is true; a NULL condition is not true."""
    conditions = list(rules)
    head = F.when(*conditions[0])
    return reduce(lambda chain, rule: chain.when(*rule), conditions[1:], head).otherwise(default)


# ---- parsing -------------------------------------------------------------------------

def present(*columns: str) -> Column:
    """None of the columns is missing, in a form that reaches the files."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def number_text(value: Column) -> Column:
    """Text with a decimal comma or point to double; "no value" texts become NULL (F1).

    A number ends in a digit or point and has no ``x``: casts alone would also take the
    JVM's ``12d`` and ``0x1p3``.
    """
    last = F.substring(F.rtrim(value), -1, 1)
    plain = (last.between("0", "9") | (last == ".")) & (F.instr(F.lower(value), "x") == 0)
    return F.when(plain, F.replace(value, F.lit(","), F.lit(".")).try_cast("double"))


def is_bad_number(value: Column, parsed: Column | None = None) -> Column:
    """True where a text holds neither a number nor a "no value" text; ``parsed``: its ``number_text``, if at hand."""
    parsed = number_text(value) if parsed is None else parsed
    return parsed.isNull() & value.isNotNull() & ~value.isin(*V.NO_VALUE_TEXTS)


def iso_date(value: Column) -> Column:
    """``yyyy-MM-dd`` text to date, NULL where it does not parse (F2)."""
    return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast("date"))


def dms_to_decimal(text: Column) -> Column:
    """``DDMMSSx`` text to signed decimal degrees; malformed text gives NULL."""
    direction = F.upper(F.substring(text, -1, 1))
    digits = F.substring(text, F.lit(1), F.length(text) - 1)
    degrees = F.substring(digits, 1, 2).try_cast("int")
    minutes = F.substring(digits, 3, 2).try_cast("int")
    seconds = F.substring(digits, F.lit(5), F.length(digits)).try_cast("int")
    size = degrees + minutes / F.lit(60.0) + seconds / F.lit(3600.0)
    return F.when(text.rlike(r"^\d{5,}.$"), F.when(direction.isin("S", "W"), -size).otherwise(size))


# ---- calendar ------------------------------------------------------------------------

def year_text(date: Column) -> Column:
    return F.date_format(date, "yyyy")


def month_text(date: Column) -> Column:
    return F.date_format(date, "MM")


def season(month: Column) -> Column:
    """Season name of a month number."""
    return first_match([(month.isin(*months), F.lit(name)) for name, months in V.SEASON_MONTHS.items()], None)


# ---- alerts and climate labels -------------------------------------------------------

def _above(value: Column, table):
    return [(value > bound, F.lit(label)) for bound, label in table]


def _below(value: Column, table):
    return [(value < bound, F.lit(label)) for bound, label in table]


def temperature_alert(tmax: Column, tmin: Column) -> Column:
    """Heat is graded before cold (F8)."""
    return first_match(_above(tmax, V.HEAT_ALERTS) + _below(tmin, V.COLD_ALERTS), V.NORMAL)


def precipitation_alert(precip: Column) -> Column:
    return first_match(_above(precip, V.PRECIPITATION_ALERTS), V.NORMAL)


def humidity_alert(humidity: Column) -> Column:
    return first_match(
        _above(humidity, [(V.HUMID_ABOVE, V.HUMID_ALERT)]) + _below(humidity, [(V.DRY_BELOW, V.DRY_ALERT)]),
        V.NORMAL,
    )


def odd_humidity(humidity: Column) -> Column:
    return (humidity > V.HUMID_ABOVE) | (humidity < V.DRY_BELOW)


def _grades(tmax: Column, tmin: Column, precip: Column):
    for label, severity, hot, cold, wet in V.ALERT_GRADES:
        yield label, severity, (tmax > hot) | (tmin < cold) | (precip > wet)


def overall_alert(tmax: Column, tmin: Column, precip: Column, humidity: Column) -> Column:
    """The worst colour of the day; odd humidity alone makes it yellow."""
    rules = [(hit, F.lit(label)) for label, _, hit in _grades(tmax, tmin, precip)]
    return first_match(rules + [(odd_humidity(humidity), F.lit(V.YELLOW))], V.NORMAL)


def alert_severity(tmax: Column, tmin: Column, precip: Column, humidity: Column) -> Column:
    """5 red to 1 none; warm days and odd humidity count 2."""
    rules = [(hit, F.lit(severity)) for _, severity, hit in _grades(tmax, tmin, precip)]
    minor = (tmax > V.WARM_ABOVE) | odd_humidity(humidity)
    return first_match(rules + [(minor, F.lit(V.MINOR_SEVERITY))], V.NO_SEVERITY).cast("int")


def climate_class(temp: Column, precip: Column) -> Column:
    """Climate class from mean temperature and total precipitation."""
    rules = []
    for label, warmer, drier in V.CLIMATE_CLASSES:
        hit = temp > warmer
        rules.append((hit if drier is None else hit & (precip < drier), F.lit(label)))
    return first_match(rules, V.COLDEST_CLASS)


def comfort_score(temp: Column, precip: Column, humidity: Column) -> Column:
    """100/80/60/40 by inclusive bands on all three measures."""
    rules = [
        (temp.between(*t) & precip.between(*p) & humidity.between(*h), F.lit(score))
        for score, t, p, h in V.COMFORT_BANDS
    ]
    return first_match(rules, V.LOWEST_COMFORT).cast("int")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole`` as a rounded double."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


# ---- map styling ---------------------------------------------------------------------

def temperature_color(value: Column) -> Column:
    return first_match([(value.isNull(), F.lit(V.MISSING_COLOR)), *_below(value, V.TEMPERATURE_COLORS)], V.HOTTEST_COLOR)


def precipitation_color(value: Column) -> Column:
    return first_match(
        [(value.isNull(), F.lit(V.MISSING_COLOR)), *_below(value, V.PRECIPITATION_COLORS)], V.WETTEST_COLOR
    )


def lookup_color(value: Column, colors: dict[str, str]) -> Column:
    return first_match([(value == key, F.lit(color)) for key, color in colors.items()], V.MISSING_COLOR)


def _clamped(value: Column, divisor: int, low: int, high: int, missing: int) -> Column:
    # the cast to int truncates toward zero
    size = F.greatest(F.lit(low), F.least(F.lit(high), (value / divisor).cast("int")))
    return F.when(value.isNull(), missing).otherwise(size)


def marker_radius(value: Column, metric: str) -> Column:
    """Marker size by metric; only avg_temp and precipitation metrics scale."""
    if metric == "avg_temp":
        return _clamped(value, 3, 5, 15, 5)
    if "precip" in metric:
        return _clamped(value, 10, 5, 20, 5)
    return F.when(value.isNull(), 5).otherwise(10)


def alert_radius(severity: Column) -> Column:
    return (8 + severity * 2).cast("int")


def climate_radius(temp: Column) -> Column:
    return _clamped(temp, 2, 6, 18, 8)


def capitalized(name: Column) -> Column:
    """First letter upper, the rest lower, also inside later words."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, F.lit(2), F.length(name))))


def city_slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), " ", "_")
