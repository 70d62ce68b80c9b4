"""Scalar functions as Column builders; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.schemas import OPEN_END

#: Places kept of binary numbers when they are averaged.
DECIMALS = 6
MICROS = {"microsecond": 1, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- labels and flags -----------------------------------------------------


def code_label(c: Column | str, labels: Mapping[Any, str], default: str | None = None) -> Column:
    """Label of a code; codes outside ``labels`` (and NULL) give ``default``."""
    c = as_column(c)
    chain = reduce(lambda acc, kv: acc.when(c == kv[0], kv[1]), labels.items(), F)
    return chain.otherwise(F.lit(default).cast("string"))


def whitelist(c: Column | str, values: Sequence[Any]) -> Column:
    c = as_column(c)
    return F.when(c.isin(list(values)), c)


def flag_to_bool(c: Column | str) -> Column:
    """1 is true, 0 is false, anything else NULL."""
    c = as_column(c)
    return F.when(c == 1, True).when(c == 0, False)


def is_unknown(c: Column | str) -> Column:
    return as_column(c).isNull()


# --- text -----------------------------------------------------------------


def trim(c: Column | str) -> Column:
    return F.trim(as_column(c))


def lower(c: Column | str) -> Column:
    return F.lower(as_column(c))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def same_text(c: Column | str, value: str) -> Column:
    """Equality that ignores case."""
    return F.lower(as_column(c)) == F.lower(F.lit(value))


# --- numbers --------------------------------------------------------------


def to_numeric(c: Column | str) -> Column:
    """Number, or NULL when the text is not one."""
    return as_column(c).try_cast("double")


def nan_to_null(c: Column | str) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def floor_zero(c: Column | str) -> Column:
    """Greater of the value and 0; NULL becomes 0."""
    return F.greatest(as_column(c), F.lit(0))


def clip(c: Column | str, lo: Any, hi: Any) -> Column:
    c = as_column(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def round_half_up(c: Column | str, dp: int, precision: int = 38) -> Column:
    """Half away from zero, on the decimal image of the value."""
    return F.round(as_column(c).cast(f"decimal({precision},{min(dp + 6, 18)})"), dp)


def unscaled(c: Column | str, scale: int) -> Column:
    """The value in units of 10^-scale, as BIGINT (cents for scale 2)."""
    return F.round(as_column(c) * F.lit(10**scale)).cast("bigint")


def divide_half_up(num: Column, den: Column) -> Column:
    """``num / den`` rounded to an integer, half away from zero, in BIGINT arithmetic."""
    quotient = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -quotient).otherwise(quotient)


def from_units(units: Column, dp: int) -> Column:
    """Inverse of :func:`unscaled`."""
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-dp))).cast(f"decimal(20,{dp})")


def ratio_pct(num: Column | str, den: Column | str, dp: int = 1, scale: int = 2) -> Column:
    """``100 * num / den`` at ``dp`` places; 0 unless ``den`` is positive, NULL when only ``num`` is NULL."""
    a, b = unscaled(num, scale), unscaled(den, scale)
    pct = from_units(divide_half_up(a * F.lit(100 * 10**dp), b), dp)
    return F.when(b > 0, pct).otherwise(F.lit(0).cast(f"decimal(20,{dp})"))


def round_avg(c: Column | str, dp: int, scale: int | None = None, count: Column | None = None) -> Column:
    """Aggregate: average rounded half away from zero once, free of binary rounding.

    ``scale`` is the number of decimals the input carries, if known; partial sums are
    BIGINT then. Otherwise they are decimals of ``DECIMALS`` places. Either way the
    result does not depend on the order in which partitions are merged.
    """
    n = F.count(as_column(c)) if count is None else count
    if scale is not None:
        return mean_of_units(F.sum(unscaled(c, scale)), n, dp, scale)
    total = F.sum(as_column(c).cast(f"decimal(28,{DECIMALS})"))
    return mean_of_units((total * F.lit(10**DECIMALS)).cast("decimal(38,0)"), n, dp, DECIMALS)


def mean_of_units(total: Column, n: Column, dp: int, scale: int = 2) -> Column:
    """``total / n`` at ``dp`` places when ``total`` is in units of 10^-scale."""
    if scale >= dp:
        rounded = divide_half_up(total, n * F.lit(10 ** (scale - dp)))
    else:
        rounded = divide_half_up(total * F.lit(10 ** (dp - scale)), n)
    return F.when(n > 0, from_units(rounded, dp))


def pages(total: Column | str, size: int) -> Column:
    """Number of pages of ``size`` rows."""
    return F.ceil(as_column(total) / F.lit(size)).cast("bigint")


# --- time -----------------------------------------------------------------


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes at two decimals; NULL unless ``end`` is after ``start``."""
    micros = micros_between(start, end)
    hundredths = divide_half_up(micros * 100, F.lit(MICROS["minute"]))
    return F.when(as_column(end) > as_column(start), from_units(hundredths, 2))


def elapsed(start: Column | str, end: Column | str, unit: str = "second") -> Column:
    """Elapsed time in ``unit`` as double."""
    return micros_between(start, end) / F.lit(float(MICROS[unit]))


def open_end(ts: Column | str) -> Column:
    """Open interval end as the largest timestamp."""
    ts = as_column(ts)
    return F.coalesce(ts, F.lit(OPEN_END).cast("timestamp"))


def parse_ts(c: Column | str) -> Column:
    """Timestamp of ISO-like text, NULL when it is not one."""
    return as_column(c).try_cast("timestamp")


def since(ts: Column | str, now: Column, interval: str) -> Column:
    """Predicate: within the trailing ``interval`` before ``now``."""
    return as_column(ts) > now - F.expr(f"interval {interval}")


# --- places ---------------------------------------------------------------


def geofence(lon: Column | str, lat: Column | str, box: Sequence[str]) -> tuple[Column, Column]:
    """Both coordinates, or NULL for both when the point is outside ``box`` (edges are inside)."""
    lon, lat = as_column(lon), as_column(lat)
    edges = [F.lit(edge).cast("decimal(11,6)") for edge in box]
    inside = lon.between(edges[0], edges[1]) & lat.between(edges[2], edges[3])
    return F.when(inside, lon), F.when(inside, lat)


# --- JSON -----------------------------------------------------------------


def json_field(c: Column | str, path: str) -> Column:
    return F.get_json_object(as_column(c), path)


def as_decimal(c: Column | str) -> Column:
    """Number of a text, NULL when it is none; unlike a cast to double it takes no suffix (``5d``), NaN or infinity."""
    return as_column(c).try_cast("decimal(38,12)")


def numeric_ok(c: Column | str) -> Column:
    """Text that reads as a number (NaN does not)."""
    return as_decimal(c).isNotNull()


def int_ok(c: Column | str) -> Column:
    """Text that reads as a whole number, ``2.0`` included."""
    number = as_decimal(c)
    return F.coalesce(number == F.floor(number), F.lit(False))


def whole(c: Column | str, kind: str) -> Column:
    """Text as an integer type: ``2.0`` is 2, while ``2.5`` and what the type doesn't hold are NULL."""
    number = as_decimal(c)
    return F.when(number == F.floor(number), F.floor(number)).try_cast(kind)


# --- display --------------------------------------------------------------


def fmt_money(c: Column | str, prefix: str = "") -> Column:
    """Fixed two decimals, no grouping; NULL shows as a dash."""
    text = F.format_string(f"{prefix}%.2f", as_column(c).cast("double"))
    return F.when(as_column(c).isNotNull(), text).otherwise(F.lit("—"))


def fmt_ts(c: Column | str, precision: str = "minute") -> Column:
    """ISO prefix down to the hour or minute; NULL shows as ``N/A``."""
    pattern = {"hour": "yyyy-MM-dd'T'HH", "minute": "yyyy-MM-dd'T'HH:mm"}[precision]
    return F.coalesce(F.date_format(as_column(c), pattern), F.lit("N/A"))


def size_pretty(size: Column | str) -> Column:
    """Byte count in the largest unit that keeps it under about ten thousand, rounded half up."""
    size = as_column(size).cast("bigint")
    text = F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes")))
    units = ["kB", "MB", "GB", "TB"]
    for power, unit in enumerate([*units, "PB"], start=1):
        width = 1024**power
        whole = F.call_function("div", size + F.lit(width // 2), F.lit(width))
        label = F.concat(whole.cast("string"), F.lit(f" {unit}"))
        text = text.when(whole < 10240, label) if unit in units else text.otherwise(label)
    return text
