"""Scalar column functions (JVM-side expressions, no UDFs).

Each function takes and returns ``Column``s so it composes inside any
``select``/``withColumn`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's for the same results.
HDD_BASE_F = 65.0  # heating-degree-day base temperature, degrees Fahrenheit
NOTICE_TS_FORMAT = "M/d/yyyy h:mm:ss a"  # month/day/year 12-hour clock with AM/PM
ZSCORE_EPS = 1e-8  # z-score policy A: std at or below this divides by 1
WHITESPACE = " \t\n\u000b\f\r"  # characters stripped as whitespace (same set as the regex class \s)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def c_to_f(c) -> Column:
    """Celsius to Fahrenheit."""
    return _c(c) * 9.0 / 5.0 + 32.0


def hdd_from_tavg_c(tavg_c, base_f: float = HDD_BASE_F) -> Column:
    """heating degree days, max(0, base - F); null in gives null out."""
    t = _c(tavg_c)
    return F.when(t.isNotNull(), F.greatest(F.lit(0.0), F.lit(base_f) - c_to_f(t)))


def to_double(x) -> Column:
    """lenient numeric parse; anything unparsable (and NaN) becomes NULL."""
    return nan_to_null(_c(x).try_cast("double"))


def nan_to_null(x) -> Column:
    """NaN is not kept as a value anywhere; it is NULL."""
    v = _c(x)
    return F.when(~F.isnan(v), v)


def tenths(x) -> Column:
    """tenths of a unit to units after lenient parse."""
    return to_double(x) / 10.0


#: Day formats other than ISO, in the order they are tried.
DATE_FORMATS = ("M/d/yyyy", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm", "yyyy/M/d", "yyyyMMdd")


def to_date_lenient(x) -> Column:
    """lenient date parse (strings, timestamps, dates): ISO first, then ``DATE_FORMATS`` in order; bad gives NULL.

    A format is only tried on texts that could have it (a digit first, a slash where it has one): a parse that fails costs
    far more than the test.
    """
    v = _c(x)
    text = strip_ws(v.cast("string"))
    digit = F.substring(text, 1, 1).between("0", "9")
    could = lambda f: digit & (text.contains("/") if "/" in f else F.length(text) == len(f))
    return F.coalesce(v.try_cast("date"), F.when(digit, F.to_date(F.try_to_timestamp(text))),
                      *[F.when(could(f), F.to_date(F.try_to_timestamp(F.upper(text), F.lit(f)))) for f in DATE_FORMATS])


def to_ts_lenient(x) -> Column:
    """lenient timestamp parse; bad gives NULL."""
    return _c(x).cast("string").try_cast("timestamp")


def parse_notice_ts(x) -> Column:
    """'M/d/yyyy h:mm:ss AM' after whitespace strip; blank or bad gives NULL."""
    s = strip_ws(x)
    return F.when(s != "", F.try_to_timestamp(F.upper(s), F.lit(NOTICE_TS_FORMAT)))


def day_floor(x) -> Column:
    """calendar day of a timestamp in the session zone (UTC)."""
    return F.to_date(_c(x))


def format_date(x) -> Column:
    """YYYY-MM-DD text."""
    return F.date_format(_c(x), "yyyy-MM-dd")


def format_utc(x) -> Column:
    """ISO-8601 UTC text with a Z suffix."""
    return F.date_format(_c(x), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_range(start, end) -> Column:
    """daily dates from start to end, both included; empty if end < start."""
    s, e = _c(start), _c(end)
    return F.when(e >= s, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))


def safe_ln(x) -> Column:
    """natural log; zero and negatives give NULL."""
    v = _c(x)
    return F.when(v > 0, F.ln(v))


def sigmoid(x) -> Column:
    """F19."""
    return 1.0 / (1.0 + F.exp(-_c(x)))


def clamp_low(x, lo: float) -> Column:
    """lower clamp on non-null values."""
    v = _c(x)
    return F.when(v.isNotNull(), F.greatest(v, F.lit(float(lo))))


def strip_ws(x) -> Column:
    """strip all leading/trailing whitespace (plain ``trim`` removes spaces only)."""
    return F.trim(_c(x), F.lit(WHITESPACE))


def normalize_space(x) -> Column:
    """collapse inner whitespace runs to one space and strip the ends."""
    return strip_ws(F.regexp_replace(_c(x), r"\s+", " "))


def clean_text_list(arr) -> Column:
    """strip every element, drop nulls and blanks."""
    stripped = F.transform(_c(arr), lambda s: F.trim(s, F.lit(WHITESPACE)))
    return F.filter(stripped, lambda s: s.isNotNull() & (s != ""))


def safe_get(arr, idx: int, default: str = "") -> Column:
    """positional get; negative or out of range gives the default."""
    if idx < 0:
        return F.lit(default)
    return F.coalesce(F.get(_c(arr), idx), F.lit(default))


def critical_flag(label, legacy_truthy: bool = False, legacy_substring: bool = False) -> Column:
    """P14 + §8 Q1/Q2: is a notice label critical.

    Default: lower-cased label contains 'critical' but not 'non-critical'.
    ``legacy_substring`` keeps the plain substring test (so 'Non-Critical' counts);
    ``legacy_truthy`` keeps the source behaviour where every notice counts.
    """
    if legacy_truthy:
        return F.lit(True)
    s = F.lower(_c(label))
    if legacy_substring:
        return s.contains("critical")
    return s.contains("critical") & ~s.contains("non-critical") & ~s.contains("noncritical")


def yn_to_bool(x) -> Column:
    """'Y'/'N' to boolean; other values NULL."""
    s = F.upper(strip_ws(x))
    return F.when(s == "Y", True).when(s == "N", False)


def parse_utc_strict(value) -> "datetime":
    """F7 (driver side): a query bound as a UTC instant; anything unparsable raises.

    Accepts 'YYYY-MM-DD' and ISO-8601 text (with or without an offset, naive = UTC).
    """
    from datetime import datetime, timezone
    if isinstance(value, datetime):
        return value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    s = str(value).strip()
    if s.endswith("Z"):
        s = s[:-1] + "+00:00"
    d = datetime.fromisoformat(s)
    return (d if d.tzinfo else d.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)
