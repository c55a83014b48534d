"""Column expressions shared by the analytics (all JVM-side built-ins).

Decimal rounding rules are exact: counts are integers, so every rounded text
is computed with HALF_UP from integer or exact decimal arithmetic, never from
a binary float.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilescope.constants import (
    LABEL_MAX_DECIMALS,
    LABEL_SIGNIFICANT_DIGITS,
    LABEL_UNITS,
    PERCENT_DECIMALS,
    RAW_TIME_PATTERN,
    RAW_TIME_SUFFIX,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percentage(part: str | Column, whole: str | Column, on_empty: float | None = None) -> Column:
    """``100 * part / whole`` rounded to 2 decimals; ``on_empty`` when whole is 0.

    Rounding goes through ``round(x * 100, 0) / 100`` on doubles, which is the
    form that agrees with the SQL oracle on ties.
    """
    scale = float(10**PERCENT_DECIMALS)
    ratio = F.try_divide(F.lit(100.0) * _c(part), _c(whole))
    pct = F.round(ratio * F.lit(scale), 0) / F.lit(scale)
    if on_empty is not None:
        pct = F.coalesce(pct, F.lit(float(on_empty)))
    return pct


def block_index(c: str | Column, size: int) -> Column:
    """``floor(c / size)`` as int; floors toward minus infinity (-1 -> -1)."""
    return F.floor(_c(c) / F.lit(size)).cast("int")


def point_label(x: str | Column, y: str | Column) -> Column:
    return F.format_string("(%d, %d)", _c(x), _c(y))


def bin_label(n: str | Column, cap: int) -> Column:
    return F.when(_c(n) < F.lit(cap), _c(n).cast("string")).otherwise(F.lit(f"{cap}+"))


def thousands(n: str | Column) -> Column:
    """Integer text with thousands separators (``1,234,567``)."""
    return F.format_number(_c(n), 0)


def _fixed_text(scaled: Column, decimals: Column) -> Column:
    """Text of ``scaled / 10^decimals`` for a non-negative integer ``scaled``."""
    p = F.pow(F.lit(10), decimals).cast("bigint")
    frac = (scaled % p).cast("string")
    whole = F.call_function("div", scaled, p)
    return F.when(decimals == 0, whole.cast("string")).otherwise(
        F.concat(whole.cast("string"), F.lit("."), F.lpad(frac, decimals, "0"))
    )


def count_label(n: str | Column) -> Column:
    """Short label: at most 4 significant digits, at most 2 decimals, K/M suffix.

    Decimals kept = min(2, 4 - integer digits) and never below 0; rounding is
    decimal HALF_UP; trailing zeros and a bare point are dropped.
    0 -> ``0``, 1234 -> ``1.23K``, 999999 -> ``1000K``, 100005691 -> ``100M``.
    The decimals depend only on the range of ``n``, so each branch rounds an
    exact decimal ``n / unit`` to a literal scale.
    """
    n = _c(n).cast("bigint")

    def fixed(unit: int, decimals: int) -> Column:
        value = n.cast("decimal(20,0)") / F.lit(unit).cast("decimal(20,0)")
        text = F.round(value, decimals).cast("string")
        if decimals == 0:
            return text
        return F.regexp_replace(F.regexp_replace(text, "0+$", ""), "\\.$", "")

    units = sorted(LABEL_UNITS)  # ascending, e.g. thousands then millions
    label = F.when(n < units[0][0], n.cast("string"))
    for i, (unit, suffix) in enumerate(units):
        upper = units[i + 1][0] if i + 1 < len(units) else None
        digits = 1
        while True:
            decimals = max(0, min(LABEL_MAX_DECIMALS, LABEL_SIGNIFICANT_DIGITS - digits))
            hi = unit * 10**digits
            if upper is not None and hi >= upper:
                label = label.when(n < upper, F.concat(fixed(unit, decimals), F.lit(suffix)))
                break
            if upper is None and decimals == 0:
                label = label.otherwise(F.concat(fixed(unit, 0), F.lit(suffix)))
                break
            label = label.when(n < hi, F.concat(fixed(unit, decimals), F.lit(suffix)))
            digits += 1
    return label


def ratio_text(num: str | Column, den: str | Column, decimals: int = 2) -> Column:
    """``num / den`` as fixed-point text, decimal HALF_UP, NULL when den is 0."""
    num, den = _c(num).cast("bigint"), _c(den).cast("bigint")
    p = 10**decimals
    wide = lambda x: x.cast("decimal(38,0)")
    twice = wide(num) * wide(F.lit(2 * p)) + wide(den)
    scaled = F.when(den != 0, F.call_function("div", twice.cast("decimal(38,0)"), wide(den * 2)))
    return _fixed_text(scaled, F.lit(decimals))


def share_annotation(part: str | Column, whole: str | Column, decimals: int = 1) -> Column:
    """Bar annotation: percentage with one decimal, newline, raw count."""
    return F.concat(ratio_text(_c(part) * 100, whole, decimals), F.lit("%\n"), _c(part).cast("string"))


def block_letters(block_y: str | Column) -> Column:
    """Row letters by value: A..Z, then AA..ZZ, and so on (bijective base 26).

    Rows below 0 count from -A (row -1) the other way.
    """
    y = _c(block_y).cast("bigint")
    start = F.struct(F.when(y < 0, -y - 1).otherwise(y).alias("left"), F.lit("").alias("text"))

    def letter(done: Column, _: Column) -> Column:
        left = done["left"]
        more = F.struct(
            (F.call_function("div", left, F.lit(26)) - 1).alias("left"), F.concat(F.char(F.lit(65) + left % 26), done["text"]).alias("text")
        )
        return F.when(left < 0, done).otherwise(more)

    # 14 letters cover every bigint
    text = F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, letter, lambda done: done["text"])
    return F.when(y.isNotNull(), F.concat(F.when(y < 0, "-").otherwise(""), text))


def block_label(block_y: str | Column, block_x: str | Column, x_base: int = 0) -> Column:
    """``letters(block_y) || (block_x + x_base)``; rows are lettered by value."""
    return F.concat(block_letters(block_y), (_c(block_x) + F.lit(x_base)).cast("string"))


def hour_of(ts: str | Column) -> Column:
    """Start of the hour as ``timestamp_ntz``, from its parts: no time zone is involved."""
    t = _c(ts).cast("timestamp_ntz")
    none = F.lit(0)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.day(t), F.hour(t), none, none.cast("decimal(16,6)"))


def raw_time(text: str | Column, strict: bool = False) -> Column:
    """``timestamp_ntz`` of the raw log's time text: ``YYYY-MM-DD HH:MM:SS``, up to six
    fraction digits, and `` UTC`` or nothing.

    Anything else, also a time with another zone or an offset, is NULL, or raises if
    ``strict``: dropping the zone would shift the event.
    """
    c = _c(text)
    time = F.regexp_replace(c, f"{RAW_TIME_SUFFIX}$", "")
    if not strict:
        return F.when(c.rlike(RAW_TIME_PATTERN), time.try_cast("timestamp_ntz"))
    refused = F.raise_error(F.concat(F.lit("not a time of the raw log: "), c)).cast("timestamp_ntz")
    return F.when(c.isNull(), F.lit(None)).when(c.rlike(RAW_TIME_PATTERN), time.cast("timestamp_ntz")).otherwise(refused)


ZONED_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"


def zoned_time(text: str | Column) -> Column:
    """UTC wall clock of a time text that says its offset (``Z`` or ``+hh:mm``); NULL for any other text."""
    c = _c(text)
    return F.when(c.rlike(ZONED_TIME_PATTERN), wall_clock(c.try_cast("timestamp")))


def micros_between(a: str | Column, b: str | Column) -> Column:
    """``b - a`` in whole microseconds; on ``timestamp_ntz`` no time zone is involved."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b))


def instant_of(ts: str | Column) -> Column:
    """The instant whose UTC wall clock is the ``timestamp_ntz``, whatever the session zone."""
    return F.timestamp_micros(micros_between(F.lit("1970-01-01").cast("timestamp_ntz"), _c(ts)))


def wall_clock(ts: str | Column) -> Column:
    """UTC wall clock of an instant as ``timestamp_ntz``, whatever the session zone."""
    seconds = (F.unix_micros(_c(ts)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    none = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, seconds)


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """``b - a`` in fractional seconds (microsecond exact before the division)."""
    return micros_between(a, b) / F.lit(1e6)


def hours_since_epoch(ts: str | Column) -> Column:
    """Whole wall-clock hours since 1970-01-01 00:00 (no time-zone involvement)."""
    t = _c(ts)
    return F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * 24 + F.hour(t)
