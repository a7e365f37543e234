"""Column expressions (all JVM-side built-ins, inside whole-stage codegen).

Time helpers work on epoch milliseconds with integer arithmetic, so their
text does not depend on the session or JVM time zone (dates are UTC days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000
MS_PER_DAY = 86_400_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_ids(c, sep: str = ",") -> Column:
    """Text list ``"3,5,"`` -> ``["3", "5"]``; empty entries dropped.

    ``sep`` is a literal character, not a pattern.
    """
    # array_remove is code-generated; a lambda filter would be interpreted
    return F.array_remove(F.split(_c(c), _regex_quote(sep)), "")


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def ntz_epoch_ms(c) -> Column:
    """Wall-clock ``timestamp_ntz`` read as UTC -> epoch milliseconds (exact floor)."""
    us = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {})".format(_sql_name(c))
    return F.expr(f"({us} - pmod({us}, 1000)) div 1000")


def _sql_name(c) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("pass a column name")


def epoch_ms_to_date(c) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` of the UTC day."""
    day = F.floor(_c(c) / F.lit(MS_PER_DAY)).cast("int")
    return F.date_from_unix_date(day).cast("string")


def epoch_ms_to_minute(c) -> Column:
    """Epoch ms -> whole minutes since the epoch (the minute bucket)."""
    return F.floor(_c(c) / F.lit(MS_PER_MINUTE)).cast("bigint")


def minute_to_hhmm(minute) -> Column:
    """Minute bucket -> ``HH:mm`` of the UTC clock."""
    m = _c(minute)
    return F.format_string("%02d:%02d", F.pmod(F.floor(m / 60), F.lit(24)).cast("int"),
                           F.pmod(m, F.lit(60)).cast("int"))


def epoch_ms_to_timestamp(c) -> Column:
    """Epoch ms -> TIMESTAMP (an instant; usable for watermarks)."""
    return F.timestamp_millis(_c(c))


def half_up_tenth(x) -> Column:
    """Round a double to one decimal, halves upwards (towards +inf).

    ``floor(x * 10 + 0.5) / 10`` on doubles, the same arithmetic as a
    round-half-up of ``x * 10``; ``round(x, 1)`` would round the decimal
    form instead and differ on some inputs.
    """
    return F.floor(_c(x) * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def percent_tenth(n, total) -> Column:
    """Share of ``n`` in ``total`` in percent, one decimal, halves up."""
    return F.floor(_c(n).cast("double") * F.lit(1000.0) / _c(total) + F.lit(0.5)) / F.lit(10.0)


def double_text(c) -> Column:
    """Number -> text the way the JVM prints a double (``26.7``, ``100.0``)."""
    return _c(c).cast("double").cast("string")


def pairs_to_json(items, key: str, value: str) -> Column:
    """array<struct> -> ``[{"k1":v1},{"k2":v2}]`` in array order."""
    return F.to_json(F.transform(_c(items), lambda x: F.create_map(x[key], x[value])))


def kv_key(*parts, sep: str = ":") -> Column:
    """Text key from columns / literals, e.g. ``area:city:ad``."""
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])


def with_task_id(df: DataFrame, task_id: str, name: str = "task_id") -> DataFrame:
    """Stamp a caller-supplied run id as the first column."""
    return df.select(F.lit(task_id).alias(name), *df.columns)
