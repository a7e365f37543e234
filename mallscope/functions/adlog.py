"""The ad-click text line <-> typed record.

Line format (fixed, space separated, by position):
``timestamp area city userid adid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.constants import AD_LINE_FIELDS as FIELDS


def render_ad_log(ads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed clicks -> ``line`` text (plus any ``keep`` columns)."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in FIELDS]).alias("line")
    return ads.select(line, *(keep or []))


def parse_ad_log(lines: DataFrame, column: str = "line", keep: list[str] | None = None,
                 with_rejects: bool = False) -> DataFrame:
    """Text line -> (timestamp, area, city, userid, adid).

    Malformed lines (fewer than five fields, a non-numeric time) never fail
    the task: with ``with_rejects`` they are kept with ``ok = false``,
    otherwise they are dropped. Extra trailing fields are ignored, as a
    by-position read does.
    """
    parts = F.split(F.col(column), " ")
    ts = F.get(parts, 0).try_cast("bigint")
    cols = [ts.alias("timestamp")] + [F.get(parts, i).alias(n) for i, n in enumerate(FIELDS) if i > 0]
    out = lines.select(*cols, *(keep or []), F.size(parts).alias("__n"))
    ok = (F.col("__n") >= 5) & F.col("timestamp").isNotNull()
    for n in FIELDS[1:]:
        ok = ok & F.col(n).isNotNull()
    out = out.withColumn("ok", ok).drop("__n")
    return out if with_rejects else out.filter("ok").drop("ok")
