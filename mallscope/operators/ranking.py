"""Top-k per group, with ties kept (rank) or cut (row_number)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"rank": F.rank, "row_number": F.row_number, "dense_rank": F.dense_rank}


def top_ranked(df: DataFrame, partition_by: list[str], order_by: list[Column], n: int,
               ties: str = "rank", rank_col: str | None = "rk") -> DataFrame:
    """Keep the first ``n`` rows of each ``partition_by`` group by ``order_by``.

    ``ties="rank"`` keeps every row tied at place ``n`` (more than ``n`` rows
    may pass); ``ties="row_number"`` keeps exactly ``n`` and needs a unique
    tie-break at the end of ``order_by`` for a deterministic result.

    The ``rk <= n`` filter lets Spark insert a partial WindowGroupLimit
    before the shuffle, so each map task ships at most ``n`` rows per group
    (plus ties) and a hot group never lands whole in one task.
    """
    if ties not in _RANKERS:
        raise ValueError(f"ties must be one of {sorted(_RANKERS)}")
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    name = rank_col or "__rk"
    out = df.withColumn(name, _RANKERS[ties]().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)
