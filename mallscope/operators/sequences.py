"""Page flows, session transitions and jump ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallscope.operators.joins import materialize


def page_flow_pairs(flow: str) -> list[tuple[str, str]]:
    """P10: target flow text ``"1,2,3"`` -> adjacent pairs ``[("1","2"), ("2","3")]``.

    The flow is a job parameter (one short text), so it is split on the
    driver; repeated pairs are kept once.
    """
    pages = flow.split(",")
    while pages and pages[-1] == "":
        pages.pop()
    seen, out = set(), []
    for a, b in zip(pages[:-1], pages[1:]):
        if (a, b) not in seen:
            seen.add((a, b))
            out.append((a, b))
    return out


# Sessions with more rows than this take the chunked path (about one
# shuffle partition's worth of rows).
DEFAULT_HOT_ROWS = 2_000_000


def session_transitions(actions: DataFrame, session: str = "session_id",
                        order: tuple[str, ...] = ("action_time", "event_id"),
                        value: str = "page_id", next_name: str = "next_page_id",
                        chunk=None, hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Each action with the ``value`` of the next action of its session.

    Order is ``order`` ascending (end it with a unique column to break ties).
    The last action of a session gets null.

    ``chunk=None`` is the plain ``lead`` over a per-session window: one
    shuffle, one task sorts a whole session. ``chunk`` - a key, or a list of
    keys from fine to coarse, each never decreasing along ``order`` and each
    finer chunk inside one coarser chunk (see ``session_chunks``) - splits
    sessions: ``lead`` runs per (session, chunk), spread over tasks by hash;
    only the boundary rows (first and last of each session-chunk) go on to
    the next, coarser level, where a chunk's last row meets the first row of
    the session's next chunk; the coarsest level ends in a per-session
    window over its boundary rows. Chunk keys are pure functions of the row,
    so any re-execution gives the same answer.

    With ``hot_rows`` only sessions holding more than about ``hot_rows`` rows
    take the chunked path: ``hot_keys`` finds them on a sample, the list is
    written once and goes into a null-safe semi / anti join (the actions
    without a session are one session, and often the largest), and every
    other session keeps the one-shuffle plain window; with no hot session
    the plan is just the plain window. Both paths give exact answers, so the
    sample only decides which plan a session takes.
    """
    cols = [session, *order, value]
    if chunk is None:
        return _plain(actions.select(*cols), session, order, value, next_name)
    chunks = list(chunk) if isinstance(chunk, (list, tuple)) else [chunk]
    if hot_rows is None:
        return _chunked(actions.select(*cols, *[c.alias(f"__c{i}") for i, c in enumerate(chunks)]),
                        cols, session, order, value, next_name, len(chunks))
    hot = materialize(hot_keys(actions, session, hot_rows).select(F.col(session).alias("__hot")))
    if hot.isEmpty():                           # reads the written list
        return _plain(actions.select(*cols), session, order, value, next_name)
    is_hot = F.col(session).eqNullSafe(F.col("__hot"))
    normal = _plain(actions.join(hot, is_hot, "left_anti").select(*cols),
                    session, order, value, next_name)
    split = actions.join(hot, is_hot, "left_semi").select(
        *cols, *[c.alias(f"__c{i}") for i, c in enumerate(chunks)])
    return normal.unionByName(_chunked(split, cols, session, order, value, next_name, len(chunks)))


# Expected sampled rows of a session with exactly ``hot_rows`` rows.
HOT_SAMPLE_ROWS = 10_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int, seed: int = 17) -> DataFrame:
    """Keys with more than about ``hot_rows`` rows, found on a fixed-seed sample.

    The sample fraction gives a key with ``hot_rows`` rows some
    ``HOT_SAMPLE_ROWS`` expected sampled rows; keys with at least half that
    are returned (a key with ``hot_rows`` rows is missed with negligible
    probability, smaller keys may be flagged too). When the fraction would
    be 1 the count is exact. Only the sample is shuffled.
    """
    fraction = min(1.0, HOT_SAMPLE_ROWS / max(hot_rows, 1))
    if fraction >= 1.0:
        return rows.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)
    counts = rows.select(key).sample(fraction=fraction, seed=seed).groupBy(key).count()
    return counts.filter(F.col("count") >= HOT_SAMPLE_ROWS / 2).select(key)


def session_chunks(action_time: str = "action_time", event_id: str = "event_id",
                   burst_rows: int = 100_000) -> list[Column]:
    """Chunk keys for ``session_transitions`` over (action_time, event_id) order.

    (second, event_id // burst_rows) holds at most ``burst_rows`` rows
    (event ids are unique), then the second, then the minute: every level
    passes on at most two rows per chunk, so no task gets a whole burst.
    """
    t = F.col(action_time)
    return [F.struct(t.alias("t"), F.floor(F.col(event_id) / burst_rows).alias("b")),
            t, F.substring(t, 1, 16)]


def _plain(rows: DataFrame, session, order, value, next_name) -> DataFrame:
    w = Window.partitionBy(session).orderBy(*order)
    return rows.withColumn(next_name, F.lead(value).over(w))


def _chunked(rows: DataFrame, cols, session, order, value, next_name, levels: int,
             level: int = 0) -> DataFrame:
    """``rows`` carry ``cols`` and the chunk keys ``__c{level}..``; returns ``cols`` + next."""
    if level == levels:
        return _plain(rows.select(*cols), session, order, value, next_name)
    key = f"__c{level}"
    rest = [f"__c{i}" for i in range(level + 1, levels)]
    w = Window.partitionBy(session, key).orderBy(*order)
    boxed = F.struct(F.col(value).alias("v"))
    within = (rows.withColumn("__next", F.lead(boxed).over(w))
                  .withColumn("__prev", F.lag(F.lit(1)).over(w)))
    # rows with a successor inside their chunk are done
    inner = within.filter(F.col("__next").isNotNull()).select(
        *cols, F.col("__next")["v"].alias(next_name))
    # boundary rows: a chunk's last row is followed, in session order, by
    # the first row of the session's next chunk - found one level up
    is_last = f"__last{level}"
    edges = (within.filter(F.col("__next").isNull() | F.col("__prev").isNull())
                   .select(*cols, *rest, F.col("__next").isNull().alias(is_last)))
    up = _chunked(edges, cols + [is_last], session, order, value, next_name, levels, level + 1)
    last = up.filter(F.col(is_last)).select(*cols, next_name)
    return inner.unionByName(last)


def page_view_counts(actions: DataFrame, pages: list[str], page: str = "page_id") -> DataFrame:
    """A4: visits per listed page (page compared as text), -> (page, n).

    The list is turned into the column's own type, so that the filter reaches
    the scan.
    """
    listed = pages_as(pages, actions.schema[page].dataType)
    return (actions.filter(F.col(page).isin(listed)).groupBy(F.col(page).cast("string").alias("page"))
                   .agg(F.count(F.lit(1)).alias("n")))


def pages_as(pages: list[str], kind: T.DataType) -> list:
    """Page texts as values of a column type: a text that is no number's own
    spelling (``"07"``, ``"x"``) equals no number and is left out."""
    if not isinstance(kind, T.IntegralType):
        return list(pages)
    numbers = [int(p) for p in pages if p.lstrip("-").isdigit() and p.isascii() and str(int(p)) == p]
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}[type(kind)]
    return [n for n in numbers if -(1 << bits) <= n < 1 << bits]


def page_jump_counts(transitions: DataFrame, pairs: list[tuple[str, str]],
                     page: str = "page_id", next_page: str = "next_page_id") -> DataFrame:
    """A5: count each listed page-to-page jump, -> (from_page, to_page, jump, n).

    Only immediate neighbours count; pairs never seen are absent (not 0).
    """
    jump = F.concat(F.col(page).cast("string"), F.lit("-"), F.col(next_page).cast("string"))
    keys = [f"{a}-{b}" for a, b in pairs]
    t = transitions.filter(F.col(next_page).isNotNull()).select(
        F.col(page).cast("string").alias("from_page"),
        F.col(next_page).cast("string").alias("to_page"), jump.alias("jump"))
    return t.filter(F.col("jump").isin(keys)).groupBy("from_page", "to_page", "jump").agg(
        F.count(F.lit(1)).alias("n"))


def jump_ratio(jumps: DataFrame, views: DataFrame) -> DataFrame:
    """J3 + A8: jump count / visits of its from-page (1 when unknown), unrounded."""
    v = views.select(F.col("page").alias("from_page"), F.col("n").alias("__v"))
    return (jumps.join(v, "from_page", "left")
                 .select("jump", (F.col("n").cast("double") /
                                  F.coalesce(F.col("__v"), F.lit(1)).cast("double")).alias("ratio")))
