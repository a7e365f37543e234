"""The batch reports as one job: R1-R4 computed and handed to a writer.

``writer(df, table)`` publishes one result, e.g. ``table_writer`` (catalog
tables, overwrite) or ``jdbc_writer`` (append over JDBC, batched, from the
executors). Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from mallscope.constants import RESULT_TABLES as TABLES
from mallscope.plans import retail
from mallscope.sinks.tables import replace_table, write_jdbc

Writer = Callable[[DataFrame, str], None]


def table_writer(prefix: str = "", path_root: str | None = None) -> Writer:
    def write(df: DataFrame, table: str) -> None:
        path = f"{path_root.rstrip('/')}/{prefix}{table}" if path_root else None
        replace_table(df, prefix + table, path=path)
    return write


def jdbc_writer(url: str, **options) -> Writer:
    def write(df: DataFrame, table: str) -> None:
        write_jdbc(df, url, table, **options)
    return write


def run_reports(actions: DataFrame, users: DataFrame, cities: DataFrame, products: DataFrame,
                cond: dict, writer: Writer, task_id: str = retail.DEFAULT_TASK_ID,
                which: tuple[str, ...] = ("r1", "r2", "r3", "r4")) -> dict[str, str]:
    """Compute and write the chosen reports; returns {report: table name}.

    R1/R2 use the date and age bounds of ``cond``, R3 its ``targetPageFlow``
    over all actions, R4 all actions. R1 and R2 asked for together come from
    one pass over the filtered actions.
    """
    both = None
    if "r1" in which and "r2" in which:
        both = retail.hot_category_reports(actions, users, cond, task_id=task_id)
    build = {
        "r1": lambda: both[0] if both else retail.hot_category_top10(actions, users, cond, task_id=task_id),
        "r2": lambda: both[1] if both else retail.hot_category_top_sessions(actions, users, cond, task_id=task_id),
        "r3": lambda: retail.page_jump_ratio(actions, cond["targetPageFlow"], task_id=task_id),
        "r4": lambda: retail.area_product_top3(actions, cities, products, task_id=task_id),
    }
    out = {}
    for key in which:
        writer(build[key](), TABLES[key])
        out[key] = TABLES[key]
    return out
