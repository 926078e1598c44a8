"""Guards of reports: named absent columns, and input without rows, checked inside the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def require_columns(df: DataFrame, wanted: Sequence[str], what: str) -> DataFrame:
    """``df`` itself; an error that names the report and every absent column otherwise."""
    if missing := missing_columns(df, wanted):
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def missing_report(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(position, column_name, present) of every wanted column."""
    rows = [(i + 1, c, c in df.columns) for i, c in enumerate(wanted)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, present boolean")


def require_rows(result: DataFrame, source: DataFrame, what: str) -> DataFrame:
    """``result`` that fails when it runs if ``source`` has no row, with the report's name.

    A second branch without rows carries the check: it reads one row of ``source``, and a plan that finds
    ``result`` empty still runs it. Nothing is counted on the driver while the plan is built."""
    seen = source.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    check = seen.where(F.assert_true(F.col("_n") > 0, F.lit(f"{what}: no rows")).isNotNull())
    return result.unionByName(check.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema.fields]))


def guarded(source: DataFrame, columns: Sequence[str], what: str, report) -> DataFrame:
    """``report(source)`` behind both guards."""
    return require_rows(report(require_columns(source, columns, what)), source.select(*columns), what)
