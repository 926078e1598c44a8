"""Table sources and sinks: driver tables, versioned layer tables, candidate resolution."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadence.session import table_path

POINTER_DIR = "_current"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read one driver table; a column list keeps the Parquet scan narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Size of one driver table's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength()


def _not_found(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def write_layer(df: DataFrame, root: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> str:
    """Overwrite a layer table without overwriting what readers may be reading.

    Parquet cannot overwrite a path that the same plan reads, so each write goes
    to a new version folder. The rows the write reported are compared with the
    rows that are there; only then a file naming the version is added beside the earlier
    ones, so there is a current version at every moment. Returns the version path.
    """
    spark = df.sparkSession
    version = f"{root.rstrip('/')}/v-{time.time_ns() // 1000:020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(version)
    there = spark.read.format(fmt).load(version).count()
    if there != seen.get["rows"]:
        raise OSError(f"{version} holds {there} rows, {seen.get['rows']} were written")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(f"{root.rstrip('/')}/{POINTER_DIR}")
    return version


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest version that was committed, None for a folder without versions."""
    try:
        return spark.read.text(f"{root.rstrip('/')}/{POINTER_DIR}").agg(F.max("value")).first()[0]
    except AnalysisException as e:
        if _not_found(e):
            return None
        raise


def read_layer(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Read the current version of a layer written by ``write_layer``.

    A plain table folder (no pointer) is read as is, so tables written by other
    tools can be layers too.
    """
    version = current_version(spark, root)
    return spark.read.format(fmt).load(version or root)


def resolve_layer(spark: SparkSession, candidates: Sequence[str],
                  fmt: str = "parquet") -> tuple[str, DataFrame]:
    """First candidate table that exists, as (path, DataFrame); error if none.

    Only schema resolution happens here, no data is scanned.
    """
    tried = []
    for path in candidates:
        try:
            return path, read_layer(spark, path, fmt)
        except AnalysisException as e:
            if not _not_found(e):
                raise  # it is there but cannot be read: the next one is not its stand-in
            tried.append(path)
    raise FileNotFoundError(f"none of the candidate tables exists: {tried}")


# -- layers of a catalog -------------------------------------------------------------------------

def write_catalog_layer(df: DataFrame, name: str, location: str | None = None, fmt: str = "parquet") -> tuple[str, int]:
    """Overwrite a layer that the session's catalog knows by ``name``: the rows become a new table, then the
    view ``name`` is replaced to show it. Readers of the old version go on with its table, and the schema may
    change. ``location``: a shared folder for the tables' files instead of the warehouse. Returns the new table's
    name and the number of rows that the write reported (no second read)."""
    spark = df.sparkSession
    version = f"{name}__v{time.time_ns() // 1000:020d}_{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("errorifexists")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{version}")
    writer.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return version, seen.get["rows"]


def catalog_versions(spark: SparkSession, name: str) -> list[str]:
    """Tables written for the layer, oldest first (names sort by the time of their write)."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=f"{name.lower()}__v*") if t.tableType != "VIEW")


def prune_catalog_layer(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop all but the ``keep`` newest versions; returns the names of those dropped."""
    gone = catalog_versions(spark, name)[:-keep] if keep > 0 else []
    for version in gone:
        spark.sql(f"DROP TABLE {version}")
    return gone
