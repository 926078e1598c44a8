"""Result files: CSV tables with a header and JSON documents, loading them back, and raw CSV scans.

A text value that holds a line end would be a record of several lines, which a splittable reader breaks
apart. ``write_csv`` therefore refuses such a value (the job fails with the column's name), or
escapes it (backslash, ``\\n``, ``\\r``) for ``read_csv(line_ends="escaped")``, or writes it quoted for readers
that take each file in one task (``line_ends="multi_line"`` on both sides).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"


def _escaped(c: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _unescaped(c: Column) -> Column:
    """Reads from left to right: what lies between doubled backslashes holds only line-end codes."""
    part = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")).otherwise(c)


def _texts(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _one_line(name: str) -> Column:
    c = F.col(f"`{name}`")
    return F.when(c.rlike("[\r\n]"), F.raise_error(F.lit(f"column {name} holds a line end; write with line_ends='escape' or 'multi_line'")).cast("string")).otherwise(c)


def write_csv(df: DataFrame, path: str, single_file: bool = False, line_ends: str = "refuse", bom: bool = False) -> None:
    """Header row, quoted text; ``single_file`` only for results known to be small. ``line_ends``: ``refuse``,
    ``escape`` or ``multi_line``. ``bom``: each file starts with a byte-order mark, as spreadsheets expect."""
    if line_ends == "refuse":
        df = _texts(df, _one_line)
    elif line_ends == "escape":
        df = _texts(df, lambda c: _escaped(F.col(f"`{c}`")))
    elif line_ends != "multi_line":
        raise ValueError(f"line_ends: {line_ends}")
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    out = df.coalesce(1) if single_file else df
    # the writer would trim values by default
    (out.write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, line_ends: str = "plain") -> DataFrame:
    """Read with an explicit schema; a leading byte-order mark on the header is ignored. Files are
    split over tasks; ``multi_line`` (or ``line_ends="multi_line"``) reads each in one task, for quoted values that hold
    line ends; ``line_ends="escaped"`` undoes the escapes of ``write_csv``."""
    got = (spark.read.schema(schema).option("header", True).option("escape", '"')
           .option("multiLine", multi_line or line_ends == "multi_line").option("encoding", "UTF-8").csv(path))
    return _texts(got, lambda c: _unescaped(F.col(f"`{c}`"))) if line_ends == "escaped" else got


def raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every field as text under its header name (an unnamed one is ``_c<position>``; the byte-order mark goes)."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return raw.toDF(*[c.removeprefix(BOM) for c in raw.columns])


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's fields by name, cast one by one: a malformed field is NULL, its row stays. Fields the schema
    doesn't know (an index column) go; absent ones raise."""
    if missing := [n for n in schema.names if n not in raw.columns]:
        raise ValueError(f"raw file: missing columns {missing}")
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def rejects(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """(position, field, data_type, present, rejected, example): for each field how many values are there, how
    many of them don't fit its type, and the smallest such text. One scan."""
    aggs = []
    for i, f in enumerate(schema.fields):
        c = F.col(f"`{f.name}`")
        bad = c.isNotNull() & c.try_cast(f.dataType).isNull()
        aggs += [F.count(c).alias(f"p{i}"), F.count_if(bad).alias(f"r{i}"), F.min(F.when(bad, c)).alias(f"e{i}")]
    return raw.agg(*aggs).select(F.inline(F.array(*[F.struct(
        F.lit(i + 1).alias("position"), F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col(f"p{i}").alias("present"), F.col(f"r{i}").alias("rejected"), F.col(f"e{i}").alias("example")) for i, f in enumerate(schema.fields)])))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_required(spark: SparkSession, root: str, schemas: dict[str, T.StructType],
                  fmt: str | Mapping[str, str] = "csv", line_ends: str = "plain") -> dict[str, DataFrame]:
    """Load every named result under ``root`` (``fmt``: csv or json, for all or by name); raise naming all that are missing."""
    loaded, missing = {}, []
    for name, schema in schemas.items():
        path = f"{root.rstrip('/')}/{name}"
        kind = fmt if isinstance(fmt, str) else fmt.get(name, "csv")
        try:
            df = read_csv(spark, path, schema, line_ends=line_ends) if kind == "csv" else read_json(spark, path, schema)
            df.schema  # noqa: B018  (resolves the path)
            loaded[name] = df
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"missing result files: {missing}")
    return loaded
