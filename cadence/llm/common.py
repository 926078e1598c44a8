"""Helpers shared by the operators: tables, appended columns, clean-up of bounded broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.session import ensure_checkpoint_dir, scratch_path

ARROW = {"long": pa.int64(), "integer": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "boolean": pa.bool_(), "binary": pa.binary()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables; the path is only ever opened by Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns of
    the input can neither clash with results nor travel through a shuffle."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in columns.items()])


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return ARROW[kind.typeName()]


#: Caches that outlive a task in a Python worker: owner -> function that empties them.
CACHES: dict[str, Callable[[], None]] = {}


def append(df: DataFrame, text: str, fields: str, start: Callable[[], Callable[[list], list]], owner: str = "") -> DataFrame:
    """``df`` with the columns of the DDL string ``fields`` computed from column ``text``.

    ``start`` runs once in each task and returns a function that turns a list of
    texts (None for null) into one list for each new column. Rows keep their place: no shuffle.
    A column of ``df`` with the name of a new one is replaced, ``text`` too.
    """
    new = T._parse_datatype_string(fields)
    df = df.select(*[f"`{c}`" for c in df.columns if c == text or c not in new.names])
    stay = [f for f in df.schema.fields if f.name not in new.names]
    kinds = [arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in parts(batches, owner=owner):
            at = {n: k for k, n in enumerate(batch.schema.names)}
            got = work(batch.column(at[text]).to_pylist())
            columns = [pa.array(c, type=k) for c, k in zip(got, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(at[f.name]) for f in stay], *columns], names=[*[f.name for f in stay], *new.names])

    return df.mapInArrow(run, T.StructType([*stay, *new.fields]))


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512, owner: str = "") -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows: a task holds the Python objects of one slice only.
    A worker that turns to another operator empties the caches of the former one."""
    for name, empty in CACHES.items():
        if name != owner:
            empty()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the folder of spark.checkpoint.dir, which every executor reads."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def passed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what follows is another pass, whose tasks no longer hold what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text modulo 5; rows with 0 are held out of every fit."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
