"""Corpus clean-up: five stages, each an operator of cadence.llm over what the one before kept.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again
as the next one's documents. All but the last return the columns of documents, whatever their names: operators
see only doc_id and text under their own names, so extra columns neither clash with results nor change.
In every stage an empty table gives an empty one, and rows may be repeated and ids null or repeated; what a stage
does with them is stated there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import decontaminate, line_dedup, packing, simhash, toxicity
from cadence.llm.common import table
from cadence.session import scratch_path


class Apart:
    """``docs`` with every column but doc_id and text under a name that no operator uses, and the way back."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.names = {c: c if c in ("doc_id", "text") else f"_in{i}" for i, c in enumerate(docs.columns)}
        self.docs = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in self.names.items()])

    def back(self, out: DataFrame) -> DataFrame:
        return out.select(*[F.col(n).alias(c) for c, n in self.names.items()])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a toxicity score of 0.5 or more go. Null and empty texts have no evidence and stay; without labels of
    both kinds every row stays; repeated rows stay or go together; texts of any length are scanned whole."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    own = Apart(docs)
    return own.back(toxicity.add_scores(own.docs, model).where("tox_score < 0.5"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 or more documents go; every row stays, n_chars (where it is a column) follows a text that has
    changed. A null or empty text is one empty line, which is never dropped: it stays as it is. Repeated rows count as
    documents of their own."""
    own = Apart(docs)
    out = line_dedup.drop_lines(own.docs, min_docs=10)
    if n_chars := own.names.get("n_chars"):
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(n_chars, F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col(n_chars)))
    return own.back(out)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the smallest doc_id (null ids only where there is no other);
    of several rows with that id one stays, by a hash of all columns. Texts without a word (null, empty, white space)
    share fingerprint zero and are one component."""
    own = Apart(docs)
    return own.back(simhash.representatives(own.docs))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, repeated rows together. Null and empty texts hold none and stay; without
    items every row stays; texts of any length are searched whole."""
    own = Apart(docs)
    return own.back(decontaminate.add_leaks(own.docs, table(spark, sf_dir, "benchmark")).where(F.size("leak_items") == 0))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 2048 tokens. A null or empty text is the end token alone; repeated rows and
    ids are documents of their own; a text of any length is cut into as many pieces as it needs."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("toxicity", reject_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", keep_one_of_near_copies),
          ("decontaminate", drop_benchmark_leaks), ("packing", pack_sequences)]

#: Fitted scores, SimHash components and tokenizer ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
