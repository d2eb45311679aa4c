"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrail.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor re-reads files that every
    machine sees instead of recomputing the chain of stages above.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until no column of ``tables`` has it (in any letter case)."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column expression that a lambda names is computed again for every element; the parameter
    of a lambda isn't, and the optimiser doesn't inline it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: int, combine: Callable[[Column, Column], Column],
            chunk: int = 1000) -> Column:
    """What ``combine`` (associative) makes of all values before each one, from ``zero`` on.

    A fold that appends copies its array at every step; folding chunks and shifting them by the
    chunks before keeps the work near the length of the list.
    """
    start = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("found"))

    def one(part: Column) -> Column:
        return F.aggregate(part, start, lambda state, v: F.struct(
            combine(state["at"], v).cast("int").alias("at"),
            F.concat(state["found"], F.array(state["at"])).alias("found")))

    def parts(whole: Column) -> Column:
        last = ((F.size(whole) - 1) / chunk).cast("int")
        return F.transform(F.sequence(F.lit(0), last),
                           lambda i: one(F.slice(whole, i * chunk + 1, F.lit(chunk))))

    joined = F.aggregate(
        let(values, parts),
        F.struct(F.lit(zero).alias("at"), F.array().cast("array<array<int>>").alias("found")),
        lambda state, part: F.struct(
            combine(state["at"], part["at"]).cast("int").alias("at"),
            F.concat(state["found"], F.array(F.transform(
                part["found"], lambda v: combine(state["at"], v).cast("int")))).alias("found")))
    return F.flatten(joined["found"])


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions that the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column; null becomes the empty string."""
    return [t or "" for t in column.to_pylist()]
