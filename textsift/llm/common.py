"""Helpers shared by the training-data operators: tables in the shared folder, fresh column names, partition counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsift.session import checkpoint_dir, drop_path

#: ASCII white space, as the contracts spell it: \x20 and \x09-\x0D.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
SPACES = " \t\n\x0b\f\r"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``saved`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            drop_path(df.sparkSession, folder)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", -1), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)
