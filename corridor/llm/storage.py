"""Reading the input tables and cutting lineage through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; Spark's file system drops it when the session ends."""
    path = f"{checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a side for broadcast only if its counted rows stay under ``limit`` and their measured text under ``max_bytes``.

    Columns of fixed width need no measuring; ``df`` should be a written table, as others are summed up here.
    """
    if rows > limit:
        return df
    fixed = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp")
    loose = [c for c, kind in df.dtypes if kind not in fixed]
    if loose and rows:
        size = df.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in loose), F.lit(0)))).first()[0]
        if (size or 0) > max_bytes:
            return df
    return F.broadcast(df)


def learnable(doc_id: Column) -> Column:
    """Rows whose labels a classifier may learn from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (names differ beyond their case)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
