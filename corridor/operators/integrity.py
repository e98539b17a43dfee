"""Table constraints as data operators: FK, CHECK domains, UNIQUE, cascade.

Each check splits a frame into ``(valid, rejected)`` instead of failing the
whole batch. Joins are left semi/anti on the key: Spark broadcasts the
parent only when its measured size is under the broadcast threshold, and
AQE splits a skewed key partition of the child side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def foreign_key(child: DataFrame, parent: DataFrame, key: str,
                parent_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows whose key exists in parent, orphan rows)."""
    pk = parent.select(F.col(parent_key or key).alias(key))
    return child.join(pk, key, "left_semi"), child.join(pk, key, "left_anti")


def exists_flag(ids: DataFrame, parent: DataFrame, key: str, name: str = "exists") -> DataFrame:
    """``ids`` with a boolean column telling whether the key is in ``parent``."""
    keys = parent.select(key).distinct().withColumn(name, F.lit(True))
    return ids.join(keys, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def domain_check(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """CHECK constraints: ``checks`` maps a reason to a predicate that must hold.

    As with SQL's CHECK, a NULL predicate passes. Rejected rows carry
    ``reason`` (all failed reasons joined by ';').
    """
    reasons = F.concat_ws(";", *[F.when(~p, F.lit(r)) for r, p in checks.items()])
    tagged = df.withColumn("_reason", reasons)
    valid = tagged.filter(F.col("_reason") == "").drop("_reason")
    rejected = tagged.filter(F.col("_reason") != "").withColumnRenamed("_reason", "reason")
    return valid, rejected


def duplicate_keys(df: DataFrame, key: str | Iterable[str]) -> DataFrame:
    """UNIQUE violations: keys occurring more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def cascade_delete(child: DataFrame, deleted: DataFrame, key: str,
                   deleted_key: str | None = None) -> DataFrame:
    """Child rows that survive deleting the ``deleted`` parent ids."""
    d = deleted.select(F.col(deleted_key or key).alias(key))
    return child.join(d, key, "left_anti")
