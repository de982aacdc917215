"""What the operators of this subpackage share: reading, durable intermediates, fold columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrapop.sources.files import shared_dir


#: Spark's own setting: shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet into the shared folder and read it
    back. Lost executors cost nothing but a re-read of these files. The shuffle files of
    the write are deleted when it ends, so that stages don't add up on disk."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that ``written`` returned and nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def column(name: str) -> Column:
    """A column by its plain name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain(keep: Iterable[str]) -> tuple[str, ...]:
    """Names for kept columns inside of tasks, where names with dots aren't allowed."""
    return tuple(f"keep_{k}" for k, _ in enumerate(keep))


def renamed(df: DataFrame, keep: Iterable[str], *more: str | Column) -> DataFrame:
    """The columns ``keep`` under their plain names, and ``more``."""
    return df.select(*(column(c).alias(k) for c, k in zip(keep, plain(keep), strict=True)), *more)


def given_names(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Plain names turned back; other columns as they are."""
    back = dict(zip(plain(keep), keep, strict=True))
    return df.select(*(F.col(c).alias(back[c]) if c in back else column(c) for c in df.columns))


def schema_of(df: DataFrame, keep: tuple[str, ...], added: str) -> StructType:
    """The fields ``keep`` of ``df`` and those of the DDL text ``added``."""
    kept = [StructField(c, df.schema[c].dataType, True) for c in keep]
    return StructType(kept + StructType.fromDDL(added).fields)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2`` ... that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    return next(x for x in (name, *(f"{name}_{k}" for k in range(1, len(taken) + 2))) if x.lower() not in taken)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text (null: empty text) modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def runs(sorted_values):
    """Start offsets of the runs of equal values in a sorted numpy array, and the end."""
    import numpy as np

    if len(sorted_values) == 0:
        return np.zeros(1, dtype=np.int64)
    cuts = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate(([0], cuts, [len(sorted_values)]))
