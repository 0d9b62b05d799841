"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the word pattern of the query contracts (bytes.split() cuts at the same six bytes).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. A temporary one serves only local sessions that name none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or _own_dir()


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


#: Shuffle files go once their query has ended; a stored table needs them no more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Tables written as Parquet in the shared folder, so that later plans start from files that outlive executors.

    A table is dropped by whoever knows its last reader; tables that a returned DataFrame still reads stay."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.base, self._paths = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}", {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{len(self._paths)}-{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, self._paths[id(t)][1])

    def drop_all(self, *but: DataFrame) -> None:
        kept = {id(t) for t in but}
        for k, (_, path) in self._paths.items():
            if k not in kept:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, whichever it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """A table of its own that stays."""
    return Tables(df.sparkSession, tag).put(df, tag)


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df has not, so that internal columns cannot clash with its own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def crc_fold(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null ids: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n)), F.lit(0)).cast("int")


def hash_share(col: str, part: float, seed: int = 7) -> Column:
    """True for about the given part of all rows, chosen by a hash of the id: the same rows on each run."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(1_000_000)) < F.lit(int(part * 1_000_000) if part < 1 else 1_000_000)


def renamed(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under internal names, so that extra columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])
