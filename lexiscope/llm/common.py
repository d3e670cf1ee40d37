"""Helpers that the operators share: the shared folder, staged tables, row identity."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Below the shared folder.
FOLDERS = "lexiscope"
#: Characters that count as white space where a contract names them: space, tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table for the same rule as ascii_lower().
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. If it is unset, a local session gets an own folder; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^,\]]*(,\s*\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lexiscope-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/{FOLDERS}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> bool:
    """Deletes all that the operators have written to the shared folder, once no result is read any more; False if there was nothing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{FOLDERS}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as a Parquet table in the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is; lower() is the quick form for pure ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fewest shares that the rows of one key are dealt into.
SALTS = 16


def salts(spark: SparkSession) -> int:
    """Shares of a key: as many as there are shuffle partitions, so that a key that holds a third of all rows is spread over all tasks."""
    return max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_totals(rows: DataFrame, keys: list[str], deal: str, *totals: Column, having: str = "true") -> DataFrame:
    """rows with totals over their keys (those that fit ``having``), where one key may have a large part of all rows.

    Rows of a key are dealt by the hash of the column ``deal``; totals are combined before the
    shuffle, then handed to each share of the key that has rows, so no task gets a whole key.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(deal), F.lit(salts(rows.sparkSession))))
    summed = salted.groupBy(*keys).agg(*totals, F.collect_set("_salt").alias("_salts")).where(having)
    return salted.join(summed.withColumn("_salt", F.explode("_salts")), [*keys, "_salt"]).drop("_salt", "_salts")
