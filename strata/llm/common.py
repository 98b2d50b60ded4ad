"""Helpers shared by the operators: input tables and intermediate tables."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import drop_shared, setting, shared_dir

#: ASCII letters; lower-casing in the contracts touches these alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spark's setting to delete a plan's shuffle files as soon as the plan is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def workers_import(spark: SparkSession) -> None:
    """Python workers find this library where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path below the cluster's shared folder."""
    return shared_dir(spark, "llm", f"{kind}-{uuid.uuid4().hex}")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there, and its shuffle files go.

    A written table survives the loss of any executor; a local checkpoint would not.
    """
    return stored_in_parts(df.sparkSession, lambda part: df, 1, kind)


def stored_in_parts(spark: SparkSession, make: Callable[[int], DataFrame], parts: int, kind: str) -> DataFrame:
    """``make(0)`` to ``make(parts - 1)`` as one stored table, written one after another: disks hold the shuffle files of one at a time."""
    path = new_folder(spark, kind)
    for part in range(parts):
        df = make(part)
        with setting(spark, CLEANUP, "true"):
            df.write.mode("append" if part else "errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def part_of(key: str, parts: int) -> Column:
    """Number of the part, of so many, that a key's rows belong to."""
    return F.pmod(F.xxhash64(key), F.lit(parts))


def parts_for(rows: int, least: int, most: int) -> int:
    """In how many parts so many rows are shuffled: of ``least`` rows, up to ``most`` parts."""
    return max(1, min(most, rows // least))


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by ``stored`` that no later plan reads; they would fill the shared folder until the job ends.

    The shuffle files of plans that ``stored`` did not run go only when the driver's collector finds the plans, so it is asked to look.
    """
    gone = [t for t in tables if t is not None]
    for table in gone:
        drop_shared(table.sparkSession, table.stored_path)
    if gone:
        release(gone[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files and broadcasts of plans that nothing holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bucket_of_id(col: str, mod: int):
    """crc32 of the id as text, modulo ``mod``; a null id counts as remainder 0 of the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def lower_ascii(col):
    return F.translate(col, UPPER, LOWER)
