"""Session helpers: a tuned local session for tests/bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Session settings every entry point relies on.  AQE re-plans joins and
#: coalesces shuffle partitions at runtime; skew join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Wide cleaning projections generate methods above the JIT's 8000-byte limit;
#: without this flag they run interpreted (about 4x slower).  Set on local
#: sessions; a cluster's own Java options are left alone, add it there.
JIT_FLAG = "-XX:-DontCompileHugeMethods"


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    Without ``master`` the one given to ``spark-submit`` (or Spark's default) holds.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            given = (extra or {}).get("spark.driver.extraJavaOptions", "")
            extra = {**(extra or {}), "spark.driver.extraJavaOptions": f"{given} {JIT_FLAG}".strip()}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One of the session's settings for the plans that run in here."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Spark's setting for the longest method of a whole stage's code, and the bytes beyond which Java interprets a method.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Stages that run in here have no method too long for Java's compiler.

    Spark then generates the code of such a stage's operators apart, in short methods.  A
    session whose Java compiles long ones (JIT_FLAG) is left as it is.
    """
    conf = spark.sparkContext.getConf()
    side = "driver" if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local" else "executor"
    if JIT_FLAG in conf.get(f"spark.{side}.extraJavaOptions", ""):
        yield
    else:
        with setting(spark, METHOD_LIMIT, str(COMPILED_BYTES)):
            yield


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder all executors can reach: below ``spark.checkpoint.dir``.

    The cluster names that folder; we only set our own when it is unset, which
    happens in local tests.  Also registers it as the RDD checkpoint folder so
    that ``DataFrame.checkpoint()`` works.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # static in some deployments; the context below suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def drop_shared(spark: SparkSession, path: str) -> bool:
    """Delete a folder below the shared one, once nothing reads it any more."""
    base = shared_dir(spark)
    if not path.startswith(base.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {base}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: written to the shared folder as Parquet and read back.

    Used where one intermediate result feeds several actions or branches (the
    gold fact behind bucket edges, quartiles and whiskers).  A checkpoint would write the
    rows as they are in memory, several times as large.  Never a
    local checkpoint: an executor lost later would take the data with it.
    """
    path = shared_dir(df.sparkSession, "kept", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Input bytes a task, from which a scan has splits enough of its own.
SPREAD_BYTES = 16 << 20


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads."""
    sc = df.sparkSession.sparkContext
    paths = [sc._jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a small ``df`` over at least ``min_partitions`` tasks (default parallelism).

    A scan of a few small files yields one task per row group: all of the
    following narrow work would then run on one core.  Inputs of more files than that, or
    of SPREAD_BYTES a task, are split by the scan itself and returned untouched, so
    at scale this adds no shuffle, however few their files.
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    small = len(df.inputFiles()) < n and input_bytes(df) < n * SPREAD_BYTES
    return df.repartition(n) if small else df


def scale_conf(input_bytes: int, executors_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a run over ``input_bytes`` of Parquet on ``executors_cores`` task slots.

    * shuffle partitions: each holds ~``target_partition_bytes``, at least two
      waves of tasks, but no more than leave a map task's blocks at 32 KB (a scan
      task of 512 MB then writes 16,384 blocks); larger partitions spill;
    * scan splits of 512 MB: wide string rows decode slower than they read;
    * skew join: split partitions 5x the median and above 256 MB.
    E.g. 100 TB on 8,000 cores -> 16,384 shuffle partitions.
    """
    most = max(1, (512 << 20) // (32 << 10))
    parts = max(2 * executors_cores, min(most, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
