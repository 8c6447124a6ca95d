"""Session factory and shared-folder helpers.

Scale notes
-----------
* ANSI mode stays on (Spark 4 default); string/number comparisons in the
  enrichment use explicit ``try_cast`` so bad input never fails a job.
* AQE, partition coalescing and skew-join splitting are on, so the one
  many-to-many join (documents x web log on username) splits hot users
  across tasks at run time instead of loading them into one task.
* Staging folders always live under ``spark.checkpoint.dir`` - the folder
  the cluster shares - never under a machine-local temp dir. Only when the
  setting is missing *and* the master is local (tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Unions of children that AQE coalesces differently fail where the planner counts on equal partitions.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "lumenflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``shuffle_partitions`` should be sized so one partition of the largest
    shuffle fits comfortably in executor memory (~128-256 MB each at the
    target scale); AQE then coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach (HDFS/S3/shared volume)"
            )
        configured = tempfile.mkdtemp(prefix="lumenflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Base folder for staged tables/files: the checkpoint folder's parent
    share, in a ``lumenflow-stage`` sub folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = configured or ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/lumenflow-stage"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared stage root."""
    root = shared_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    """(file system, path) as Hadoop knows them: any store that Spark can write to."""
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(sc._jsc.hadoopConfiguration()), found


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this engine staged; nothing if it isn't there."""
    fs, found = _folder(spark, path)
    fs.delete(found, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in ``path``, sorted; none if it isn't there."""
    fs, found = _folder(spark, path)
    if not fs.exists(found):
        return []
    return sorted(f.getPath().toString() for f in fs.listStatus(found) if f.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, sorted; none if it isn't there."""
    fs, found = _folder(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(found)) if fs.exists(found) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, in one step; an error if there's one of the name already."""
    fs, found = _folder(spark, path)
    out = fs.create(found, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, found = _folder(spark, path)
    given = fs.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(given, "UTF-8")
    finally:
        given.close()


def staged(df, name: str) -> tuple:
    """``df`` written to the shared stage folder: (the copy, its path). Survives lost executors and moving sources."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: Rows of a few hundred bytes that one task sorts or hashes in a small part of its memory.
ROWS_PER_TASK = 250_000


def sized(df, rows: int, *keys):
    """``df``, which has about ``rows`` rows, hashed by ``keys`` into tasks of about ``ROWS_PER_TASK``: their number grows
    with the rows, a task's memory doesn't. As it is if one task per core holds no more; Spark then sizes its own shuffles."""
    tasks = -(-rows // ROWS_PER_TASK)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over at least ``min_partitions`` (default: the
    cluster's default parallelism) when its source yields fewer splits.

    Only small inputs are ever redistributed: an input with fewer splits
    than cores is at most a few hundred MB, so the shuffle is cheap, and
    CPU-heavy row work (JSON rendering/parsing, regex) then uses every core.
    Large inputs already have enough splits and pass through untouched.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
