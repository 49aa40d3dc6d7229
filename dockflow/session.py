"""Session construction and lineage helpers.

Everything that touches cluster-wide settings lives here: the session used by
tests and the bench, the shared checkpoint folder, and ``materialize`` which
cuts lineage by writing a parquet table into that folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "dockflow", extra: dict | None = None) -> SparkSession:
    """Session with the settings the engine relies on.

    UTC session zone (hours are UTC in the reference), AQE on (coalesces small
    shuffles, splits skewed partitions at runtime), UI off.
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of parquet.

    Shuffle partitions are sized so that each holds about ``partition_bytes``
    (AQE coalesces smaller ones and splits skewed ones above 4x that size);
    scan splits use the same size. At 100 TB this gives ~400k shuffle
    partitions, below 1 GB each even when a stage doubles the data.
    """
    parts = max(200, int(input_bytes // partition_bytes))
    size = f"{partition_bytes // (1 << 20)}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * partition_bytes // (1 << 20)}m",
        "spark.sql.session.timeZone": "UTC",
    }


def cluster_session(app_name: str = "dockflow", input_bytes: int | None = None) -> SparkSession:
    """Session on the cluster the launcher configured (no master is set here).

    ``spark.checkpoint.dir`` must name shared storage; sizing follows
    ``scale_settings`` when ``input_bytes`` is given.
    """
    builder = SparkSession.builder.appName(app_name)
    for k, v in (scale_settings(input_bytes) if input_bytes else
                 {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (HDFS, S3, local)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` (a folder this engine wrote) through its Hadoop FileSystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` through its Hadoop FileSystem; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file (state of a sink), replaced as a whole: written aside, then renamed."""
    jvm = spark.sparkContext._jvm
    p, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(aside, p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text written by ``write_text`` (also one whose rename was interrupted), None if there is none."""
    jvm = spark.sparkContext._jvm
    for name in (path, f"{path}.new"):
        if path_exists(spark, name):
            p = jvm.org.apache.hadoop.fs.Path(name)
            stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
            try:
                return bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder comes from ``spark.checkpoint.dir``. Only a local-mode session
    (tests, bench) without that setting gets a fresh scratch folder; a cluster
    session without it is a configuration error, because a machine-local
    folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
    scratch = tempfile.mkdtemp(prefix="dockflow-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


_WRITTEN: list[str] = []


def release_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote with ``materialize``.

    Call once the results that read them have been consumed (written or
    collected); returns the number of tables removed.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def materialize(df: DataFrame, name: str = "t", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.

    Used where a data-sized intermediate feeds several later jobs (cutoff,
    fitting, output): the expensive plan runs once, lineage is cut, and the
    re-read gets column pruning and filter pushdown, unlike an RDD checkpoint.
    Survives executor loss because the folder is shared storage. With
    ``partition_by`` a filter on that column reads only its folders.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)

