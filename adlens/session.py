"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "adlens") -> SparkSession:
    """A local session with AQE on, UI off and UTC timestamps."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the session.

    Reads the context's checkpoint directory or ``spark.checkpoint.dir``.
    Only a local-mode session without one gets a fresh temporary folder; a
    cluster session without a configured shared folder returns ``None``.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if sc is not None:
            sc.setCheckpointDir(conf)
            return sc.getCheckpointDir()
        return conf
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if str(master).startswith("local"):
        path = tempfile.mkdtemp(prefix="adlens-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(path)
            return sc.getCheckpointDir()
        return path
    return None


def fresh_folder(spark: SparkSession, kind: str = "adlens") -> str:
    """A new path in the session's shared folder.  A cluster session without
    ``spark.checkpoint.dir`` is an error: what is written must outlive executors."""
    folder = checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/adlens-{kind}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system it is; False where there was none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame in the session's shared checkpoint folder and read it back.

    Writes a parquet table under the checkpoint folder (one job); the returned
    frame's plan is a plain scan, so later analysis and any executor loss never
    go back to the raw input.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "table")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)      # a known schema needs no job to infer it
