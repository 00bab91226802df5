"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

def local_session(cores: int | str = 8, partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine. That folder
    is remembered as the context's checkpoint folder, as the setting itself is fixed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """``df`` cut from its lineage by a copy in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, if it is there."""
    files, folder = _hadoop(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared storage has a file or folder at ``path``."""
    files, folder = _hadoop(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders directly below ``path``; none if there is no such path."""
    files, folder = _hadoop(spark, path)
    if not files.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory())
