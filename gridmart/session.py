"""Session settings, the shared work folder and small file-system helpers."""

import functools
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_session(
    name: str = "gridmart", cores: str = "*", partitions: int = 8, shared: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors of a
    cluster could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gridmart-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _handle(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _handle(spark, path)
    return fs.exists(handle)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, handle = _handle(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(handle) if s.isDirectory())


def child_folder_times(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Folders in a folder and when each last changed, in milliseconds."""
    fs, handle = _handle(spark, path)
    if not fs.exists(handle):
        return []
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(handle) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names of the files in a folder and when each last changed, in milliseconds."""
    fs, handle = _handle(spark, path)
    if not fs.exists(handle):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(handle) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file; empty if it is gone."""
    fs, handle = _handle(spark, path)
    if not fs.exists(handle):
        return ""
    stream = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file; False if there is one already."""
    fs, handle = _handle(spark, path)
    if fs.exists(handle):
        return False
    try:
        stream = fs.create(handle, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, handle = _handle(spark, path)
    fs.delete(handle, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished table, not just an empty or half-written folder."""
    return path_exists(spark, f"{path}/_SUCCESS")
