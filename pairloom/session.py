"""Where a job may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own: on a cluster a local
    folder would be lost with its machine.
    """
    global _own_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="pairloom-")
    return _own_dir


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path for one run's tables."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    folder, files = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)]


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and move it to its place in one step, over one that may be there. The
    name it has until then starts with _, so that readers of the folder pass over it."""
    target, files = _file_system(spark, path)
    aside = target.getParent().suffix(f"/_{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, over)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables this package wrote; nothing happens if there is none."""
    folder, files = _file_system(spark, path)
    files.delete(folder, True)
