"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import time

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def local_session(scratch: str, cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session configured like the cluster job (UTC, AQE, no UI).

    ``scratch`` is the checkpoint folder; on a cluster it comes from
    ``spark.checkpoint.dir`` instead.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("txnwatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir``; without it, and without a folder set on the
    context, this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def shared_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path; file:/x, file:///x and /x are the same."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Meeting:
    """Messages between tasks that run at the same time, as files of a shared folder."""

    def __init__(self, folder: str, run: str = ""):
        self.store, self.folder = shared_store(folder)
        self.path = f"{self.folder}/{run}" if run else self.folder
        self.store.create_dir(self.path, recursive=True)

    @staticmethod
    def reaches(folder: str) -> bool:
        try:
            shared_store(folder)
        except (pa.ArrowException, OSError, ValueError):
            return False
        return True

    def _write(self, path: str, data: bytes) -> None:
        with self.store.open_output_stream(path + ".new") as f:
            f.write(data)
        self.store.move(path + ".new", path)  # seen whole or not at all

    def _there(self, path: str) -> bool:
        return self.store.get_file_info(path).type == pafs.FileType.File

    def put(self, name: str, data: bytes) -> None:
        self._write(f"{self.path}/{name}", data)

    def read(self, name: str) -> bytes:
        """A message, as soon as it is there."""
        path, pause = f"{self.path}/{name}", 0.0005
        while not self._there(path):
            time.sleep(pause)
            pause = min(pause * 1.2, 0.02)
        with self.store.open_input_stream(path) as f:
            return f.read()

    def take(self, name: str) -> bytes:
        """A message that nobody else reads."""
        data = self.read(name)
        self.remove(name)
        return data

    def remove(self, name: str) -> None:
        self.store.delete_file(f"{self.path}/{name}")

    def keep(self, name: str, data: bytes) -> None:
        """A file that later runs find too."""
        self._write(f"{self.folder}/{name}", data)

    def kept(self, name: str) -> bytes:
        with self.store.open_input_stream(f"{self.folder}/{name}") as f:
            return f.read()

    def last(self, prefix: str) -> str:
        """The kept file of the last name that begins so."""
        found = self.store.get_file_info(pafs.FileSelector(self.folder))
        names = [f.base_name for f in found if f.base_name.startswith(prefix) and not f.base_name.endswith(".new")]
        return max(names, default="")

    def clear(self) -> None:
        self.store.delete_dir(self.folder)
