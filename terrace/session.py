"""Session helpers: a builder for scripts and tests, and the shared scratch folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster leave `master` and the partition
    count unset: the submit command and AQE decide them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Building a plan makes many small calls; noting the line of each is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under `spark.checkpoint.dir`. Only a local master may go without that
    setting and get a machine-local temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/terrace/{label}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix=f"terrace-{label}-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made for itself and has read to the end."""
    files, target = _hadoop_path(spark, path)
    files.delete(target, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, as the file system reports them."""
    files, target = _hadoop_path(spark, path)
    return files.getContentSummary(target).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return files.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _hadoop_path(spark, path)
    files.mkdirs(target)


def put_record(spark: SparkSession, path: str, record: object) -> None:
    """Store a small record of the driver's as a JSON file, complete or not at all; a path that is
    there already is refused."""
    files, target = _hadoop_path(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    _, draft = _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()
    if not files.rename(draft, target):
        raise FileExistsError(path)


def get_record(spark: SparkSession, path: str) -> object:
    files, target = _hadoop_path(spark, path)
    stream = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def get_records(spark: SparkSession, folder: str) -> list:
    """The records of a folder, in no order; none if it is not there."""
    files, target = _hadoop_path(spark, folder)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return [get_record(spark, f"{folder.rstrip('/')}/{name}") for name in names if name.endswith(".json")]


def _small_files(spark: SparkSession) -> dict[str, str]:
    """Settings under which many small files are listed by some tasks a core instead of by a task
    a folder (10,000 at most), and read in splits of hundreds of files instead of 32."""
    return {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": str(256 * 1024),
    }


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Jobs within list and read many small files. Files are listed when a reader is made; the size
    of the splits counts where its rows are used."""
    with ExitStack() as held:
        for name, value in _small_files(spark).items():
            held.enter_context(setting(spark, name, value))
        yield


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs within, put back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
