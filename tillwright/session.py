"""Session helpers and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "tillwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library counts on; ``conf`` adds to or overrides them.

    Adaptive execution re-plans joins from measured sizes, splits skewed join partitions and
    merges small shuffle partitions. It is Spark's default and only stated here. Catalogs are
    given by the caller as ordinary ``spark.sql.catalog.*`` settings through ``conf``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    Only a local master may go without the setting: a folder of this machine is then good
    enough. On a cluster the executors would not see it, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tillwright-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """A folder and its file system, whatever that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder."""
    folder, system = _folder(spark, path)
    return system.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it exists."""
    folder, system = _folder(spark, path)
    system.mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder; none if that doesn't exist."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [entry.getPath().toString() for entry in system.listStatus(folder) if entry.isDirectory()]


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if that doesn't exist."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(folder) if entry.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    file, system = _folder(spark, path)
    stream = system.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file so that it is there as a whole or not at all; False if it was there already."""
    file, system = _folder(spark, path)
    hidden, _ = _folder(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(file) or not system.rename(hidden, file):
        system.delete(hidden, False)
        return False
    return True


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The files cut the lineage, outlive lost executors and, unlike a row checkpoint, can be read
    column by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_alike(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` for several readers in one plan that share the work below it.

    Each reader alone would have the columns it lacks left out down to the files, so that no two send the same rows and every
    exchange of ``df`` is made once for each of them. A metric over ``columns`` keeps these in all plans: the exchanges are then
    equal, and Spark makes one and reads it again. It neither moves nor stores rows and keeps how they lie.
    """
    return df.observe(f"alike-{uuid.uuid4().hex}", F.count_if(F.hash(*columns) == 0).alias("rows"))
