"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "corpuslens", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators are tuned for.

    ``extra`` keys use ``__`` for the dots of a setting name.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is missing, ``use_folder`` must have named one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _folders.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def use_folder(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of an application whose ``spark.checkpoint.dir`` is unset."""
    _folders[spark.sparkContext.applicationId] = folder


def ensure_folder(spark: SparkSession) -> None:
    """For entry points: name a folder of this machine if none is named and the master is local."""
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.applicationId in _folders
    if not known and context.master.split("[")[0] == "local":
        use_folder(spark, tempfile.mkdtemp(prefix="corpuslens-"))


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(spark: SparkSession) -> int:
    """Number of tables this application has written and not deleted, for ``release``."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Delete the tables this application has written; call it when no result reads them any more.

    ``since`` spares the first tables, ``keep`` those whose name begins so.
    """
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone = [p for p in paths[since:] if keep is None or not p.rsplit("/", 1)[-1].startswith(keep)]
    for path in gone:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(configuration).delete(place, True)
    _written[spark.sparkContext.applicationId] = [p for p in paths if p not in set(gone)]


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``compression`` other than the session's is for large tables.

    The result has file statistics, survives the loss of executors and is not
    recomputed by the jobs that follow.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
    """``materialise`` for a table that is dealt to ``buckets`` tasks by ``key``: joins by it leave the table where it is."""
    spark, path, entry = df.sparkSession, fresh_path(df.sparkSession, name), f"bucketed_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key).option("path", path).saveAsTable(entry)
    return spark.table(entry)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is made of, as the planner knows them without reading any."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)  # what has no known size counts as almost endless


_shipped: set[tuple[str, str]] = set()


def ship_code(spark: SparkSession, folder: str, *packages: str) -> None:
    """Send packages to the Python workers, once per application.

    Not needed where the cluster already has them installed.
    """
    app = spark.sparkContext.applicationId
    for package in packages:
        if (app, package) not in _shipped:
            base = os.path.join(tempfile.mkdtemp(prefix="corpuslens-code-"), package)
            spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", folder, package))
            _shipped.add((app, package))
