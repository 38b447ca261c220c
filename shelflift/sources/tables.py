"""Reading and writing layer tables, and the folder for intermediate files."""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


# The folder of a local session that names none, by application.
_LOCAL: dict[str, str] = {}


def _scratch_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Only a session that is known to run in one process may go without that setting; its folder goes when the process ends.
    """
    base, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if base:
        return f"{base.rstrip('/')}/shelflift-{app}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="shelflift-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's scratch folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder; frames that read from it are of no use afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _layout_file(spark: SparkSession, path: str):
    """(file system, path) of the file beside a bucketed table's data that says how it is dealt; Spark's readers pass over such names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_layout.json")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _table_name(path: str) -> str:
    return "shelflift_" + hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored table; ``columns`` limits what is read from Parquet. A bucketed one keeps its dealing, also in a session that did not write it."""
    fs, at = _layout_file(spark, path)
    if fs.exists(at):
        stream = fs.open(at)
        layout = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        name = _table_name(path)
        if not spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f}` {kind}" for f, kind in layout["columns"])
            spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({_quoted(layout['by'])}) SORTED BY ({_quoted(layout['sort'])}) "
                      f"INTO {layout['buckets']} BUCKETS LOCATION '{path.rstrip('/')}'")
        df = spark.table(name)
    else:
        df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def _store_bucketed(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str], buckets: int | None, dealt: bool) -> DataFrame:
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = df if dealt else df.repartition(buckets, *by)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*sort).option("path", path).saveAsTable(name)
    fs, at = _layout_file(spark, path)
    stream = fs.create(at, True)
    stream.write(json.dumps({"by": list(by), "sort": list(sort), "buckets": buckets, "columns": spark.table(name).dtypes}).encode())
    stream.close()
    return spark.table(name)


def materialize(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Store ``df``, replacing what is there, and return the stored table.

    ``cluster_by`` range-partitions and sorts the rows, so that Parquet min/max statistics let later
    reads skip row groups. It names enough columns to tell rows of a hot first key apart; those then lie in several files.

    ``bucket_by`` deals the rows by hash of these columns into ``buckets`` files (default: the session's shuffle partitions) that Spark knows of: readers from this
    function or :func:`read_table` aggregate, window and join on these columns without an exchange. Files are sorted by ``cluster_by`` then. ``dealt``: the rows
    already come dealt by these columns into so many partitions, and are not dealt again. Meant for keys with a bounded number of rows each.
    """
    if bucket_by:
        return _store_bucketed(df, path, bucket_by, cluster_by or bucket_by, buckets, dealt)
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
