"""Writing frames: tables, views, snapshots, files, checkpoints."""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.filters import plan_text
from tidemark.operators.quality import save_schema


def _save(df: DataFrame, name: str, mode: str, path: str | None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    df.write.options(**({"path": path} if path else {})).mode(mode).partitionBy(*partition_by).saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_table(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), path: str | None = None
) -> DataFrame:
    """Replace a table by the frame and return the stored table.

    With ``path`` (here and below) the files go there instead of the warehouse folder.
    """
    return _save(df, name, "overwrite", path, partition_by)


def write_sorted(
    df: DataFrame, name: str, key: str, files: int | None = None, path: str | None = None
) -> DataFrame:
    """Replace a table by the frame, laid out by ``key`` so that scans can skip row groups.

    The range exchange also orders on a hash of the row, so rows that share one key value
    spread over several files instead of filling one.
    """
    cuts = [F.col(key), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *cuts) if files else df.repartitionByRange(*cuts)
    return _save(ranged.sortWithinPartitions(key), name, "overwrite", path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def schema_name(custom: str | None, default: str) -> str:
    """The schema a model goes to: its own, used as it is, or the default one."""
    return default if custom is None else custom.strip()


def snapshot(
    spark: SparkSession, table: str, at: dt.datetime | None = None, where=None, path: str | None = None
) -> tuple[str, DataFrame]:
    """An unchanging copy of a table, or of the part ``where`` selects, with the time in its name."""
    at = at or dt.datetime.now()
    name = f"{table}_{at:%Y_%m_%d__%H_%M_%S}"
    df = spark.table(table)
    return name, _save(df if where is None else df.filter(where), name, "errorifexists", path)


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None) -> None:
    """The rows as CSV, without a row-number column.

    Times keep their microseconds, which Spark's default CSV format would cut off.
    """
    writer = df.write.mode("overwrite").option("header", header)
    for kind in ("timestampFormat", "timestampNTZFormat"):
        writer = writer.option(kind, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    (writer.option("compression", compression) if compression else writer).csv(path)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def checkpoint_frame(df: DataFrame, path: str) -> DataFrame:
    """Store plan text, schema and data of a frame, and return the frame read back.

    The data is written by the executors; lineage ends at the files.
    """
    spark = df.sparkSession
    plan = spark.createDataFrame([(plan_text(df),)], "value string")
    plan.coalesce(1).write.mode("overwrite").text(f"{path}/plan")
    save_schema(df, f"{path}/schema")
    df.write.mode("overwrite").parquet(f"{path}/data")
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Without that setting, in local mode, the results go
    below the warehouse folder (``spark.sql.warehouse.dir``).  On a cluster that folder may be one of the
    driver's machine, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return posixpath.join(spark.conf.get("spark.sql.warehouse.dir"), "_stored")


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any store that Spark can write to; false if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_STORED: dict[str, list[str]] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, computed once and read back from parquet files in the shared folder.

    For frames that several later passes read: lost executors lose nothing, and each pass
    reads only the columns and row groups it needs.  ``release_stored`` deletes the files.
    """
    spark = df.sparkSession
    path = posixpath.join(shared_folder(spark), f"stored-{uuid.uuid4().hex}")
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_so_far(spark: SparkSession) -> int:
    """How many frames ``cut_lineage`` has stored for this application; a mark for ``release_stored``."""
    return len(_STORED.get(spark.sparkContext.applicationId, []))


def release_stored(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Delete what ``cut_lineage`` has stored for this application; the number of folders.

    Call it when the results that were built on them have been written.  ``since`` (see ``stored_so_far``)
    leaves what was stored before a job began, ``keep`` the frame that the job returns.
    """
    paths = _STORED.get(spark.sparkContext.applicationId, [])
    needed = set() if keep is None else {posixpath.basename(posixpath.dirname(f)) for f in keep.inputFiles()}
    gone = [p for p in paths[since:] if posixpath.basename(p) not in needed]
    _STORED[spark.sparkContext.applicationId] = [p for p in paths if p not in set(gone)]
    for path in gone:
        delete_folder(spark, path)
    return len(gone)
