"""Writes of the Bronze, Silver and Gold layers, logs and the publication.

Row counts are observed by the job that writes, so nothing is scanned twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from queue import Empty, SimpleQueue
from threading import Thread
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as c
from .jdbc import Connection, write_jdbc, write_mode
from .paths import qualified
from .tables import table_exists


def counted(df: DataFrame, write: Callable[[DataFrame], None], patience: float = 60.0) -> int:
    """Run ``write`` on the frame and return how many rows went through.

    Counts arrive in the order of their jobs. So a count that is there no later than that of a
    one-row job run after the write is late, however long both take; if it is still
    missing then, the write ran no action on the frame it was given, which is an error.
    """
    seen, after, answer = Observation(), Observation(), SimpleQueue()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    Thread(target=lambda: answer.put(seen.get["rows"]), daemon=True).start()
    df.sparkSession.range(1).observe(after, F.count(F.lit(1)).alias("rows")).collect()
    after.get
    try:
        return int(answer.get(timeout=patience))
    except Empty:
        raise RuntimeError("the write ran no action on the rows it was given") from None


def output_format(record: Mapping[str, object], default: str = "delta") -> str:
    """``parquet`` if the extension or the load type says so, else ``default``."""
    named = {str(record.get(name) or "").strip().lower().lstrip(".")
             for name in ("extension_archivo_destino", "tipo_carga")}
    if "parquet" in named:
        return "parquet"
    return "delta" if "delta" in named else default


def write_bronze(
    df: DataFrame, path: str, file_format: str = "parquet", partition_by: list[str] | None = None
) -> int:
    """Overwrite the path; return the number of rows written."""
    writer_options = {"mergeSchema": "true"} if file_format == "delta" else {}

    def write(rows: DataFrame) -> None:
        writer = rows.write.format(file_format).mode("overwrite").options(**writer_options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)

    return counted(df, write)


def empty_like(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.limit(0)


def refresh_table(df: DataFrame, table: str, path: str | None = None, file_format: str = "parquet") -> int:
    """Replace data and schema of a table; return the number of rows written.

    The rows are written to a fresh folder (below ``path`` if given, else next to the
    table's place in its database). Only when all are there the catalogue entry is
    turned to it, and only then the old files go. So until then readers and a failed
    refresh have the old rows and the old schema. The entry is external: the files belong to it,
    but a DROP TABLE leaves them. Formats with a log of their own replace the table in place.
    """
    spark = df.sparkSession
    if file_format not in FOLDER_FORMATS:
        return counted(df, lambda rows: _writer(rows, file_format, path).saveAsTable(table))
    _recover(spark, table)
    old = table_location(spark, table)
    fresh = f"{(path or _place(spark, table)).rstrip('/')}/{uuid4().hex}"
    try:
        rows = counted(df, lambda given: given.write.format(file_format).save(fresh))
        point_table(spark, table, df.schema, fresh, file_format)
    except BaseException:
        if table_location(spark, table) != qualified(spark, fresh):
            delete_below(spark, fresh)
        raise
    if old:
        delete_below(spark, old, keep=fresh)
    return rows


#: File formats whose tables are folders of files without a log.
FOLDER_FORMATS = ("parquet", "orc", "avro", "json", "csv")


def _writer(rows: DataFrame, file_format: str, path: str | None):
    out = rows.write.format(file_format).mode("overwrite").option("overwriteSchema", "true")
    return out.option("path", path) if path else out


def _place(spark: SparkSession, table: str) -> str:
    """Where the versions of a table without a path lie."""
    *database, name = table.replace("`", "").split(".")
    where = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/{name}.versions"


def _next(table: str) -> str:
    return f"{table.rstrip('`')}__next{'`' if table.endswith('`') else ''}"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {'.'.join(new.split('.')[-2:])}")


def _recover(spark: SparkSession, table: str) -> None:
    """Finish or forget a change of schema that was cut off between its two entries."""
    if spark.catalog.tableExists(_next(table)):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {_next(table)}")
        else:
            _rename(spark, _next(table), table)


def point_table(spark: SparkSession, table: str, schema: T.StructType, location: str, file_format: str) -> None:
    """Make a catalogue entry show the files at ``location``.

    With the schema it has this is one change of the entry. A new schema gets an entry of its own
    first, which then takes the old one's name.
    """
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=location, source=file_format, schema=schema)
        return
    now = spark.table(table).schema
    if [(f.name, f.dataType) for f in now] == [(f.name, f.dataType) for f in schema] and not partition_columns(spark, table):
        quoted = location.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
    else:
        spark.catalog.createTable(_next(table), path=location, source=file_format, schema=schema)
        spark.sql(f"DROP TABLE {table}")
        _rename(spark, _next(table), table)
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder of a table's files; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return qualified(spark, told[-1]["data_type"]) if told else None


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def delete_below(spark: SparkSession, folder: str, keep: str | None = None) -> None:
    """Delete a folder; if ``keep`` lies in it, all that lies beside that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = qualified(spark, keep) if keep else None
    if kept == qualified(spark, folder) or not store.exists(path):
        return
    if kept and kept.startswith(f"{qualified(spark, folder)}/"):
        for child in store.listStatus(path):
            inner = child.getPath().toString()
            if kept != inner and not kept.startswith(f"{inner}/"):
                store.delete(child.getPath(), True)
    else:
        store.delete(path, True)


def _widen(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Add the columns the table lacks. (A Parquet table refuses a wider append.)"""
    known = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def append_rows(
    df: DataFrame,
    table: str,
    path: str | None = None,
    file_format: str = "parquet",
    partition_by: list[str] | None = None,
) -> int:
    """Append to a log table by column name; new columns are added, absent ones are NULL.

    ``path`` and ``partition_by`` apply when the table is created; partition a
    growing table by its run, so that reading one run skips the others.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        def create(rows: DataFrame) -> None:
            out = rows.write.format(file_format).mode("append")
            out = out.partitionBy(*partition_by) if partition_by else out
            (out.option("path", path) if path else out).saveAsTable(table)

        return counted(df, create)
    aligned = _aligned(df, table)
    return counted(aligned, lambda rows: rows.write.format(file_format).mode("append").insertInto(table))


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The rows with the table's columns in its order; the table is widened, absent columns are NULL."""
    spark = df.sparkSession
    _widen(spark, table, df.schema)
    present = set(df.columns)
    return df.select(*[
        F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema.fields
    ])


def replace_runs(
    df: DataFrame, table: str, run: str, path: str | None = None, file_format: str = "parquet", partition_by: list[str] | None = None
) -> int:
    """Write the rows of one or more runs; rows that the table has of these runs are replaced.

    A retried run therefore leaves its rows once. The table is partitioned by the run
    (``partition_by`` may name finer partitions after it), and only the
    partitions of the runs in ``df`` are overwritten, when their new files are complete. A table made before without that
    partition takes new runs as appended rows and refuses a run that it has.
    """
    spark, columns = df.sparkSession, partition_by or [run]
    if columns[0] != run:
        raise c.ContractError(f"the first partition must be the run, {run}")
    if not table_exists(spark, table):
        return append_rows(df, table, path, file_format, columns)
    aligned = _aligned(df, table)
    if run not in partition_columns(spark, table):
        known = spark.table(table).select(run).join(df.select(run).distinct(), run, "left_semi")
        if not known.isEmpty():
            raise c.ContractError(f"{table} has rows of this run and is not partitioned by {run}, so they cannot be replaced")
        return append_rows(df, table, path, file_format)
    if len(columns) > 1:  # finer partitions that a run no longer has go as well
        stale = spark.table(table).select(*columns).distinct().join(df.select(run).distinct(), run, "left_semi")
        stale = stale.join(df.select(*columns).distinct(), columns, "left_anti").collect()
    else:
        stale = []
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows = counted(aligned, lambda given: given.write.format(file_format).mode("overwrite").insertInto(table))
    for row in stale:
        spec = ", ".join(f"`{name}` = {_literal(row[name])}" for name in columns)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return rows


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def write_gold(
    df: DataFrame,
    snapshot: str,
    history: str,
    file_format: str = "parquet",
    snapshot_path: str | None = None,
    history_path: str | None = None,
    history_partition_by: list[str] | None = None,
    run: str = "execution_id",
) -> int:
    """Replace the snapshot, and the run's rows in the history by the very same rows.

    The history is fed from the written snapshot: the index is computed once
    and both tables agree on every rank and time. It is partitioned by ``run``, or by
    ``history_partition_by``, whose first column is the run; see ``replace_runs``. Rows
    without a run are appended.
    """
    spark = df.sparkSession
    rows = refresh_table(df, snapshot, snapshot_path, file_format)
    written = spark.table(snapshot)
    key = history_partition_by[0] if history_partition_by else run
    if key in df.columns:
        replace_runs(written, history, key, history_path, file_format, history_partition_by)
    else:
        append_rows(written, history, history_path, file_format)
    return rows


def publication_rows(index: DataFrame) -> DataFrame:
    """The four published columns, in order."""
    return c.require_columns(index, c.PUBLICATION_COLUMNS, "index").select(*c.PUBLICATION_COLUMNS)


def failure_kind(error: Exception) -> str:
    """The error's class, and its condition and SQL state where Spark gives them.

    A driver's own text may repeat the URL and its credentials, so it is left out.
    """
    marks = [error.getCondition(), error.getSqlState()] if isinstance(error, PySparkException) else []
    return " ".join([type(error).__name__, *(mark for mark in marks if mark)])


def publish(
    index: DataFrame,
    target: str,
    mode: str = "append",
    *,
    connection: Connection | None = None,
    connections: int = 8,
    write: Callable[[DataFrame, str, str], None] | None = None,
) -> dict[str, object]:
    """Write the published columns; return one metric record.

    An error becomes a record with status ``error``; raising is up to the
    caller. By default the target is a JDBC table, written over at most
    ``connections`` connections. Errors of a database are told by kind only, other
    targets' with their text.
    """
    record = {"rows_read": 0, "rows_written": 0, "target_table": target, "status": "success", "error_message": None}
    try:
        write_mode(mode)
        if write is None:
            if connection is None:
                raise c.ContractError("a connection is needed to publish over JDBC")
            write = lambda rows, table, how: write_jdbc(rows, connection, table, how, connections)
        rows = counted(publication_rows(index), lambda df: write(df, target, mode))
        return record | {"rows_read": rows, "rows_written": rows}
    except Exception as error:  # any failure of the sink is reported, not raised
        told = failure_kind(error) if connection else str(error)
        return record | {"status": "error", "error_message": told}


def publish_to_path(df: DataFrame, target: str, mode: str) -> None:
    """A file target for ``publish``: append to, or replace, a Parquet folder."""
    df.write.mode(write_mode(mode)[0]).parquet(target)
