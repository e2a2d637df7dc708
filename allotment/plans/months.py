"""Monthly sums that are kept, so that only months whose files changed are read again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import measures
from ..runtime import materialise
from ..sources import files, sinks
from ..sources.tables import table_exists

#: The partition of the fact and of its sums: year and month as one number, 202401.
MONTH = "mes"


def with_month(fact: DataFrame, date: str = "fecha") -> DataFrame:
    """The fact with its month; rows without a readable date have none."""
    return fact.withColumn(MONTH, F.date_format(F.col(date).try_cast("date"), "yyyyMM").cast("int"))


def append_fact(fact: DataFrame, path: str, date: str = "fecha") -> None:
    """Add rows to a fact that lies in one folder per month. Large months are split between tasks."""
    with_month(fact, date).hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(path)


def files_by_month(spark: SparkSession, path: str) -> DataFrame:
    """``(mes, files, bytes_read, mark)`` per month of the fact: what its sums are made from.

    ``mark`` changes when a file of the month comes, goes or is written again. Rows without a
    month are in no window, so their folder does not count.
    """
    month = F.regexp_extract("archivo_origen", rf"/{MONTH}=(\d+)/", 1).try_cast("int")
    return (
        files.listing(spark, path).withColumn(MONTH, month).filter(F.col(MONTH).isNotNull())
        .groupBy(MONTH).agg(
            F.count("*").alias("files"), F.sum("bytes_read").alias("bytes_read"),
            F.bit_xor(F.xxhash64("archivo_origen", "bytes_read", "modified")).alias("mark"),
        )
    )


def refresh_months(
    spark: SparkSession,
    fact_path: str,
    sums_table: str,
    record_table: str,
    *,
    customer: str = "cod_cliente",
    date: str = "fecha",
    margin: str = "cc_utilidad_bruta",
    sales: str = "valor_neto",
    sums_path: str | None = None,
    record_path: str | None = None,
) -> list[int]:
    """Bring the kept sums up to the fact; return the months that were read, in order.

    ``sums_table`` holds margin and sales per customer and date, partitioned by month;
    ``record_table`` which files each month's sums were made from. Months whose files are the
    recorded ones are not read; those that changed are summed whole and replace their partition;
    sums of months that the fact no longer has go. The record is written
    last: a run cut off before that reads its months once more and changes nothing else.
    Months, not rows, pass through the driver.
    """
    now = materialise(files_by_month(spark, fact_path), "months_now")
    known = table_exists(spark, record_table) and table_exists(spark, sums_table)
    before = spark.table(record_table) if known else now.limit(0)
    both = now.alias("now").join(before.alias("old"), MONTH, "full_outer")
    same = F.col("now.mark").eqNullSafe(F.col("old.mark")) & F.col("now.files").eqNullSafe(F.col("old.files"))
    changed = both.filter(~same).select(MONTH, F.col("now.files").isNotNull().alias("there")).collect()
    if not changed:
        return []
    months, filled = sorted(row[MONTH] for row in changed if row["there"]), set()
    if months:
        folders = [f"{fact_path.rstrip('/')}/{MONTH}={month}" for month in months]
        fact = spark.read.option("basePath", fact_path).parquet(*folders)  # other folders are not even listed
        sums = measures.sums_by(fact, [customer, date, MONTH], {"margen_bruto": margin, "venta_neta": sales})
        sums = materialise(sums, "month_sums")
        sinks.replace_runs(sums.hint("rebalance", MONTH), sums_table, MONTH, sums_path)
        filled = {row[MONTH] for row in sums.select(MONTH).distinct().collect()}
    for row in changed:
        if row[MONTH] not in filled:
            spark.sql(f"ALTER TABLE {sums_table} DROP IF EXISTS PARTITION ({MONTH} = {row[MONTH]})")
    sinks.refresh_table(now, record_table, record_path)
    return months


def month_number(day: dt.date, back: int = 0) -> int:
    """The month of a day, or of one ``back`` months before, as in ``MONTH``."""
    count = day.year * 12 + day.month - 1 - back
    return count // 12 * 100 + count % 12 + 1


def kept_fact(sums: DataFrame, cutoff: dt.date | None, months: int, date: str = "fecha") -> DataFrame:
    """The kept sums inside the window, in the shape of the fact, so that the index can read them in its place.

    Two literals bound the month, so other partitions are not read; the window's
    own dates are compared as well.
    """
    if cutoff is None:
        return _as_fact(sums.limit(0))
    bounded = sums.filter(F.col(MONTH).between(month_number(cutoff, months - 1), month_number(cutoff)))
    return _as_fact(measures.in_window(bounded, cutoff, months, date))


def _as_fact(sums: DataFrame) -> DataFrame:
    return sums.withColumnsRenamed({"margen_bruto": "cc_utilidad_bruta", "venta_neta": "valor_neto"}).drop(MONTH)
