"""Kept monthly sums against sums over all rows."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from allotment.operators import measures
from allotment.plans import months
from allotment.sources import sinks

from .plans import formatted


def fact(spark, rows):
    exact = [(c, d, *(None if x is None else Decimal(x) for x in amounts)) for c, d, *amounts in rows]
    return spark.createDataFrame(exact, "cod_cliente string, fecha date, cc_utilidad_bruta decimal(18,4), valor_neto decimal(18,4)")


def day(text):
    return dt.date.fromisoformat(text) if text else None


ROWS = [
    (f"c{k % 5}", day(f"2024-{1 + k % 4:02d}-{1 + k % 28:02d}"), k, k * 2) for k in range(60)
] + [(None, day("2024-02-03"), 1, 1), ("c1", None, 5, 5), ("c1", day("2024-02-03"), None, 7)]


@pytest.fixture
def store(spark, tmp_path):
    names = ("months_sums", "months_record")
    yield tmp_path, lambda: months.refresh_months(
        spark, str(tmp_path / "fact"), *names, sums_path=str(tmp_path / "sums"), record_path=str(tmp_path / "record")
    )
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def agree(spark, rows, cutoff="2024-04-30", width=4):
    key = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    kept = measures.monthly_by_customer(months.kept_fact(spark.table("months_sums"), day(cutoff), width))
    assert key(kept) == key(measures.monthly_by_customer(measures.in_window(fact(spark, rows), day(cutoff), width)))


def unreadable(folder: Path):
    """Spoil the files of a month without changing their size and time."""
    for file in folder.glob("*.parquet"):
        time = file.stat()
        file.write_bytes(b"?" * time.st_size)
        os.utime(file, ns=(time.st_atime_ns, time.st_mtime_ns))


def test_only_changed_months_are_read(spark, store):
    root, bring = store
    months.append_fact(fact(spark, ROWS), str(root / "fact"))
    assert bring() == [202401, 202402, 202403, 202404] and bring() == []
    agree(spark, ROWS)
    agree(spark, ROWS, "2024-03-10", 2)  # a window that begins and ends inside months
    late = [("c9", day("2024-02-28"), 9, 9), ("c0", day("2024-05-01"), 1, 1)]
    months.append_fact(fact(spark, late), str(root / "fact"))
    unreadable(root / "fact" / "mes=202401")
    unreadable(root / "fact" / "mes=202403")
    assert bring() == [202402, 202405]
    agree(spark, ROWS + late, "2024-05-31", 5)


def test_months_that_go_or_become_empty(spark, store):
    root, bring = store
    months.append_fact(fact(spark, ROWS), str(root / "fact"))
    bring()
    for file in (root / "fact" / "mes=202401").iterdir():
        file.unlink()
    empty = root / "fact" / "mes=202403"
    for file in empty.iterdir():
        file.unlink()
    fact(spark, []).write.mode("append").parquet(str(empty))
    assert bring() == [202403]
    agree(spark, [r for r in ROWS if r[1] and r[1].month in (2, 4)])
    assert sorted(r.mes for r in spark.table("months_record").collect()) == [202402, 202403, 202404]


def test_run_cut_off_before_the_record(spark, store, monkeypatch):
    root, bring = store
    months.append_fact(fact(spark, ROWS), str(root / "fact"))
    bring()
    late = [("c2", day("2024-03-05"), 3, 3)]
    months.append_fact(fact(spark, late), str(root / "fact"))
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "refresh_table", lambda *a, **k: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            bring()
    assert bring() == [202403] and bring() == []
    agree(spark, ROWS + late)


def test_empty_fact_and_missing_cutoff(spark, store):
    root, bring = store
    (root / "fact").mkdir()
    months.append_fact(fact(spark, ROWS[:1]), str(root / "fact"))
    bring()
    assert months.kept_fact(spark.table("months_sums"), None, 12).isEmpty()
    assert months.kept_fact(spark.table("months_sums"), day("2020-01-01"), 12).isEmpty()


def test_window_reads_its_partitions_only(spark, store):
    root, bring = store
    months.append_fact(fact(spark, ROWS), str(root / "fact"))
    bring()
    plan = formatted(months.kept_fact(spark.table("months_sums"), day("2024-03-31"), 2))
    assert "PartitionFilters" in plan and "(mes#" in plan and "202402" in plan and "202403" in plan


@pytest.mark.parametrize("text, back, number", [("2024-01-31", 0, 202401), ("2024-01-31", 1, 202312), ("2024-03-01", 14, 202301), ("2024-12-01", 12, 202312)])
def test_month_numbers(text, back, number):
    assert months.month_number(day(text), back) == number
