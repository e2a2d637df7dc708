from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from allotment import contracts as c
from allotment.contracts import ContractError
from allotment.operators import cleaning
from allotment.plans import silver

from .plans import physical


def raw(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{name}` string" for name in columns))


OFFER = ("2024-01-05", "null", "2024-01-05 10:00:00", "20240105", "1.5", "12.7", " 0001 ", "Añejo", "N/A")
PEDIDO = ("M1", "3900", "2024-01-05", "E", "V", "x", "1.23456", None, "99999999999999999")


def test_sales_offers(spark):
    df = raw(spark, [*c.OFFERS_CASTS, "extra"], OFFER + ("z",))
    out = silver.sales_offers(df, "run-1")
    assert out.columns == [*c.OFFERS_CASTS, "execution_id"]
    assert out.dtypes[4] == ("KWMENG", "decimal(16,4)")
    assert tuple(out.first()) == (
        dt.date(2024, 1, 5), None, dt.datetime(2024, 1, 5, 10), None, Decimal("1.5000"), 12, "0001", "Anejo", None, "run-1",
    )


def test_time_of_day_needs_a_date(spark):
    df = raw(spark, c.OFFERS_CASTS, OFFER[:2] + ("13:15:00",) + OFFER[3:])
    assert silver.sales_offers(df, "r").first().ERZET is None
    anchored = silver.sales_offers(df, "r", time_anchor=F.lit("2024-03-01"))
    assert anchored.first().ERZET == dt.datetime(2024, 3, 1, 13, 15)


def test_orders(spark):
    out = silver.orders(raw(spark, c.ORDERS_CASTS, PEDIDO), "run-1")
    assert tuple(out.first()) == ("M1", 3900, dt.date(2024, 1, 5), "E", "V", None, Decimal("1.2346"), None, None, "run-1")


def test_priority_groups_and_previous_priorities(spark):
    groups = silver.priority_groups(raw(spark, c.PRIORITY_GROUPS_RENAMES, ("7", " Ñandú ", "", "g", "2.0")), "r")
    assert tuple(groups.first()) == (7, "Nandu", None, "g", 2, "r")
    previous = silver.previous_priorities(raw(spark, c.PREVIOUS_PRIORITIES_RENAMES, ("1", "nan", "alta")), "r")
    assert tuple(previous.first()) == ("1", None, None, "r")
    assert previous.columns == ["codigo", "cliente", "priorizacion", "execution_id"]


def test_silver_is_one_narrow_stage(spark, tmp_path):
    path = str(tmp_path / "offers")
    raw(spark, [*c.OFFERS_CASTS, "extra"], OFFER + ("z",)).write.parquet(path)
    plan = physical(silver.sales_offers(spark.read.parquet(path), "run-1"))
    assert "Exchange" not in plan and "extra" not in plan


def test_missing_columns_are_all_named(spark):
    with pytest.raises(ContractError, match="ERZET, FKDAT"):
        silver.sales_offers(raw(spark, c.OFFERS_CASTS, OFFER).drop("ERZET", "FKDAT"), "r")
    with pytest.raises(ContractError, match="Cliente"):
        cleaning.rename_columns(spark.createDataFrame([(1,)], "cliente int"), {"Cliente": "cliente"})


def test_only_strings_are_cleaned(spark):
    df = spark.createDataFrame([(1, " á ", True)], "n int, `t x` string, b boolean")
    assert tuple(cleaning.clean_null_tokens(df).first()) == (1, "á", True)
    assert tuple(cleaning.fold_accents_in_strings(df).first()) == (1, " a ", True)
    assert cleaning.clean_null_tokens(df).columns == ["n", "t x", "b"]


def test_lineage(spark):
    out = cleaning.add_lineage(
        spark.range(1), source_system="s", process_name="p", execution_id="e", source_object="o"
    )
    assert out.columns == ["id", "ingestion_timestamp", "source_system", "process_name", "execution_id", "source_object"]


def test_present_measures(spark):
    df = spark.createDataFrame([(1, 2)], "margen_bruto_cliente_sum int, distancia_cliente int")
    wanted = {"margin": "margen_bruto_cliente_sum", "stability": "cv", "distance": "distancia_cliente"}
    assert c.present_measures(df, wanted) == {"margin": True, "stability": False, "distance": True}
