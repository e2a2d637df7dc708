from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allotment import contracts as c
from allotment.contracts import ContractError
from allotment.plans import index

from . import brute
from .plans import physical

FACT = T.StructType([
    T.StructField("cod_cliente", T.StringType()),
    T.StructField("fecha", T.DateType()),
    T.StructField("cc_utilidad_bruta", T.DecimalType(18, 4)),
    T.StructField("valor_neto", T.DecimalType(18, 4)),
])
CUSTOMER = T.StructType([
    T.StructField(name, T.IntegerType() if name == "lprio" else T.StringType()) for name in c.CUSTOMER_COLUMNS
])
CUTOFF = dt.date(2024, 6, 1)


def customer(code, chain=None, centre="3900", lat="9.0", lon="-79.0", prio=None, group="g", **other):
    row = dict.fromkeys(c.CUSTOMER_COLUMNS, "x")
    return row | {
        "cod_cliente": code, "cod_cadena": chain, "id_centro": centre, "latitud": lat, "longitud": lon,
        "lprio": prio, "grupo_economico": group,
    } | other


def sale(code, month, margin, sales, year=2024):
    return {
        "cod_cliente": code, "fecha": None if month is None else dt.date(year, month, 1),
        "cc_utilidad_bruta": brute.money(margin), "valor_neto": brute.money(sales),
    }


def frames(spark, fact, customers, cutoff=CUTOFF):
    return {
        "profitability": spark.createDataFrame([tuple(r[f] for f in FACT.fieldNames()) for r in fact], FACT),
        "cost_to_serve": spark.createDataFrame([(cutoff,), (dt.date(2020, 1, 1),)], "fecha date"),
        "customers": spark.createDataFrame([tuple(r[f] for f in c.CUSTOMER_COLUMNS) for r in customers], CUSTOMER),
    }


def run(spark, fact, customers, **options):
    ranked = index.priority_index(frames(spark, fact, customers), index.IndexOptions(**options))
    return [tuple(row) for row in ranked.orderBy("prioridad").collect()]


def same(found, expected):
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    for left, right in zip(found, expected):
        assert left[2] == (None if right[2] is None else pytest.approx(right[2], abs=1e-9))


EDGE_FACT = [
    sale("A", 1, 5, 10), sale("A", 2, -5, -10), sale("A", 3, -5, 10), sale("A", 6, 5, -10),
    sale("B", 1, 5, 0), sale("B", 2, None, 10), sale("C", 3, 5, None), sale("C", 4, 7, 20),
    sale("D", 5, None, None), sale("E", 5, 4, 9), sale("E", 5, 1, 2), sale("F", 4, 3, 9),
    sale("G", 7, 100, 100), sale("G", 6, 100, 100, 2023), sale("H", 7, 2, 9, 2023), sale("I", None, 2, 9),
    sale(None, 5, 2, 9), sale("K", 5, 1, 3), sale("L", 5, 1, 3), sale("M", 5, 1, 3),
]
EDGE_CUSTOMERS = [
    customer("A", "CH1", prio=3), customer("B", "  "), customer("C", "CH1", centre="3905", lat="9.07.47"),
    customer("D", ""), customer("E", "CH2", prio=3), customer("E", "CH3", prio=1, group="h"),
    customer("E", "CH3", prio=1, group="i", nombre_cliente="y"), customer("F", "A", lat=" 8,5N", lon="-80 W"),
    customer("G", "CH9", lat=None), customer("H", None, centre="4100", prio=2), customer("K", "CH1", lon="n/a"),
    customer("L", "CH4"), customer("L", "CH4"), customer("L", "CH4", lat="9.5", lon="-80"),
    customer(None, "CH1"),
]


def test_edges_against_brute_force(spark):
    expected = brute.priority_index(EDGE_FACT, EDGE_CUSTOMERS, CUTOFF)
    same(run(spark, EDGE_FACT, EDGE_CUSTOMERS), expected)
    assert len(expected) > 15


def test_hot_keys_take_the_broadcast_path_with_the_same_result(spark):
    expected = brute.priority_index(EDGE_FACT, EDGE_CUSTOMERS, CUTOFF)
    same(run(spark, EDGE_FACT, EDGE_CUSTOMERS, hot_minimum=1), expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_frames_against_brute_force(spark, seed):
    rng = random.Random(seed)
    codes = [f"c{i}" for i in range(30)]
    # One chain holds a third of the customers, one customer a third of the fact.
    chains = ["big"] * 10 + [f"ch{i}" for i in range(5)] + ["", "  ", None] * 5
    fact = [
        sale(rng.choice(codes + ["c0"] * 15), rng.randint(1, 12), rng.randint(-50, 80), rng.randint(-60, 200),
             rng.choice([2023, 2024]))
        for _ in range(400)
    ]
    customers = [
        customer(
            rng.choice(codes), rng.choice(chains), rng.choice(["3900", "3903", "3905", "3904", "4100"]),
            rng.choice(["9.1", "8.25 N", "n/a", None]), rng.choice(["-79.5", "-80.25W", ""]),
            rng.choice([None, None, 1, 2]), rng.choice(["g", "h"]),
        )
        for _ in range(60)
    ]
    same(run(spark, fact, customers, hot_minimum=5), brute.priority_index(fact, customers, CUTOFF))


@pytest.mark.parametrize("seed", [4, 5])
def test_single_listings_against_brute_force(spark, seed):
    rng = random.Random(seed)
    codes = [f"c{i}" for i in range(40)]
    fact = [
        sale(rng.choice(codes + [None]), rng.randint(1, 12), rng.randint(-50, 80), rng.randint(-60, 200), rng.choice([2023, 2024]))
        for _ in range(300)
    ]
    customers = [
        customer(code, rng.choice(["big", "big", "ch", "c3", "", None]), rng.choice(["3900", "3903", "4100", None]),
                 rng.choice(["9.1", "8.25 N", "n/a", None]), rng.choice(["-79.5", "-80.25W", ""]), rng.choice([None, None, 1, 2]))
        for code in codes[:35] + [None, None]
    ]
    assert index.listed_once(frames(spark, fact, customers)["customers"])
    same(run(spark, fact, customers), brute.priority_index(fact, customers, CUTOFF))


def test_both_ways_agree_on_single_listings(spark):
    inputs = frames(spark, EDGE_FACT, [customer("A", "CH1"), customer("B", centre="4100"), customer("C", " ", lat="x")])
    monthly, customers = index.window_months(inputs), inputs["customers"]
    general = index.linked_months(monthly, index.all_listings(customers))
    simple = index.linked_months(monthly, index.single_listings(customers))
    columns = [name for name in general.columns if name != "attribute_rows"]
    left, right = (sorted(map(str, df.select(*columns).collect())) for df in (general, simple))
    assert left == right


def test_ranks_are_one_to_n(spark):
    fact = [sale(f"c{i:03d}", 1 + i % 6, 1, 2) for i in range(300)]
    found = run(spark, fact, [customer(f"c{i:03d}") for i in range(300)])
    assert [row[1] for row in found] == list(range(1, 301))
    assert [row[0] for row in found] == [f"c{i:03d}" for i in range(300)]  # all tied: by code


@pytest.mark.parametrize("kind", ["timestamp", "string"])
def test_dates_of_other_types(spark, kind):
    expected = brute.priority_index(EDGE_FACT, EDGE_CUSTOMERS, CUTOFF)
    inputs = frames(spark, EDGE_FACT, EDGE_CUSTOMERS)
    for role in ("profitability", "cost_to_serve"):
        inputs[role] = inputs[role].withColumn("fecha", F.col("fecha").cast(kind))
    for minimum in (1, 1000):
        ranked = index.priority_index(inputs, index.IndexOptions(hot_minimum=minimum))
        same([tuple(row) for row in ranked.orderBy("prioridad").collect()], expected)


def test_moments_of_one_day_count_apart(spark):
    inputs = frames(spark, [sale("A", 5, 1, 2), sale("A", 5, 1, 4)], [customer("A")])
    moments = inputs["profitability"].withColumn("fecha", F.expr(
        "cast(fecha as timestamp) + make_interval(0, 0, 0, 0, cast(valor_neto as int))"))
    chains = index.chain_measures(index.linked_months(
        index.window_months(inputs | {"profitability": moments}), index.all_listings(inputs["customers"])))
    assert chains.first().margen_porcentual_prom == pytest.approx((1 / 2 + 1 / 4) / 2)


def test_cutoff_can_be_given_and_need_not_start_a_month(spark):
    fact = [sale("A", 5, 1, 4), sale("B", 6, 1, 2)]
    assert [r[0] for r in run(spark, fact, [], cutoff="2024-05-31")] == ["A"]
    assert [r[0] for r in run(spark, fact, [], cutoff=dt.date(2024, 6, 15), months=1)] == []
    assert [r[0] for r in run(spark, fact, [], cutoff=dt.date(2024, 6, 15), months=2)] == ["B"]


def test_first_listing_only(spark):
    found = run(spark, EDGE_FACT, EDGE_CUSTOMERS, on_duplicate="first")
    assert sum(1 for row in found if row[0] == "E") == 2  # one per previous priority
    assert sum(1 for row in found if row[0] == "L") == 1


def test_duplicate_listing_can_be_an_error(spark):
    with pytest.raises(Exception, match="customer listed more than once"):
        run(spark, EDGE_FACT, EDGE_CUSTOMERS, on_duplicate="error")
    with pytest.raises(ValueError):
        run(spark, EDGE_FACT, EDGE_CUSTOMERS, on_duplicate="some")


def test_group_order_fills_missing_priorities(spark):
    fact = [sale("A", 5, 9, 10), sale("B", 5, 1, 10), sale("C", 5, 2, 10)]
    inputs = frames(spark, fact, [customer("A"), customer("B"), customer("C", prio=4)])
    inputs["priority_groups"] = spark.createDataFrame([("B", 2), ("C", 1)], "cod_cliente string, orden_grupo int")
    ranked = index.priority_index(inputs, index.IndexOptions(use_group_order=True))
    assert [row.cod_cliente for row in ranked.orderBy("prioridad").collect()] == ["B", "C", "A"]


def test_text_priorities_sort_as_numbers(spark):
    inputs = frames(spark, [sale("A", 5, 9, 10), sale("B", 5, 1, 10)], [customer("A", prio=10), customer("B", prio=2)])
    inputs["customers"] = inputs["customers"].withColumn("lprio", F.col("lprio").cast("string"))
    ranked = index.priority_index(inputs)
    assert [row.cod_cliente for row in ranked.orderBy("prioridad").collect()] == ["B", "A"]


def test_no_rows_in_the_window(spark):
    assert run(spark, [sale("A", 1, 1, 1, 2000)], [customer("A")]) == []


def test_double_amounts_keep_their_digits(spark):
    inputs = frames(spark, [sale(k, 5, "0.1", "0.3") for k in ("A", "A", "B", "C")], [customer("A")])
    amounts = {"A": 0.00004, "B": 1e15, "C": float("nan")}
    value = F.create_map(*[F.lit(x) for pair in amounts.items() for x in pair])[F.col("cod_cliente")]
    inputs["profitability"] = inputs["profitability"].withColumns({"cc_utilidad_bruta": value, "valor_neto": value})
    months = {r.cod_cliente: r.margen_bruto for r in index.window_months(inputs).collect()}
    assert (months["A"], months["B"]) == (0.00008, 1e15) and months["C"] != months["C"]


def test_different_scores_are_different_ranks(spark):
    inputs = frames(spark, [sale("A", 5, 1, 1), sale("B", 5, 1, 1)], [customer("A"), customer("B")])
    tiny = F.when(F.col("cod_cliente") == "B", 1.0 + 4e-10).otherwise(1.0)
    inputs["profitability"] = inputs["profitability"].withColumns({"cc_utilidad_bruta": tiny, "valor_neto": F.lit(1.0)})
    names = lambda digits: [r.cod_cliente for r in index.priority_index(inputs, index.IndexOptions(digits=digits)).orderBy("prioridad").collect()]
    assert names(None) == ["B", "A"] and names(9) == ["A", "B"]


def test_missing_role_and_column_are_named(spark):
    inputs = frames(spark, [], [])
    with pytest.raises(ContractError, match="cost_to_serve"):
        index.priority_index({k: v for k, v in inputs.items() if k != "cost_to_serve"})
    with pytest.raises(ContractError, match="lprio"):
        index.priority_index(inputs | {"customers": inputs["customers"].drop("lprio")})


def test_without_ansi_the_result_is_the_same(spark):
    expected = brute.priority_index(EDGE_FACT, EDGE_CUSTOMERS, CUTOFF)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        same(run(spark, EDGE_FACT, EDGE_CUSTOMERS), expected)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_stamp(spark):
    row = index.stamp(spark.createDataFrame([("A", 1, 0.5)], "cod_cliente string, prioridad bigint, margen_porcentual double"), "run-9").first()
    assert (row.Estatus, row.execution_id) == ("N", "run-9") and row.create_timestamp is not None


def test_months_are_shuffled_by_customer_once(spark):
    inputs = frames(spark, EDGE_FACT, [customer("A", "CH1")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listings = index.single_listings(inputs["customers"])
        linked = index.linked_months(index.window_months(inputs), listings)
        plan = physical(linked)
        # Sums per customer and date; those by customer; the dimension by customer.
        assert plan.count("Exchange hashpartitioning") == 3
        assert "SinglePartition" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
