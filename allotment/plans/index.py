"""The customer priority index.

The fact is scanned once. Its window is summed to one row per customer and date;
those rows are shuffled by customer, get the customer's totals and listings
attached there, and are written to scratch. Chains are one aggregate of that
frame, customers are its rows marked ``primera``, so neither needs another join
with the months.

The final order is by previous priority, chain rank and customer rank. A rank
is just the position in (score descending, code), so the final sort uses the
scores and codes themselves: one global sort in place of three.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as c
from ..functions.casts import to_contract_type
from ..functions.margin import guarded_ratio
from ..operators import distance, measures, ranking, skew
from ..runtime import materialise, materialise_watching

CHAIN_KEY = "cod_cliente_homologado"
SCORED = ("margen_porcentual", "margen_porcentual_prom", "distancia_norm")
ATTRIBUTES = [name for name in c.CUSTOMER_COLUMNS if name not in ("cod_cadena", "lprio")]


@dataclass(frozen=True)
class IndexOptions:
    cutoff: str | dt.date | None = None
    months: int = c.WINDOW_MONTHS
    centres: tuple = tuple(c.DISTRIBUTION_CENTRES)
    centre_codes: tuple | None = None  # default: the codes in ``centres``
    chain_weights: tuple[float, float, float] = c.CHAIN_WEIGHTS
    customer_weights: tuple[float, float, float] = c.CUSTOMER_WEIGHTS
    on_duplicate: str = "fanout"  # or first, error
    use_group_order: bool = False  # fill missing priorities from the priority groups
    hot_minimum: int = skew.HOT_MINIMUM
    digits: int | None = None  # of the scores; None keeps them as they are

    @property
    def codes(self) -> list[str]:
        return [str(code) for code in (self.centre_codes or [row[0] for row in self.centres])]


def check_inputs(inputs: Mapping[str, DataFrame]) -> None:
    """Fail unless the frames the index is computed from meet their contracts."""
    c.require_roles(inputs, ["profitability", "cost_to_serve", "customers"])
    c.require_columns(inputs["profitability"], c.PROFITABILITY_COLUMNS, "profitability")
    c.require_columns(inputs["cost_to_serve"], c.COST_TO_SERVE_COLUMNS, "cost_to_serve")
    c.require_columns(inputs["customers"], c.CUSTOMER_COLUMNS, "customers")


def window_months(inputs: Mapping[str, DataFrame], options: IndexOptions = IndexOptions()) -> DataFrame:
    """Margin and sales per customer and date inside the window."""
    cutoff = measures.resolve_cutoff(inputs["cost_to_serve"], options.cutoff)
    fact = measures.in_window(inputs["profitability"], cutoff, options.months)
    return measures.monthly_by_customer(fact)


def served_customers(customers: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    return distance.of_centres(customers, options.codes)


def customer_places(served: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """Per customer the largest distance and the number of distinct attribute rows."""
    distinct = served.select(*ATTRIBUTES).distinct()
    located = distance.distance_to_centre(distinct, options.centres)
    rows: Column = F.count("*")
    if options.on_duplicate == "first":
        rows = F.lit(1).cast("bigint")
    return located.groupBy("cod_cliente").agg(F.max("distancia").alias("distancia"), rows.alias("attribute_rows"))


def listed_once(customers: DataFrame) -> bool:
    """True when no customer code has more than one dimension row.

    One pass over the code column; repeated codes are counted before the shuffle.
    """
    counts = customers.filter(F.col("cod_cliente").isNotNull()).groupBy("cod_cliente").count()
    return (counts.agg(F.max("count")).first()[0] or 0) <= 1


def with_customer_measures(monthly: DataFrame) -> DataFrame:
    """Add the customer's sums and ratios to each of its dates; ``primera`` marks the first.

    A customer has at most one row per date and the window is some months long,
    so no customer has more than a few hundred rows here.
    """
    by_date = Window.partitionBy("cod_cliente").orderBy("fecha")
    every = by_date.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ratio = guarded_ratio(F.col("margen_bruto"), F.col("venta_neta"))
    return monthly.withColumns({
        "margen_bruto_sum": F.sum("margen_bruto").over(every),
        "venta_neta_sum": F.sum("venta_neta").over(every),
        "margen_porcentual_prom": F.avg(ratio).over(every),  # in the order of the dates
        "primera": F.row_number().over(by_date) == 1,
    }).withColumn("margen_porcentual", guarded_ratio(F.col("margen_bruto_sum"), F.col("venta_neta_sum")))


def single_listings(customers: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """Chain, distance and previous priority, when every customer is listed once.

    Nothing has to be deduplicated, so this is a projection.
    """
    located = distance.distance_to_centre(customers, options.centres)
    served = F.col("id_centro").isin(options.codes)
    one = F.lit(1).cast("bigint")
    return located.select(
        "cod_cliente",
        F.when(served, F.col("cod_cadena")).alias("cod_cadena"),
        F.when(served, F.col("distancia")).alias("distancia"),
        one.alias("copies"),
        one.alias("attribute_rows"),
        priority_of(customers).alias("priorizacion"),
    )


def all_listings(customers: DataFrame, options: IndexOptions = IndexOptions()) -> DataFrame:
    """One row per customer and chain it is listed under, whatever the dimension repeats."""
    served = served_customers(customers, options)
    links = measures.chain_links(served, options.on_duplicate)
    return links.join(customer_places(served, options), "cod_cliente")


def listings_of(customers: DataFrame, options: IndexOptions = IndexOptions()) -> tuple[bool, DataFrame]:
    """Whether every customer is listed once, and the listings by the way that suits."""
    single = listed_once(customers)
    return single, single_listings(customers, options) if single else all_listings(customers, options)


def linked_months(
    monthly: DataFrame, listings: DataFrame, hot_minimum: int = skew.HOT_MINIMUM
) -> DataFrame:
    """Months with the customer's measures, under each of its listings.

    Customers of other centres stay in: they have no chain and no distance.
    """
    if isinstance(monthly.schema["fecha"].dataType, T.DateType):
        joined = with_customer_measures(monthly).join(listings, "cod_cliente", "left")
    else:
        joined = _linked_moments(monthly, listings, hot_minimum)
    return measures.homologate(joined).withColumn("copies", F.coalesce("copies", F.lit(1)))


def _linked_moments(monthly: DataFrame, listings: DataFrame, hot_minimum: int) -> DataFrame:
    """The same where ``fecha`` is a time or a text, of which one customer may have any number.

    The customers' rows are aggregated, not gathered in a window, and joined
    back with the hot customers apart.
    """
    moments = materialise(monthly, "moments")
    extent = (F.count("*").alias("rows"), F.min("fecha").alias("first"))
    customers = measures.accumulate_dates(moments, "cod_cliente", extent)
    customers, size = materialise_watching(
        customers.join(listings, "cod_cliente", "left"), "customers",
        {"rows": F.sum("rows"), "largest": F.max("rows")},
    )
    hot = skew.hot_keys(customers, "rows", size["rows"], size["largest"], hot_minimum)
    joined = skew.join_to_groups(moments, customers, ["cod_cliente"], hot)
    return joined.withColumn("primera", F.col("fecha") == F.col("first")).drop("rows", "first")


def chain_measures(linked: DataFrame) -> DataFrame:
    """Measures, largest distance and number of listings per chain.

    Sums count a month once per copy of its listing. Chains whose margin sum is
    unknown are left out.
    """
    copies = F.col("copies").cast("int")
    by_date = linked.groupBy(CHAIN_KEY, "fecha").agg(
        F.sum(F.col("margen_bruto") * copies).alias("margen_bruto"),
        F.sum(F.col("venta_neta") * copies).alias("venta_neta"),
        F.max("distancia").alias("distancia"),
        F.count_if("primera").alias("members"),
    )
    ratio = guarded_ratio(F.col("margen_bruto"), F.col("venta_neta"))
    sums = by_date.groupBy(CHAIN_KEY).agg(
        F.sum("margen_bruto").alias("margen_bruto_sum"),
        F.sum("venta_neta").alias("venta_neta_sum"),
        measures.mean_ratio(ratio).alias("margen_porcentual_prom"),
        F.max("distancia").alias("distancia"),
        F.sum("members").alias("members"),
    )
    overall = guarded_ratio(F.col("margen_bruto_sum"), F.col("venta_neta_sum"))
    return sums.withColumn("margen_porcentual", overall).filter(F.col("margen_bruto_sum").isNotNull())


def scored(
    df: DataFrame,
    weights: tuple[float, float, float],
    name: str = "score",
    bounds: Mapping | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Scale the distance over the frame and weigh it with the two ratios."""
    return ranking.weighted_score(ranking.min_max_normalise(df, bounds=bounds), weights, SCORED, name, digits)


def priority_of(customers: DataFrame) -> Column:
    """The previous priority as a number, so that 10 comes after 2."""
    return to_contract_type(F.col("lprio"), customers.schema["lprio"].dataType, "int")


def previous_priorities(customers: DataFrame) -> DataFrame:
    """Distinct known previous priorities, taken before any centre filter."""
    return (
        customers.select("cod_cliente", priority_of(customers).alias("priorizacion"))
        .filter(F.col("priorizacion").isNotNull())
        .distinct()
    )


def fill_from_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Fill missing priorities with the order of the customer's priority group.

    ``groups`` has ``cod_cliente`` and ``orden_grupo``, or is the Silver table of
    priority groups with ``cliente`` and ``priorizacion``.
    """
    if not c.missing_columns(groups, ["cliente", "priorizacion"]):
        groups = groups.select(F.col("cliente").cast("string").alias("cod_cliente"), F.col("priorizacion").alias("orden_grupo"))
    c.require_columns(groups, ["cod_cliente", "orden_grupo"], "priority_groups")
    order = groups.groupBy("cod_cliente").agg(F.min(F.col("orden_grupo").try_cast("int")).alias("orden_grupo"))
    filled = F.coalesce("priorizacion", "orden_grupo")
    return df.join(order, "cod_cliente", "left").withColumn("priorizacion", filled).drop("orden_grupo")


def priority_index(inputs: Mapping[str, DataFrame], options: IndexOptions = IndexOptions()) -> DataFrame:
    """``(cod_cliente, prioridad, margen_porcentual)``: every customer of the window, ranked.

    ``margen_porcentual`` is the chain's. A customer with several chain listings,
    attribute rows or previous priorities has one row for each combination.
    """
    check_inputs(inputs)
    # The write of either frame also yields the figures that shape the later steps.
    nearest, farthest = F.min("distancia"), F.max("distancia")
    customers = inputs["customers"]
    single, listings = listings_of(customers, options)
    linked, per_customer = materialise_watching(
        linked_months(window_months(inputs, options), listings, options.hot_minimum), "linked",
        {"low": nearest, "high": farthest, "copies": F.max("attribute_rows")},
    )
    chains, per_chain = materialise_watching(
        chain_measures(linked), "chains",
        {"low": nearest, "high": farthest, "members": F.sum("members"), "largest": F.max("members")},
    )

    by_chain = scored(
        chains, options.chain_weights, "chain_score", {"distance": (per_chain["low"], per_chain["high"])}, options.digits
    ).select(CHAIN_KEY, "chain_score", "margen_porcentual")
    rows = scored(
        linked.filter("primera"), options.customer_weights, "customer_score",
        {"distance": (per_customer["low"], per_customer["high"])}, options.digits,
    )
    if not single:
        rows = rows.join(previous_priorities(customers), "cod_cliente", "left")
    rows = rows.select("cod_cliente", CHAIN_KEY, "attribute_rows", "customer_score", "priorizacion")
    if options.use_group_order:
        c.require_roles(inputs, ["priority_groups"])
        rows = fill_from_groups(rows, inputs["priority_groups"])
    rows = skew.repeat_rows(rows, "attribute_rows", per_customer["copies"], "copy")
    hot = skew.hot_keys(chains, "members", per_chain["members"], per_chain["largest"], options.hot_minimum)
    assembled = skew.join_to_groups(rows, by_chain, [CHAIN_KEY], hot)

    # A row without a customer code has no customer rank to sort by.
    customer_score = F.when(F.col("cod_cliente").isNotNull(), F.col("customer_score"))
    order = [
        F.col("priorizacion").asc_nulls_last(),
        F.col("chain_score").desc_nulls_last(),
        F.col(CHAIN_KEY).asc_nulls_first(),
        customer_score.desc_nulls_last(),
        F.col("cod_cliente").asc_nulls_first(),
        F.col("copy").asc(),
    ]
    ranked = ranking.global_row_number(assembled, order, "prioridad")
    return ranked.select("cod_cliente", "prioridad", "margen_porcentual")


def stamp(index: DataFrame, execution_id: str, time_zone: str = c.LOCAL_TIME_ZONE) -> DataFrame:
    """Add status, run and local time of creation."""
    return index.withColumns({
        "Estatus": F.lit("N"),
        "execution_id": F.lit(execution_id),
        "create_timestamp": F.from_utc_timestamp(F.current_timestamp(), time_zone),
    })


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table as ``(tabla, filas)``, counted in one job."""
    counts = [df.agg(F.count("*").alias("filas")).select(F.lit(role).alias("tabla"), "filas")
              for role, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
