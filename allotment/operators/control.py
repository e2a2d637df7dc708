"""Load control: which objects a run extracts, in which order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as c
from ..functions.text import strip


class NothingToLoad(ValueError):
    """The control table holds no active row for the request."""


def standard_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The 13 standard columns, each from its first spelling present, else NULL.

    Only names change; values keep their source type. Absent columns get their
    contract type, so that a later filter can still be typed.
    """
    present = set(df.columns)

    def pick(name: str) -> Column:
        target, legacy = c.CONTROL_COLUMNS[name]
        source = next((candidate for candidate in [name, *legacy] if candidate in present), None)
        return (F.lit(None).cast(target) if source is None else F.col(source)).alias(name)

    return df.select(*[pick(name) for name in c.CONTROL_COLUMNS], *keep)


def truth(value: Column, source: T.DataType) -> Column:
    """Read a flag: NULL is true, a number is true unless 0, a text if it is a yes-word."""
    if isinstance(source, T.BooleanType):
        known = value
    elif isinstance(source, T.NumericType):
        known = value != 0
    else:
        known = F.lower(strip(value.cast("string"))).isin(c.TRUE_WORDS)
    return F.coalesce(known, F.lit(True))


def load_order(value: Column, source: T.DataType) -> Column:
    """Read the load order: NULL and blank are 0, any other non-integer is an error."""
    if not isinstance(source, T.StringType):
        return F.coalesce(value.cast("int"), F.lit(0))
    text = strip(value)
    number = text.try_cast("int")
    unreadable = F.raise_error(F.concat(F.lit("load order is not a whole number: "), text)).cast("int")
    return (
        F.when(value.isNull() | (text == ""), F.lit(0))
        .when(number.isNotNull(), number)
        .otherwise(unreadable)
    )


def normalise_control(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Standard columns with clean values: texts stripped, flag and order typed.

    Columns in ``keep`` stay as they are.
    """
    standard = standard_columns(df, keep)
    types = {field.name: field.dataType for field in standard.schema.fields}

    def clean(name: str) -> Column:
        value, source = F.col(name), types[name]
        if name == "activo":
            return truth(value, source).alias(name)
        if name == "orden_ejecucion":
            return load_order(value, source).alias(name)
        text = strip(value.cast("string"))
        if name in ("tipo_carga", "filtros_archivo_fuente"):
            text = F.coalesce(text, F.lit(""))
        return text.alias(name)

    return standard.select(*[clean(name) for name in c.CONTROL_COLUMNS], *keep)


def check_choice(value: str | None, allowed: Iterable[str], label: str) -> str | None:
    """The stripped value if it is one of ``allowed``; None for blank."""
    clean = (value or "").strip()
    if clean and clean not in allowed:
        raise c.ContractError(f"{label} must be one of {', '.join(allowed)}, not {value!r}")
    return clean or None


def active_loads(
    control: DataFrame,
    owner: str | None = None,
    owners: Iterable[str] = tuple(c.SOURCE_OWNERS),
    must_exist: bool = True,
) -> DataFrame:
    """Active rows of a normalised control frame, optionally of one owner, in load order."""
    owner = check_choice(owner, owners, "owner")
    active = control.filter("activo")
    if owner:
        active = active.filter(F.col("propietario_fuente") == owner)
    if must_exist and active.isEmpty():
        raise NothingToLoad("no active control row" + (f" of owner {owner}" if owner else ""))
    return active.orderBy(F.col("orden_ejecucion").asc(), F.col("nombre_archivo_fuente").asc())


def valid_loads(
    control: DataFrame,
    process: str,
    system: str,
    owner: str | None = None,
    start: int = 0,
    end: int = 0,
    *,
    systems: Iterable[str] = tuple(c.SOURCE_SYSTEMS),
    owners: Iterable[str] = tuple(c.SOURCE_OWNERS),
) -> DataFrame:
    """Active rows of one process and system whose validity meets [start, end].

    Dates are yyyymmdd integers; 0 leaves that side open.
    """
    process = (process or "").strip()
    system = check_choice(system, systems, "system")
    owner = check_choice(owner, owners, "owner")
    if not process or not system:
        raise c.ContractError("process and system are required")
    rows = control.filter(
        (F.col("proceso") == process)
        & (F.col("sistema_fuente") == system)
        & F.col("activo")
        & (F.col("valid_from") <= (int(start or 0) or c.OPEN_END_DATE))
        & (F.col("valid_to") >= int(end or 0))
    )
    if owner:
        rows = rows.filter(F.col("propietario_fuente") == owner)
    return rows.select(*c.CONTROL_COLUMNS).orderBy("orden_ejecucion")


def control_view(loads: DataFrame, processes: DataFrame, systems: DataFrame, owners: DataFrame) -> DataFrame:
    """Loads with the names of their process, system and owner, all three active.

    The dimensions are small next to the loads in practice, but nothing bounds
    them, so the planner picks the join by their real size.
    """
    def active(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.filter("activo").select(key, name)

    joined = (
        loads.join(active(processes, "proceso_id", "proceso"), "proceso_id")
        .join(active(systems, "sistema_fuente_id", "sistema_fuente"), "sistema_fuente_id")
        .join(active(owners, "propietario_fuente_id", "propietario_fuente"), "propietario_fuente_id")
    )
    return joined.select(*c.CONTROL_COLUMNS, "valid_from", "valid_to")


def legacy_names(view: DataFrame) -> DataFrame:
    """The control view under the legacy column names."""
    renames = {name: legacy[0] for name, (_, legacy) in c.CONTROL_COLUMNS.items()}
    renames |= {"valid_from": "AnioMesDiaInicial", "valid_to": "AnioMesDiaFinal"}
    return view.select(*[F.col(name).alias(new) for name, new in renames.items()])


def dimension_references(
    processes: DataFrame,
    systems: DataFrame,
    owners: DataFrame,
    combinations: DataFrame,
) -> DataFrame:
    """Ids of the (process, system, owner) combinations a control table may refer to.

    The combinations are given by name and looked up with equi-joins, so the
    product of the three dimensions is never formed.
    """
    return (
        combinations.select("proceso", "sistema_fuente", "propietario_fuente")
        .join(processes.select("proceso_id", "proceso"), "proceso")
        .join(systems.select("sistema_fuente_id", "sistema_fuente"), "sistema_fuente")
        .join(owners.select("propietario_fuente_id", "propietario_fuente"), "propietario_fuente")
    )


def seed_loads(references: DataFrame, seeds: Iterable[Mapping[str, object]]) -> DataFrame:
    """Control rows as the union of one projection per seed.

    A seed names its system and owner and gives the load's constant columns.
    """
    keys = ["proceso_id", "sistema_fuente_id", "propietario_fuente_id"]
    result = None
    for seed in seeds:
        constants = {k: v for k, v in seed.items() if k not in ("sistema_fuente", "propietario_fuente")}
        rows = references.filter(
            (F.col("sistema_fuente") == seed["sistema_fuente"])
            & (F.col("propietario_fuente") == seed["propietario_fuente"])
        ).select(*keys, *[F.lit(value).alias(name) for name, value in constants.items()])
        result = rows if result is None else result.unionByName(rows)
    return result


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Iterable[str] = tuple(c.CONTROL_KEY),
    updated: Iterable[str] = tuple(c.CONTROL_UPDATED),
    now: dt.datetime | Column | None = None,
) -> DataFrame:
    """A new snapshot of ``target``: matched rows take the incoming values, others are added.

    Of a matched row only ``updated`` and ``updated_at`` change; a new row gets
    ``created_at`` and ``updated_at``. Keys must be unique on either side, as
    the target's constraint demands; the job fails on an incoming duplicate.
    """
    keys, updated = list(keys), set(updated)
    stamp = F.current_timestamp() if now is None else F.lit(now)
    twice = F.raise_error(F.lit("incoming rows hold the same key twice")).cast("bigint")
    first = [F.first(name).alias(name) for name in incoming.columns if name not in keys]
    unique = (
        incoming.groupBy(*keys)
        .agg(*first, F.count("*").alias("_n"))
        .withColumn("_n", F.when(F.col("_n") == 1, F.col("_n")).otherwise(twice))
    )
    old, new = target.alias("t"), unique.alias("s")
    same = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    arrives = F.col("s._n").isNotNull()
    exists = F.col("t._old").isNotNull()

    def column(field: T.StructField) -> Column:
        name = field.name
        before = F.col(f"t.{name}")
        after = F.col(f"s.{name}") if name in incoming.columns else F.lit(None)
        if name in keys:
            value = F.coalesce(before, after)
        elif name == "created_at":
            value = F.when(exists, before).otherwise(stamp)
        elif name == "updated_at":
            value = F.when(arrives, stamp).otherwise(before)
        elif name in updated:
            value = F.when(arrives, after).otherwise(before)
        else:
            value = F.when(exists, before).otherwise(after)
        return value.cast(field.dataType).alias(name)

    joined = old.withColumn("_old", F.lit(True)).alias("t").join(new, same, "full_outer")
    return joined.select(*[column(field) for field in target.schema.fields])
