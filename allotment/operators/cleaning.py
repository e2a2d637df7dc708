"""Bring a raw frame to a column contract in one narrow stage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import require_columns
from ..functions.casts import to_contract_type
from ..functions.text import fold_accents, null_token_to_null, strip


def _map_strings(df: DataFrame, change) -> DataFrame:
    return df.select(*[
        change(F.col(f"`{field.name}`")).alias(field.name)
        if isinstance(field.dataType, T.StringType) else F.col(f"`{field.name}`")
        for field in df.schema.fields
    ])


def clean_null_tokens(df: DataFrame, any_case: bool = False) -> DataFrame:
    """Trim every string column and turn "no value" spellings into NULL."""
    trimmed = _map_strings(df, strip if any_case else F.trim)
    return _map_strings(trimmed, lambda text: null_token_to_null(text, any_case, trimmed=True))


def fold_accents_in_strings(df: DataFrame) -> DataFrame:
    """Fold accents in every string column."""
    return _map_strings(df, fold_accents)


def rename_columns(df: DataFrame, renames: Mapping[str, str], label: str = "frame") -> DataFrame:
    """Rename by map; every source must exist."""
    require_columns(df, renames, label)
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old != new})


def conform(
    df: DataFrame,
    casts: Mapping[str, str],
    execution_id: str,
    *,
    renames: Mapping[str, str] | None = None,
    any_case: bool = False,
    time_anchor: Column | None = None,
    label: str = "frame",
) -> DataFrame:
    """Rename, project to the contract, fold accents, clean NULL tokens and cast.

    No shuffle, and only the contract's columns are read. Folding, cleaning and
    casting are separate projections because each names its input several
    times: nested into one, every mention would be computed again.
    """
    if renames:
        df = rename_columns(df, renames, label)
    require_columns(df, casts, label)
    cleaned = clean_null_tokens(fold_accents_in_strings(df.select(*casts)), any_case)
    return cleaned.select(
        *[
            to_contract_type(F.col(name), cleaned.schema[name].dataType, target, time_anchor).alias(name)
            for name, target in casts.items()
        ],
        F.lit(execution_id).alias("execution_id"),
    )


def add_lineage(
    df: DataFrame,
    *,
    source_system: str,
    process_name: str,
    execution_id: str,
    source_object: str,
) -> DataFrame:
    """Add where, by which run and when the rows were read."""
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_system": F.lit(source_system),
        "process_name": F.lit(process_name),
        "execution_id": F.lit(execution_id),
        "source_object": F.lit(source_object),
    })
