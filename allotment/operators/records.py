"""Audit events and metric records as typed frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as c
from ..functions.text import strip


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def records(spark: SparkSession, rows: Iterable[Mapping[str, object]], schema: T.StructType) -> DataFrame:
    """A frame of records under an explicit schema; absent fields are NULL.

    With the schema given, a field that is NULL in every record keeps its type.
    """
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)


def audit_status(status: Column) -> Column:
    """The status in capitals; the job fails on an unknown one."""
    clean = F.upper(strip(status))
    wrong = F.raise_error(F.concat(F.lit("not an audit status: "), F.coalesce(status, F.lit("NULL"))))
    return F.when(clean.isin(c.AUDIT_STATUSES), clean).otherwise(wrong.cast("string"))


def normalise_audit(events: DataFrame) -> DataFrame:
    """The 12 audit columns: texts stripped, status checked, blank options NULL.

    Missing ids and timestamps are filled in.
    """
    present = set(events.columns)

    def text(name: str) -> Column:
        value = F.col(name).cast("string") if name in present else F.lit(None).cast("string")
        return F.coalesce(strip(value), F.lit(""))

    def optional(name: str) -> Column:
        return F.when(text(name) != "", text(name))

    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    special = {
        "event_id": F.coalesce(optional("event_id"), F.uuid()),
        "timestamp": F.coalesce(optional("timestamp"), now),
        "status": audit_status(text("status")),
    }
    required = {"ambiente", "process", "run_id", "name", "message"}
    return events.select(*[
        (special[name] if name in special else text(name) if name in required else optional(name)).alias(name)
        for name in c.AUDIT_SCHEMA.fieldNames()
    ])


def audit_event(spark: SparkSession, **fields: str | None) -> DataFrame:
    """One audit event as a frame."""
    event = {"event_id": str(uuid4()), "timestamp": utc_now(), **fields}
    status = (event.get("status") or "").strip().upper()
    if status not in c.AUDIT_STATUSES:
        raise c.ContractError(f"not an audit status: {event.get('status')!r}")
    return normalise_audit(records(spark, [event], c.AUDIT_SCHEMA))


def table_metric(**fields: object) -> dict[str, object]:
    return {"error_message": "", "rows_read": 0, "rows_written": 0, "metric_timestamp_utc": utc_now(), **fields}


def file_metric(**fields: object) -> dict[str, object]:
    return {"error_message": "", "bytes_read": 0, "rows_read": None, "metric_timestamp_utc": utc_now(), **fields}
