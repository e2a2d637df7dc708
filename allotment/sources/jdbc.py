"""Database reads and writes over JDBC.

The URL and the driver class are arguments; credentials are passed as options
and never appear in a message.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from .. import contracts as c

WRITE_BATCH = 10_000
WRITE_MODES = {"append": ("append", False), "overwrite": ("overwrite", False), "truncate_insert": ("overwrite", True)}


@dataclass(frozen=True)
class Connection:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}


@dataclass(frozen=True)
class Split:
    """A numeric, date or timestamp column to read in parallel ranges.

    Rows outside the bounds are still read: they go to the first or last range.
    """

    column: str
    lower: object
    upper: object
    partitions: int


def read_options(
    connection: Connection,
    *,
    query: str | None = None,
    table: str | None = None,
    split: Split | None = None,
    fetch_size: int = WRITE_BATCH,
) -> dict[str, str]:
    """Reader options. A query is read over one connection unless ``split`` is given.

    Spark does not split its ``query`` option, so a split query is passed as a
    derived table.
    """
    if bool(query) == bool(table):
        raise c.ContractError("give either a query or a table")
    options = connection.options() | {"fetchsize": str(fetch_size)}
    if split is None:
        return options | ({"query": query} if query else {"dbtable": table})
    return options | {
        "dbtable": table or f"({query}) q",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.partitions),
    }


def read_jdbc(spark: SparkSession, connection: Connection, **source) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, **source)).load()


def write_mode(mode: str) -> tuple[str, bool]:
    """(Spark save mode, keep the target's structure) of a publication mode."""
    clean = (mode or "").strip().lower()
    if clean not in WRITE_MODES:
        raise c.ContractError(f"mode must be one of {', '.join(sorted(WRITE_MODES))}, not {mode!r}")
    return WRITE_MODES[clean]


def write_options(connection: Connection, target: str, mode: str) -> dict[str, str]:
    _, truncate = write_mode(mode)
    options = connection.options() | {"dbtable": target, "batchsize": str(WRITE_BATCH)}
    return options | ({"truncate": "true"} if truncate else {})


def write_jdbc(df: DataFrame, connection: Connection, target: str, mode: str, connections: int | None = None) -> None:
    """Write to a table; ``connections`` bounds how many tasks write at a time."""
    options = write_options(connection, target, mode)
    if connections:
        options["numPartitions"] = str(connections)
    writer: DataFrameWriter = df.write.format("jdbc").mode(write_mode(mode)[0])
    writer.options(**options).save()
