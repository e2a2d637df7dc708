"""Paths that control rows name, as column expressions, and roots as the file system spells them."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..contracts import ContractError
from ..functions.text import strip

#: Schemes that both Hadoop's and Arrow's file systems know under the same name.
COPY_SCHEMES = ("", "file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss")


def cleaned(name: str) -> Column:
    """The stripped text of a field, NULL when nothing is left."""
    return F.when(strip(F.col(name)) != "", strip(F.col(name)))


def lacking(*names: str) -> Column:
    """``control row lacks a, b`` for the blank ones of the fields; NULL when all are there."""
    blank = F.concat_ws(", ", *[F.when(cleaned(name).isNull(), F.lit(name)) for name in names])
    return F.when(blank != "", F.concat(F.lit("control row lacks "), blank))


def below(root: str, *parts: Column) -> Column:
    """The parts below ``root``, without doubled or trailing slashes; NULL and blank parts are skipped."""
    inner = [F.regexp_replace(part, "^/+|/+$", "") for part in parts]
    return F.concat_ws("/", F.lit(root.rstrip("/")), *[F.when(part != "", part) for part in inner])


def suffix(extension: str) -> Column:
    """An extension with its dot, or nothing."""
    return F.coalesce(F.concat(F.lit("."), F.regexp_replace(cleaned(extension), "^[.]", "")), F.lit(""))


def target_below(root: str) -> Column:
    """Where a control row lands: its target folder, name and extension below ``root``."""
    leaf = F.concat(cleaned("nombre_archivo_destino"), suffix("extension_archivo_destino"))
    return below(root, cleaned("ruta_archivo_destino"), leaf)


def qualified(spark: SparkSession, root: str) -> str:
    """The root as the file system writes it, the way file listings start."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def check_scheme(*roots: str) -> None:
    """Fail on a root that the copying tasks cannot open."""
    for root in roots:
        scheme = urlsplit(root).scheme if ":" in root.split("/")[0] else ""
        if scheme not in COPY_SCHEMES:
            raise ContractError(f"files are copied from and to {', '.join(filter(None, COPY_SCHEMES))} only, not {scheme}")
