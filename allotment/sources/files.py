"""Inventory of landed files.

Nothing is read through the driver: sizes come from the file listing and rows
are counted by the tasks that read the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FILE_METRIC_SCHEMA, FILE_METRICS_VIEW, ContractError
from ..runtime import materialise, materialise_watching
from .paths import below, check_scheme, cleaned, lacking, qualified, target_below
from .tables import publish_view

if TYPE_CHECKING:
    import pandas as pd

COPY_BYTES = 8 << 20

# Java regular expressions. Line ends that str.splitlines() honours and Spark's
# text reader does not:
OTHER_LINE_ENDS = r"[\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"
# Anything str.strip() would leave standing:
SOME_TEXT = (
    r"[^\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
)
BYTE_ORDER_MARK = r"^\uFEFF"


def file_type(name: Column) -> Column:
    """excel, csv or binary, by extension."""
    lower = F.lower(name)
    return (
        F.when(lower.endswith(".xlsx") | lower.endswith(".xls"), "excel")
        .when(lower.endswith(".csv"), "csv")
        .otherwise("binary")
    )


def csv_rows(spark: SparkSession, path: str | list[str], only: str | None = "*.[cC][sS][vV]") -> DataFrame:
    """Per CSV file ``(uri, rows_read)``: lines that hold text, less the header.

    Counted before the shuffle, so one very large file is counted by all the
    tasks that read a part of it.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("uri"), F.col("value"))
    pieces = F.split(F.regexp_replace("value", BYTE_ORDER_MARK, ""), OTHER_LINE_ENDS)
    filled = F.size(F.filter(pieces, lambda piece: piece.rlike(SOME_TEXT)))
    return (
        lines.groupBy("uri")
        .agg(F.sum(filled).alias("_filled"))
        .select("uri", F.greatest(F.col("_filled") - 1, F.lit(0)).cast("bigint").alias("rows_read"))
    )


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``(archivo_origen, bytes_read, modified)`` of every file below ``path``, empty ones included; ``modified`` in ns.

    The tree is walked level by level. The folders of a level are a table, dealt over the
    tasks, which list them with Arrow's file systems; their sub-folders are the next level's table.
    Only the root (or what a pattern with ``*`` names) and the number of folders of each level
    are on the driver. As in Spark's own scans, names that start with ``.`` or ``_`` (and
    hold no ``=``) are left out. A path that does not exist is an error.
    """
    check_scheme(path)
    width = 4 * spark.sparkContext.defaultParallelism
    found = _roots(spark, path)
    roots = spark.createDataFrame([(root,) for root in found], "archivo_origen string")
    frontier, folders, levels = roots, len(found), []
    while folders:
        inner = frontier.repartition(min(folders, width)).mapInPandas(_children(), "archivo_origen string, bytes_read bigint, modified bigint, folder boolean")
        level, told = materialise_watching(inner, "listing", {"folders": F.count_if("folder")})
        levels.append(level)
        frontier, folders = level.filter("folder").select("archivo_origen"), told["folders"]
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole.filter("NOT folder").drop("folder")


def _roots(spark: SparkSession, path: str) -> list[str]:
    """The path, or those that match a pattern, as their file system writes them."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [given] if store.exists(given) else [status.getPath() for status in store.globStatus(given) or []]
    if not found:
        raise ContractError(f"no such path: {path}")
    return [store.makeQualified(one).toString().rstrip("/") for one in found]


def _children():
    # Everything the tasks run is defined in here: they need Arrow, but not this package.
    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import quote

        import pandas as pd
        from pyarrow import fs

        def shown(name: str) -> bool:
            return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))

        for batch in batches:
            for folder in batch["archivo_origen"]:
                path = f"file://{folder[len('file:'):]}" if folder.startswith("file:/") and not folder.startswith("file://") else folder
                store, inside = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                one = store.get_file_info(inside)
                if one.type == fs.FileType.File:
                    yield pd.DataFrame({"archivo_origen": [folder], "bytes_read": [one.size], "modified": [one.mtime_ns or 0], "folder": [False]})
                    continue
                inner = [i for i in store.get_file_info(fs.FileSelector(inside)) if shown(i.base_name)]
                yield pd.DataFrame({
                    "archivo_origen": pd.Series([f"{folder}/{i.base_name}" for i in inner], dtype=object),
                    "bytes_read": pd.Series([i.size or 0 for i in inner], dtype="int64"),
                    "modified": pd.Series([i.mtime_ns or 0 for i in inner], dtype="int64"),
                    "folder": pd.Series([i.type == fs.FileType.Directory for i in inner], dtype=bool),
                })

    return children


def inventory(spark: SparkSession, path: str, expected: DataFrame | None = None) -> DataFrame:
    """``(archivo_origen, tipo, bytes_read, rows_read)`` of the files below ``path``.

    ``rows_read`` is NULL for files that are not CSV. ``expected`` (column
    ``archivo_origen``) adds files that should be there, with 0 bytes and rows.
    """
    found = listing(spark, path)
    if expected is not None:
        found = (
            expected.select("archivo_origen").distinct()
            .join(found, "archivo_origen", "full_outer")
            .withColumn("bytes_read", F.coalesce("bytes_read", F.lit(0)))
        )
    kind = file_type(F.col("archivo_origen"))
    # Scans tell percent-encoded paths; a plus sign stands for itself there.
    plain = F.try_url_decode(F.replace(F.col("uri"), F.lit("+"), F.lit("%2B"))).alias("archivo_origen")
    rows = csv_rows(spark, path).select(F.regexp_replace(plain, "^file:/+", "file:/").alias("archivo_origen"), "rows_read")
    return found.join(rows, "archivo_origen", "left").select(
        "archivo_origen",
        kind.alias("tipo"),
        F.col("bytes_read").cast("bigint").alias("bytes_read"),
        F.when(kind == "csv", F.coalesce("rows_read", F.lit(0))).alias("rows_read"),
    )


def copy_files(pairs: DataFrame) -> DataFrame:
    """Copy ``archivo_origen`` to ``archivo_destino`` of every row, unchanged; one metric row each.

    The tasks stream the bytes in pieces, so a file may be larger than a task's
    memory. A file appears under its final name only when it is complete, so a
    repeated task does no harm. A file that cannot be copied gets status
    ``failed`` and its error. Of files whose ``tipo`` is csv the lines that hold text,
    less the header, are counted on the way (``rows_read``, else NULL). Evaluate the
    result once (``materialise`` it): every evaluation copies.
    """
    piece = COPY_BYTES

    # Everything the tasks run is defined in here: they need Arrow, but not this package.
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import codecs
        from urllib.parse import quote
        from uuid import uuid4

        import pandas as pd
        from pyarrow import fs

        def locate(path: str):
            """File system and inner path; Hadoop's ``file:/x`` is Arrow's ``file:///x``."""
            if path.startswith("/"):
                path = f"file:{path}"
            if path.startswith("file:/") and not path.startswith("file://"):
                path = f"file://{path[len('file:'):]}"
            return fs.FileSystem.from_uri(quote(path, safe=":/@"))

        class Lines:
            """Counts lines with text in a stream of bytes; holds no line."""

            def __init__(self):
                self.decoder, self.filled, self.open, self.started = codecs.getincrementaldecoder("utf-8")("replace"), 0, False, False

            def feed(self, data: bytes, final: bool = False) -> None:
                text = self.decoder.decode(data, final)
                if text and not self.started:
                    text, self.started = text.removeprefix("\ufeff"), True
                for line in text.splitlines(keepends=True):
                    self.open = self.open or bool(line.strip())
                    if line[-1:].splitlines() == [""]:  # a line end
                        self.filled, self.open = self.filled + self.open, False
                if final:
                    self.filled += self.open

        def copy_one(source: str, target: str, count: bool) -> tuple[int, int | None]:
            origin, inside = locate(source)
            store, final = locate(target)
            partial = f"{final}.{uuid4().hex}.partial"
            store.create_dir(final.rpartition("/")[0], recursive=True)
            lines = Lines()
            with origin.open_input_stream(inside) as read, store.open_output_stream(partial) as out:
                while data := read.read(piece):
                    out.write(data)
                    if count:
                        lines.feed(data)
                size = out.tell()
            lines.feed(b"", True)
            store.move(partial, final)
            return size, max(lines.filled - 1, 0) if count else None

        for batch in batches:
            sizes, rows, errors = [], [], []
            for source, target, kind in zip(batch["archivo_origen"], batch["archivo_destino"], batch["tipo"]):
                try:
                    size, count = copy_one(source, target, kind == "csv")
                    error = ""
                except Exception as failure:  # recorded per file
                    size, count, error = 0, None, str(failure) or type(failure).__name__
                sizes.append(size)
                rows.append(count)
                errors.append(error)
            yield batch.assign(
                bytes_read=sizes, rows_read=pd.array(rows, dtype="Int64"),
                status=["failed" if e else "success" for e in errors], error_message=errors,
            )[names]

    schema = "archivo_origen string, archivo_destino string, bytes_read bigint, rows_read bigint, status string, error_message string"
    names = [part.split()[0] for part in schema.split(", ")]
    kind = F.col("tipo") if "tipo" in pairs.columns else F.lit("binary").alias("tipo")
    return pairs.select("archivo_origen", "archivo_destino", kind).mapInPandas(copy, schema)


def land(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy every file below ``source`` to the same place below ``target``."""
    check_scheme(source, target)
    root = f"{qualified(spark, source)}/"
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), F.col("archivo_origen"))).cast("string")
    name = F.when(F.startswith("archivo_origen", F.lit(root)), F.substr("archivo_origen", F.lit(len(root) + 1))).otherwise(outside)
    pairs = listing(spark, source).select("archivo_origen", below(target, name).alias("archivo_destino"))
    return copy_files(pairs)


def land_controlled(
    spark: SparkSession, control: DataFrame, source_root: str, target_root: str
) -> DataFrame:
    """Land the files a normalised control frame lists; one metric row per file.

    A row names the source file (path and name below ``source_root``) and the
    target (path, name and extension below ``target_root``). Rows are counted
    in CSV files only, while their bytes pass. A row that lacks a name fails with
    that field's name and copies nothing. Files that fail do not stop the others;
    the caller decides whether to raise.
    """
    check_scheme(source_root, target_root)
    pairs = control.select(
        below(source_root, F.col("ruta_archivo_fuente"), cleaned("nombre_archivo_fuente")).alias("archivo_origen"),
        target_below(target_root).alias("archivo_destino"),
        file_type(F.coalesce(cleaned("extension_archivo_destino"), F.col("nombre_archivo_fuente"))).alias("tipo"),
        lacking("nombre_archivo_fuente", "nombre_archivo_destino").alias("error_message"),
    )
    # Spread the files: the control rows may all sit in one partition.
    complete = pairs.filter("error_message IS NULL").drop("error_message").distinct()
    copied = copy_files(complete.repartition("archivo_origen", "archivo_destino"))
    refused = pairs.filter("error_message IS NOT NULL").select(
        "archivo_origen", "archivo_destino", F.lit(0).cast("bigint").alias("bytes_read"), F.lit(None).cast("bigint").alias("rows_read"),
        F.lit("failed").alias("status"), "error_message",
    )
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    metrics = copied.unionByName(refused).withColumn("metric_timestamp_utc", now).select(*FILE_METRIC_SCHEMA.names)
    return publish_view(materialise(metrics, "landing"), FILE_METRICS_VIEW)
