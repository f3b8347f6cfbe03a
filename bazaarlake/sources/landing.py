"""The landing zone: find files, fingerprint their bytes, read their rows and move copies on.

File bytes are read inside tasks by Arrow's file systems (local, ``s3``, ``gs``, ``hdfs``, as the installed Arrow knows them). A root
that only Hadoop's clients can open is read by Spark's own readers instead; there the driver lists the zone and copies files, in a
stream, through its Hadoop client.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import files
from ..session import materialize

_ANY_LENGTH = 1 << 30
_BOM = "\ufeff"

#: A header that doesn't end within so many bytes is refused, so that no task holds a file without line breaks.
MAX_HEADER_BYTES = 1 << 20
#: Columns of one file; with the lineage they stay within what a table may have.
MAX_COLUMNS = 9_990
# Widths at which headers are split; a header takes the first that is wide enough.
_HEADER_WIDTHS = (64, 1_024, MAX_COLUMNS + 1)


@dataclass(frozen=True)
class UploadRequest:
    """One file to process; the path is relative to the landing root."""

    source_system: str
    table_name: str
    tmp_file_path: str
    batch_id: str


REQUEST_SCHEMA = T.StructType(
    [T.StructField("seq", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("source_system", "table_name", "tmp_file_path", "batch_id")]
)

PRINT_COLUMNS = (
    "file_hash string, header_line string, header_error string, has_rows boolean, multi_line boolean, "
    "content_error string, read_error string, read_error_type string"
)


def _plain(path: str) -> str:
    """Path without scheme and host."""
    return urlparse(path).path if "://" in path or path.startswith("file:") else path


def relative(path: Column, root: str) -> Column:
    """The part of a full path below the landing root."""
    base = _plain(root).rstrip("/") + "/"
    return F.substring(path, F.instr(path, base) + len(base), F.lit(_ANY_LENGTH))


def _locator():
    """The function that finds file system and path of a URI; made here, so that it travels to executors without this package."""

    def locate(uri: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(uri.removeprefix("file://").removeprefix("file:"))

    return locate


def _literal(path: str) -> str:
    """A path without the meaning that Spark's readers give to ``*``, ``[`` and the like."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def opened_by_arrow(root: str) -> bool:
    """Whether tasks can open the files themselves; else only Spark's readers can."""
    try:
        store, path = _locator()(root)
        store.get_file_info(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


# --- which files there are ------------------------------------------------------------------------


def landed_files(spark: SparkSession, root: str, zone: str = "tmp") -> DataFrame:
    """``(tmp_file_path, size_bytes)`` of all files of a zone, the empty ones too, as a written table.

    Folders are listed level by level, each in a task of its own; no path reaches the driver. Names that begin with ``_`` or ``.`` are marks
    and checksums of writers, which Spark's readers leave out too.
    """
    if not opened_by_arrow(root):
        return _listed_by_spark(spark, root, zone)
    locate = _locator()

    def children(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for parent in batch.column(0).to_pylist():
                store, place = locate(f"{root}/{parent}")
                found = store.get_file_info(fs.FileSelector(place, allow_not_found=True))
                found = [f for f in found if not f.base_name.startswith(("_", "."))]
                names = [f"{parent}/{f.base_name}" for f in found]
                folder = [f.type == fs.FileType.Directory for f in found]
                sizes = [f.size for f in found]
                cells = [pa.array(names, pa.string()), pa.array(folder, pa.bool_()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(cells, ["tmp_file_path", "folder", "size_bytes"])

    cores = spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([(zone,)], "tmp_file_path string")
    found = []
    while True:
        listed = level.repartition(cores, "tmp_file_path").mapInArrow(children, "tmp_file_path string, folder boolean, size_bytes long")
        listed = materialize(listed, "listed")
        found.append(listed.where("not folder").select("tmp_file_path", "size_bytes"))
        level = listed.where("folder").select("tmp_file_path")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _listed_by_spark(spark: SparkSession, root: str, zone: str) -> DataFrame:
    """The same by Spark's listing, which the driver holds; the scan behind it leaves out files without bytes."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{zone}")
    empty = spark.createDataFrame([], "tmp_file_path string, size_bytes long")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return empty
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{zone}")
    base = _plain(root).rstrip("/") + "/"
    paths = [(unquote(_plain(p)).split(base, 1)[-1],) for p in scan.inputFiles()]
    if not paths:
        return empty
    sizes = scan.select(relative(F.col("path"), root).alias("tmp_file_path"), F.col("length").alias("size_bytes"))
    named = spark.createDataFrame(paths, "tmp_file_path string").join(sizes, "tmp_file_path", "left")
    return named.select("tmp_file_path", F.coalesce("size_bytes", F.lit(0).cast("long")).alias("size_bytes"))


def describe(paths: DataFrame) -> DataFrame:
    """Requests from the ``source=/table=/upload_id=`` folders of landed paths."""
    path = F.col("tmp_file_path")

    def part(name: str) -> Column:
        return F.coalesce(files.path_value(path, name), F.lit("")).alias(name)

    rest = [c for c in paths.columns if c != "tmp_file_path"]
    return paths.select(
        part("source").alias("source_system"),
        part("table").alias("table_name"),
        path,
        part("upload_id").alias("batch_id"),
        files.file_name(path).alias("source_file_name"),
        *rest,
    )


def collect_requests(described: DataFrame) -> list[UploadRequest]:
    """Requests in path order, of a bounded set of files."""
    rows = described.select("source_system", "table_name", "tmp_file_path", "batch_id").orderBy("tmp_file_path")
    return [UploadRequest(*row) for row in rows.collect()]


def requests_frame(spark: SparkSession, requests: Iterable[UploadRequest]) -> DataFrame:
    rows = [(i, r.source_system, r.table_name, r.tmp_file_path, r.batch_id) for i, r in enumerate(requests)]
    return spark.createDataFrame(rows, REQUEST_SCHEMA)


# --- what the files are ---------------------------------------------------------------------------


def _scanner(limit: int):
    """The function that reads one file in a stream; made here, so that it travels to executors without this package."""
    # Blank lines first, then cells with or without quotes up to the line break.
    pattern = rb'(?:\xef\xbb\xbf)?(?:[ \t]*+(?:\r\n|\n|\r))*+((?:"[^"]*+"|[^"\r\n]++)*+)(\r\n|\n|\r|\Z)'

    def scan(pieces) -> dict:
        import codecs
        import hashlib

        import numpy as np

        record = re.compile(pattern)
        edge = np.zeros(256, bool)
        edge[list(b',\n\r"')] = True
        digest, decoder = hashlib.sha256(), codecs.getincrementaldecoder("utf-8")()
        out = {"header_line": None, "header_error": None, "has_rows": False, "multi_line": False, "content_error": None}
        head, seen, inside, last, after_cr = b"", 0, 0, ord(","), False

        def close_header(whole: bool) -> bytes | None:
            """Keep the header once its end is in ``head``; the bytes after it."""
            found = record.match(head)
            ended = found and (found[2] and (found.end() < len(head) or found[2] != b"\r") or whole and found.end() == len(head))
            if ended:
                out["header_line"] = found[1].decode("utf-8", "replace")
                return head[found.end() :]
            if whole or len(head) > limit:
                out["header_line"], out["header_error"] = "", f"Header line does not end within {limit} bytes"
                return b""
            return None

        for piece in pieces:
            digest.update(piece)
            if out["content_error"] is None:
                try:
                    decoder.decode(piece)
                except UnicodeDecodeError as e:
                    out["content_error"] = f"'utf-8' codec can't decode byte {e.object[e.start]:#04x}: {e.reason}"
            if out["header_line"] is None:
                head += piece
                rest = close_header(False)
                if rest is not None:
                    out["has_rows"], head = bool(rest.strip()), b""
            elif not out["has_rows"]:
                out["has_rows"] = bool(piece.strip())
            if not out["multi_line"] and (b'"' in piece or b"\r" in piece or inside or after_cr):
                # A line break inside quotes, a quote inside a cell, or a line that a lone CR ends: such files are read whole.
                b = np.frombuffer(piece, np.uint8)
                quotes, nxt = b == 34, np.append(b[1:], 0)
                state = (inside + np.cumsum(quotes)) & 1
                breaks = (b == 10) | (b == 13)
                lone_cr = (b[:-1] == 13) & (b[1:] != 10)
                stray = quotes & ~edge[np.append(last, b[:-1])] & ~edge[nxt]
                out["multi_line"] = bool(state[breaks].any() or lone_cr.any() or stray.any() or after_cr and b[0] != 10)
                inside = int(state[-1])
            last, after_cr = piece[-1], piece[-1] == 13
            seen += len(piece)
        if out["content_error"] is None:
            try:
                decoder.decode(b"", True)
            except UnicodeDecodeError as e:
                out["content_error"] = f"'utf-8' codec can't decode byte {e.object[e.start]:#04x}: {e.reason}"
        if out["header_line"] is None:
            rest = close_header(True)
            out["has_rows"] = bool(rest and rest.strip())
        out["multi_line"] = bool(out["multi_line"] or after_cr)
        return out | {"file_hash": digest.hexdigest(), "size_bytes": seen}

    return scan


def fingerprints(spark: SparkSession, root: str, paths: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """What is known of each file of ``paths`` before its rows are read: ``(tmp_file_path, exists, size_bytes, ...)``.

    Files are read in a stream inside a task, which holds a piece and the header, never the file. With a limit, files over it are not
    read. A file that can't be read has its error in ``read_error``; the others are not touched by it.
    """
    schema = f"tmp_file_path string, exists boolean, size_bytes long, {PRINT_COLUMNS}"
    if not opened_by_arrow(root):
        return _printed_by_spark(spark, root, paths, max_bytes, schema)
    locate, scan, limit = _locator(), _scanner(MAX_HEADER_BYTES), max_bytes
    names = [f.split()[0] for f in schema.split(", ")]

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        kinds = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}
        types = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

        def pieces(reader):
            while piece := reader.read(1 << 20):
                yield piece

        for batch in batches:
            for path in batch.column(0).to_pylist():
                row = dict.fromkeys(names) | {"tmp_file_path": path, "exists": True}
                try:
                    store, place = locate(f"{root}/{path}")
                    info = store.get_file_info(place)
                    row |= {"exists": info.type == fs.FileType.File, "size_bytes": info.size}
                    if row["exists"] and info.size and (limit is None or info.size <= limit):
                        with store.open_input_stream(place, compression=None) as reader:
                            row |= scan(pieces(reader))
                except Exception as error:  # of this file alone; it becomes the file's verdict
                    row |= {"read_error": str(error), "read_error_type": type(error).__name__}
                yield pa.RecordBatch.from_pylist([row], types)

    cores = spark.sparkContext.defaultParallelism
    return paths.select("tmp_file_path").repartition(cores, "tmp_file_path").mapInArrow(read, schema)


def _printed_by_spark(spark: SparkSession, root: str, paths: DataFrame, max_bytes: int | None, schema: str) -> DataFrame:
    """The same by Spark's reader of whole files; any file with quotes or carriage returns counts as one with quoted line breaks."""
    landed = paths.join(landed_files(spark, root).withColumn("exists", F.lit(True)), "tmp_file_path", "left").select(
        "tmp_file_path", F.coalesce("exists", F.lit(False)).alias("exists"), "size_bytes"
    )
    landed = materialize(landed, "landed")
    wanted = F.col("size_bytes") > 0 if max_bytes is None else F.col("size_bytes").between(1, max_bytes)
    # Paths of the files of one batch.
    readable = [r.tmp_file_path for r in landed.where(wanted).select("tmp_file_path").collect()]
    if not readable:
        return landed.select("*", *[F.lit(None).cast(k).alias(n) for n, k in (f.split() for f in PRINT_COLUMNS.split(", "))])
    content = F.col("content").cast("string")
    # Blank lines first, then cells with or without quotes up to the line break.
    record = f'^{_BOM}?(?:[ \\t]*+(?:\\r\\n|\\n|\\r))*+((?:"[^"]*+"|[^"\\r\\n]++)*+)'
    text = F.make_valid_utf8(content)
    whole = spark.read.format("binaryFile").load([_literal(f"{root}/{p}") for p in readable])
    whole = whole.select(
        relative(F.col("path"), root).alias("tmp_file_path"),
        F.sha2("content", 256).alias("file_hash"),
        text.alias("text"),
        F.when(~F.is_valid_utf8(content), F.lit("'utf-8' codec can't decode the file")).alias("content_error"),
    )
    rest = F.substring(F.col("text"), F.length(F.regexp_extract("text", record, 0)) + 1, F.lit(_ANY_LENGTH))
    line = F.regexp_extract("text", record, 1)
    long = F.length(line) > MAX_HEADER_BYTES
    prints = whole.select(
        "tmp_file_path",
        "file_hash",
        F.when(long, F.lit("")).otherwise(line).alias("header_line"),
        F.when(long, F.lit(f"Header line does not end within {MAX_HEADER_BYTES} bytes")).alias("header_error"),
        rest.rlike(r"\S").alias("has_rows"),
        F.col("text").rlike('["\r]').alias("multi_line"),
        "content_error",
    )
    none = F.lit(None).cast("string")
    return landed.join(prints, "tmp_file_path", "left").select(
        "*", none.alias("read_error"), none.alias("read_error_type")
    )


def headers(lines: DataFrame) -> DataFrame:
    """``(header_line, header)`` of distinct header lines: their cells by the rules of Spark's CSV parser, NULL if there are too many.

    Commas bound the cells, so lines are parsed at the first of a few widths that holds them.
    """
    commas = F.length("header_line") - F.length(F.replace("header_line", F.lit(","), F.lit("")))
    placed = lines.select("header_line").distinct().withColumn("at_most", commas + 1)
    largest = placed.agg(F.collect_set(_width(F.col("at_most"))).alias("w")).first()["w"]
    parts = []
    for width in _HEADER_WIDTHS:
        if width in largest:
            cells = F.from_csv("header_line", ", ".join(f"c{i} string" for i in range(width)), {"escape": '"', "maxColumns": str(width + 1)})
            wanted = placed.where(_width(F.col("at_most")) == width).select("header_line", "at_most", cells.alias("cells"))
            row = F.array(*[F.col(f"cells.c{i}") for i in range(width)])
            parts.append(wanted.select("header_line", _without_tail(row, F.col("header_line")).alias("header")))
    wide = placed.where(_width(F.col("at_most")).isNull()).select("header_line", F.lit(None).cast("array<string>").alias("header"))
    return reduce(DataFrame.unionByName, [*parts, wide])


def _width(at_most: Column) -> Column:
    return F.coalesce(*[F.when(at_most <= w, F.lit(w)) for w in _HEADER_WIDTHS])


def _without_tail(row: Column, line: Column) -> Column:
    """The cells up to the last one that is named; a header that ends in commas has unnamed columns there."""
    last = F.size(row) - F.coalesce(F.array_position(F.transform(F.reverse(row), lambda c: c.isNotNull()), True), F.size(row) + 1) + 1
    trailing = F.length(line) - F.length(F.rtrim(line, F.lit(",")))
    return F.slice(row, 1, (last + trailing).cast("int"))


# --- their rows -----------------------------------------------------------------------------------


def read_rows(spark: SparkSession, root: str, paths: list[str], names: list[str | None], multi_line: bool) -> DataFrame:
    """Rows of files of one header layout: its named columns as text, ``__file`` and ``__wide``.

    ``names`` has the column each cell goes to, None for cells that go nowhere. ``__wide`` marks rows with more cells than the header.
    Files whose lines are rows are split, so that several tasks share a large one.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    rows = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("multiLine", str(multi_line).lower())
        .option("escape", '"')
        .csv([_literal(f"{root}/{p}") for p in paths])
    )
    # This path is percent-encoded; a plus sign in it stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    wanted = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n is not None]
    wide = F.col(f"c{len(names)}").isNotNull()
    return rows.select(*wanted, relative(path, root).alias("__file"), wide.alias("__wide"))


# --- where they go --------------------------------------------------------------------------------


def copy_files(routes: DataFrame, root: str | None = None, linked: bool = False) -> DataFrame:
    """Copy every ``source`` to its ``target``; ``(source, error, error_type)`` of each, as a written table.

    Tasks copy in a stream, and a repeated copy writes the same file. A copy that fails leaves the others alone. ``linked`` copies take no
    disk where both lie on one local disk: they are a second name of the same file, so only for files that nobody writes to again.
    """
    routes = routes.select("source", "target")
    if root is not None and not opened_by_arrow(root):
        return _copied_by_driver(routes)
    locate = _locator()

    # Defined here, with its own imports, so that it travels to executors without this package.
    def copy_rows(batches):
        import contextlib
        import os
        import shutil

        import pyarrow as pa
        from pyarrow import fs

        def link(source, target) -> bool:
            with contextlib.suppress(OSError):
                os.link(source, target)
                return True
            return False

        for batch in batches:
            for row in batch.to_pylist():
                error = None
                try:
                    source_fs, source = locate(row["source"])
                    target_fs, target = locate(row["target"])
                    target_fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    local = isinstance(source_fs, fs.LocalFileSystem) and isinstance(target_fs, fs.LocalFileSystem)
                    if not (linked and local and link(source, target)):
                        with (
                            source_fs.open_input_stream(source, compression=None) as reader,
                            target_fs.open_output_stream(target, compression=None) as writer,
                        ):
                            shutil.copyfileobj(reader, writer)
                except Exception as e:  # of this file alone; it becomes the file's verdict
                    error = e
                cells = [row["source"], error and str(error), error and type(error).__name__]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.string()) for c in cells], ["source", "error", "error_type"])

    cores = routes.sparkSession.sparkContext.defaultParallelism
    copied = routes.repartition(cores, "source").mapInArrow(copy_rows, "source string, error string, error_type string")
    return materialize(copied, "copied")


def _copied_by_driver(routes: DataFrame) -> DataFrame:
    """The same by the driver's Hadoop client, file by file."""
    spark = routes.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def copy(route) -> tuple[str, str | None, str | None]:
        source, target = jvm.org.apache.hadoop.fs.Path(route.source), jvm.org.apache.hadoop.fs.Path(route.target)
        try:
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, True, conf)
        except Exception as error:
            return route.source, str(error), type(error).__name__
        return route.source, None, None

    done: Iterator = (copy(route) for route in routes.toLocalIterator())
    return spark.createDataFrame(list(done), "source string, error string, error_type string")


def screen_uploads(
    uploads: DataFrame, as_of: Column, source_systems: tuple[str, ...], tables: tuple[str, ...], max_bytes: int
) -> DataFrame:
    """Checks made before a file is stored at all; the first broken rule is the ``reason``.

    ``uploads`` has ``(source_system, table_name, file_name, size_bytes, file_hash)``. Accepted files
    get their clean name, batch id and path in the ``tmp`` zone.
    """
    listed = " or ".join(f"source_system='{s}'" for s in source_systems)
    name = F.coalesce(F.col("file_name"), F.lit(""))
    # The texts of the upload form.
    reason = (
        F.when(~F.col("source_system").isin(*source_systems), F.lit(f"Only {listed} is supported in v1."))
        .when(~F.col("table_name").isin(*tables), F.concat(F.lit("Unsupported table_name: "), F.col("table_name")))
        .when(name == "", F.lit("No file selected."))
        .when(~files.has_csv_suffix(name), F.lit("Only .csv files are allowed."))
        .when(F.col("size_bytes") == 0, F.lit("Uploaded file is empty."))
        .when(F.col("size_bytes") > max_bytes, F.lit(f"File size exceeds {max_bytes // (1024 * 1024)} MB limit."))
    )
    screened = uploads.withColumn("reason", reason).withColumn(
        "source_file_name", files.safe_file_name(name, F.col("file_hash"))
    )
    screened = screened.withColumn("batch_id", files.upload_batch_id(as_of, F.col("file_hash")))
    path = F.concat(
        F.lit("tmp/source="),
        "source_system",
        F.lit("/table="),
        "table_name",
        F.lit("/upload_id="),
        "batch_id",
        F.lit("/"),
        "source_file_name",
    )
    return screened.withColumn("tmp_file_path", F.when(F.col("reason").isNull(), path))
