"""Load landed CSV files: check a set of files, write the raw tables and the four audit logs.

Every file of a batch gets one verdict row; the raw rows and all audit rows derive from it. What goes wrong with one file, even what nobody
foresaw, becomes the verdict of that file and leaves the others alone. Ids come from the batch and the file, and each write
replaces the partition of its ingest, so a batch that is run again after a failure replaces its rows and never doubles them.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import AUDIT_LOGS, ENTITIES, LINEAGE, bronze_schema
from ..functions import files
from ..session import delete_path, materialize, scratch_path
from ..sources import landing
from ..sources.landing import UploadRequest
from ..sources.tables import Lake, merged_schema

# Names and messages written to the logs.
PIPELINE_NAME = "gcs_to_bronze_ingestion"
DUPLICATE_MESSAGE = "Duplicate file detected. Bronze load skipped."
UNKNOWN_HASH = "UNKNOWN"

# Partition columns of the raw tables, the logs and the table of handled files.
BRONZE_PARTITIONS = ("load_date", "ingest_id")
LOG_PARTITIONS = ("log_date", "ingest_id")
HANDLED_PARTITIONS = ("hash_prefix",)

HANDLED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("tmp_file_path", "file_hash", "status", "ingest_id", "hash_prefix")]
)

#: Folder of the files whose content is not known.
_NO_HASH = "none"
#: Jobs of one batch that run beside each other.
JOBS = 6
#: Raw rows are written once and read seldom.
RAW_CODEC = "zstd"


@dataclass(frozen=True)
class IngestOptions:
    """``max_files`` bounds the files of one batch, and with it the lookup table that is broadcast.

    Files of any size load; ``max_bytes`` sets a limit for those who want one. ``wide_rows`` says what becomes of rows with more
    cells than the header: ``reject`` refuses their file, ``quarantine`` sets the rows aside and loads the others.
    """

    max_bytes: int | None = None
    max_files: int = 20_000
    skip_step: str = "process_completed"
    service: str = "ingestion-service"
    environment: str = "dev"
    wide_rows: str = "reject"


# --- verdicts -----------------------------------------------------------------------------------


def _listing(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def _required() -> Column:
    """Required columns of each entity as a map literal."""
    pairs = [
        x
        for name, e in ENTITIES.items()
        for x in (F.lit(name), F.array(*[F.lit(c) for c in e.required_columns]))
    ]
    return F.create_map(*pairs)


def hash_prefix(file_hash: Column) -> Column:
    return F.coalesce(F.substring(file_hash, 1, 2), F.lit(_NO_HASH))


def known_hashes(handled: DataFrame, contents: DataFrame, ingest_id: str) -> DataFrame:
    """Those ``file_hash`` of ``contents`` that another batch has loaded.

    The table of handled files lies in folders by the first digits of the hash. The contents of one batch, at most ``max_files``, are broadcast, and
    Spark prunes the folders to theirs before it reads.
    """
    loaded = handled.where((F.col("status") == "success") & (F.col("ingest_id") != ingest_id))
    asked = contents.select(hash_prefix(F.col("file_hash")).alias("hash_prefix"), "file_hash")
    return loaded.join(F.broadcast(asked), ["hash_prefix", "file_hash"], "left_semi").select("file_hash").distinct()


def _check(manifest: DataFrame, max_bytes: int | None) -> DataFrame:
    """Adds ``own_error``: the first rule the file breaks by itself, as far as its bytes and header tell, NULL for a good file."""
    missing = F.array_except(F.col("required"), F.col("header"))
    blank_header = F.trim(F.regexp_replace("header_line", "[,\"]", "")) == ""
    limit = f"File size exceeds {(max_bytes or 0) // (1024 * 1024)} MB limit."
    too_large = F.lit(False) if max_bytes is None else F.col("size_bytes") > max_bytes
    # The texts of these errors.
    own_error = (
        F.when(~F.col("exists"), F.concat(F.lit("File not found: "), F.col("tmp_uri")))
        .when(F.col("read_error").isNotNull(), F.col("read_error"))
        .when(F.col("size_bytes") == 0, F.lit("File is empty"))
        .when(too_large, F.lit(limit))
        .when(F.col("content_error").isNotNull(), F.col("content_error"))
        .when(F.col("header_error").isNotNull(), F.col("header_error"))
        .when(blank_header, F.lit("No columns to parse from file"))
        .when(~F.col("has_rows"), F.lit("CSV has header but no rows"))
        .when(F.col("required").isNull(), F.concat(F.lit("Unsupported table_name: "), F.col("table_name")))
        .when(F.col("header").isNull(), F.lit(f"Too many columns: at most {landing.MAX_COLUMNS} are allowed"))
        .when(F.size(missing) > 0, F.concat(F.lit("Missing required columns: "), _listing(missing)))
    )
    unread = F.col("exists") & F.col("read_error").isNotNull()
    return manifest.withColumns({"own_error": own_error, "error_type": F.when(unread, F.col("read_error_type"))})


def _mark_duplicates(checked: DataFrame, handled: DataFrame, ingest_id: str) -> DataFrame:
    """Adds ``known`` (the content was loaded before) and ``first_good`` (the first good file of this content in the batch).

    All tables here have at most one row per file of the batch.
    """
    contents = (
        checked.where((F.col("size_bytes") > 0) & F.col("file_hash").isNotNull())
        .groupBy("file_hash")
        .agg(F.min(F.when(F.col("own_error").isNull(), F.col("seq"))).alias("first_good"))
    )
    contents = materialize(contents, "contents")
    # The comparison makes the batch a selective side, which is what Spark prunes partitions by.
    seen = known_hashes(handled, contents.where(F.length("file_hash") > 0), ingest_id)
    contents = contents.join(seen.withColumn("known", F.lit(True)), "file_hash", "left")
    marked = checked.join(contents, "file_hash", "left")
    return marked.withColumn("known", F.coalesce("known", F.lit(False)))


def manifest(
    spark: SparkSession,
    root: str,
    requests: list[UploadRequest],
    handled: DataFrame,
    ingest_id: str,
    as_of: dt.datetime,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """One row per requested file: what its bytes and header say, before any row is read."""
    asked = landing.requests_frame(spark, requests)
    prints = landing.fingerprints(spark, root, asked.select("tmp_file_path").distinct(), options.max_bytes)
    prints = materialize(prints, "fingerprints")
    headers = landing.headers(prints.where(F.col("header_line").isNotNull()))
    path = F.col("tmp_file_path")
    load_date = F.lit(as_of.date().isoformat())
    raw = files.zone_path(
        F.lit("raw"), F.col("source_system"), F.col("table_name"), load_date, F.col("batch_id"), files.file_name(path)
    )
    rows = (
        asked.join(prints, "tmp_file_path", "left")
        .join(headers, "header_line", "left")
        .withColumns(
            {
                "exists": F.coalesce(F.col("exists"), F.lit(False)),
                "source_file_name": files.file_name(path),
                "tmp_uri": F.concat(F.lit(f"{root}/"), path),
                "raw_uri": F.concat(F.lit(f"{root}/"), raw),
                "required": _required()[F.col("table_name")],
                "run_id": files.stable_id(F.lit(ingest_id), F.col("seq"), path),
                "load_date": load_date,
                "at": F.lit(as_of).cast("timestamp"),
            }
        )
    )
    checked = materialize(_check(rows, options.max_bytes), "checked")
    return materialize(_mark_duplicates(checked, handled, ingest_id), "marked")


# --- raw rows -----------------------------------------------------------------------------------


def column_names(header: list[str | None], required: list[str]) -> list[str | None]:
    """The column of the raw table that each cell of a header goes to, None for cells that go nowhere.

    Required columns keep their names. Others become letters, digits and ``_``; a name that is taken, in any case, gets a number. Lineage
    overrides a column of its name.
    """
    reserved = {c.lower() for c in (*LINEAGE, "ingest_id", "__file", "__wide")}
    taken = {c.lower() for c in required}
    out: list[str | None] = []
    for place, name in enumerate(header):
        if name in required and name not in out:
            out.append(name)
            continue
        if name and name.lower() in reserved:
            out.append(None)
            continue
        plain = re.sub(r"\W", "_", (name or "").strip()) or f"column_{place}"
        free, k = plain, 1
        while free.lower() in taken | reserved:
            free, k = f"{plain}_{k}", k + 1
        taken.add(free.lower())
        out.append(free)
    return out


def _isolated(paths: list[str], write: Callable[[list[str]], None]) -> dict[str, Exception]:
    """Run ``write`` over the paths; where it fails, over each half, until the files that fail stand alone."""
    if not paths:
        return {}
    try:
        write(paths)
    except Exception as error:
        if len(paths) == 1:
            return {paths[0]: error}
        middle = len(paths) // 2
        return _isolated(paths[:middle], write) | _isolated(paths[middle:], write)
    return {}


@dataclass(frozen=True)
class Layout:
    """Good files of one entity and header, all with or all without quoted line breaks: one read with its own columns."""

    entity: str
    layout_id: str
    names: list[str | None]
    multi_line: bool
    paths: list[str]

    def rows(self, spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
        return landing.read_rows(spark, root, paths, self.names, self.multi_line)

    @property
    def columns(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names if n is not None])


def count_rows(lake: Lake, root: str, marked: DataFrame) -> tuple[list[Layout], DataFrame]:
    """Read the rows of every good content: the layouts with files that can be read, and ``(tmp_file_path, row_count, wide_rows, error, error_type)``.

    Files are grouped by layout. Only the counts are written, so that the raw tables are the one place that ever holds the rows; what loads
    is parsed once more, by ``load_rows``.
    """
    spark = lake.spark
    chosen = marked.where(F.col("own_error").isNull() & ~F.col("known") & (F.col("seq") == F.col("first_good")))
    layouts = chosen.groupBy("table_name", "header_line", "multi_line").agg(
        F.first("header").alias("header"), F.sort_array(F.collect_list("tmp_file_path")).alias("paths")
    )
    layouts = layouts.withColumn("layout_id", F.sha2(F.concat_ws("|", "header_line", F.col("multi_line").cast("string")), 256))
    base = scratch_path(spark, "counts")
    schemas: dict[str, T.StructType] = {}
    failed: dict[str, Exception] = {}
    found = []
    # Paths and headers of the files of one batch, a layout at a time.
    for row in materialize(layouts, "layouts").toLocalIterator():
        names = column_names(row.header, ENTITIES[row.table_name].required_columns)
        layout = Layout(row.table_name, row.layout_id, names, row.multi_line, row.paths)
        known = lake.schema("bronze", f"bronze_{layout.entity}") or bronze_schema(layout.entity)
        grown = merged_schema(merged_schema(known, schemas.get(layout.entity, layout.columns)), layout.columns)
        if len(grown) > landing.MAX_COLUMNS + len(LINEAGE) + 1:
            failed |= dict.fromkeys(layout.paths, ValueError(f"Too many columns in {layout.entity}: {len(grown)}"))
            continue
        schemas[layout.entity] = merged_schema(schemas.get(layout.entity), layout.columns)
        found.append(layout)
    kind = "tmp_file_path string, row_count long, wide_rows long"

    def count(layout: Layout) -> dict[str, Exception]:
        def write(paths: list[str]) -> None:
            counts = layout.rows(spark, root, paths).groupBy(F.col("__file").alias("tmp_file_path"))
            counts = counts.agg(F.count(F.lit(1)).alias("row_count"), F.count_if("__wide").alias("wide_rows"))
            # A folder per layout, so that each write has a committer of its own.
            counts.write.mode("append").parquet(f"{base}/{layout.entity}/{layout.layout_id}")

        return _isolated(layout.paths, write)

    # Layouts are jobs of their own, so small ones share the cluster.
    with ThreadPoolExecutor(JOBS) as pool:
        for broken in pool.map(count, found):
            failed |= broken
    readable = [replace(layout, paths=[p for p in layout.paths if p not in failed]) for layout in found]
    readable = [layout for layout in readable if layout.paths]
    counted = spark.createDataFrame([], kind)
    if readable:
        counted = spark.read.option("recursiveFileLookup", "true").schema(kind).parquet(base)
    errors = spark.createDataFrame(
        [(path, *_cause(error)) for path, error in failed.items()], "tmp_file_path string, error string, error_type string"
    )
    return readable, materialize(counted.join(errors, "tmp_file_path", "full"), "counted")


def _cause(error: Exception) -> tuple[str, str]:
    """Message and type of an error; of a Java one those at its root, without the stack trace."""
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if java is None:
        return (str(error).strip() or type(error).__name__).splitlines()[0], type(error).__name__
    while java.getCause() is not None:
        java = java.getCause()
    kind = java.getClass().getSimpleName()
    return (str(java.getMessage() or kind).strip() or kind).splitlines()[0], kind


def verdicts(marked: DataFrame, counted: DataFrame, root: str, options: IngestOptions = IngestOptions()) -> DataFrame:
    """The verdict of every file, from its marks and from what reading its content gave.

    Of several good files with equal content the first one loads and the others are duplicates, unless the content can't be read: then each of
    them fails for the same reason.
    """
    leads = marked.where(F.col("seq") == F.col("first_good")).select("tmp_file_path", "file_hash").join(counted, "tmp_file_path")
    leads = leads.select("file_hash", "row_count", "wide_rows", F.col("error").alias("load_error"), F.col("error_type").alias("load_error_type"))
    rows = marked.join(leads, "file_hash", "left")
    refused = F.lit(options.wide_rows == "reject") & (F.col("wide_rows") > 0)
    # The texts of these errors.
    unread = (
        F.when(F.col("load_error").isNotNull(), F.col("load_error"))
        .when(refused, F.lit("Error tokenizing data: a row has more fields than the header"))
        .when(F.coalesce(F.col("row_count"), F.lit(0)) == 0, F.lit("CSV has header but no rows"))
    )
    later = F.coalesce(F.col("seq") > F.col("first_good"), F.lit(False))
    error = F.when(~F.col("known"), F.coalesce("own_error", unread))
    # A wrong copy of a content that loads is a duplicate like any other.
    duplicate = F.col("known") | (later & unread.isNull())
    status = F.when(duplicate, "skipped").when(error.isNotNull(), "failed").otherwise("success")
    judged = rows.withColumns(
        {
            "error": F.when(~duplicate, error),
            "error_type": F.coalesce("error_type", F.when(F.col("own_error").isNull(), F.col("load_error_type"))),
        }
    ).withColumn("status", status)
    judged = judged.withColumn("row_count", F.when(status == "success", F.col("row_count") - _set_aside(options)))
    return _routed(judged, root)


def _set_aside(options: IngestOptions) -> Column:
    return F.col("wide_rows") if options.wide_rows == "quarantine" else F.lit(0)


def _routed(judged: DataFrame, root: str) -> DataFrame:
    """Adds where each file goes and how its answer reads, from ``status``, ``error`` and ``error_type``."""
    failed = F.col("status") == "failed"
    unexpected = failed & F.col("error_type").isNotNull()
    zone = F.when(F.col("status") == "success", "raw").when(failed, "rejected")
    target = files.zone_path(
        zone, F.col("source_system"), F.col("table_name"), F.col("load_date"), F.col("batch_id"), F.col("source_file_name")
    )
    return judged.withColumns(
        {
            "zone": zone,
            "target_uri": F.concat(F.lit(f"{root}/"), target),
            "http_status": F.when(unexpected, F.lit(500)).when(failed, F.lit(400)).otherwise(F.lit(200)).cast("bigint"),
            "error_class": F.when(unexpected, F.lit("unexpected")).when(failed, F.lit("expected")),
            "error_type": F.when(failed, F.coalesce("error_type", F.lit("ValueError"))),
        }
    )


def route(verdict: DataFrame, root: str) -> DataFrame:
    """Copy the files to their zones; a file that can't be copied to the raw zone fails, and is offered to the rejected zone."""
    verdict = materialize(verdict, "verdicts")
    here = verdict.where(F.col("exists") & F.col("zone").isNotNull())
    copied = landing.copy_files(here.select(F.col("tmp_uri").alias("source"), F.col("target_uri").alias("target")).distinct(), root)
    lost = copied.where(F.col("error").isNotNull()).select(
        F.col("source").alias("tmp_uri"), F.col("error").alias("copy_error"), F.col("error_type").alias("copy_error_type")
    )
    if lost.isEmpty():
        return verdict
    broken = (F.col("status") == "success") & F.col("copy_error").isNotNull()
    judged = verdict.join(lost, "tmp_uri", "left").withColumns(
        {
            "error": F.when(broken, F.col("copy_error")).otherwise(F.col("error")),
            "error_type": F.when(broken, F.col("copy_error_type")).when(F.col("error_class") == "unexpected", F.col("error_type")),
            "row_count": F.when(~broken, F.col("row_count")),
            "status": F.when(broken, "failed").otherwise(F.col("status")),
        }
    )
    judged = materialize(_routed(judged.drop("copy_error", "copy_error_type"), root), "verdicts")
    again = judged.join(lost.select("tmp_uri"), "tmp_uri", "left_semi").where("exists and status = 'failed'")
    landing.copy_files(again.select(F.col("tmp_uri").alias("source"), F.col("target_uri").alias("target")), root)
    return judged


def results(verdict: DataFrame) -> DataFrame:
    """The answer for each file."""
    status = F.col("status")
    return verdict.select(
        "status",
        F.when(status == "skipped", "duplicate_file").alias("reason"),
        "run_id",
        "batch_id",
        "table_name",
        F.when(status == "skipped", F.col("tmp_uri")).otherwise(F.col("target_uri")).alias("gcs_uri"),
        F.when(status == "success", F.concat(F.lit("bronze_"), "table_name")).alias("bronze_table"),
        F.when(status == "success", F.col("row_count")).otherwise(F.lit(0)).alias("row_count"),
        F.when(status != "failed", F.col("file_hash")).alias("file_hash"),
        "error",
        "http_status",
    )


def _of(layouts: list[Layout], verdict: DataFrame) -> list[Layout]:
    """The layouts with their files that load."""
    # Paths of the files of one batch.
    loads = {r.tmp_file_path for r in verdict.where("status = 'success'").select("tmp_file_path").toLocalIterator()}
    left = [replace(layout, paths=[p for p in layout.paths if p in loads]) for layout in layouts]
    return [layout for layout in left if layout.paths]


def load_rows(lake: Lake, root: str, layouts: list[Layout], verdict: DataFrame, ingest_id: str, as_of: dt.datetime) -> None:
    """Write the rows of the files that load, with lineage, to the raw tables, in place of what this ingest wrote before.

    Each layout is written beside the table, as what will be its partition; that is switched to when all of them are whole. So the rows are
    written once, and nothing sorts them.
    """
    # One short row per file of the batch, so at most ``max_files`` rows.
    lineage = verdict.where(F.col("status") == "success").select(
        F.col("tmp_file_path").alias("__file"),
        "batch_id",
        "run_id",
        "source_system",
        "source_file_name",
        F.col("target_uri").alias("gcs_uri"),
        "file_hash",
        F.col("at").alias("ingestion_timestamp"),
    )
    place = {"load_date": as_of.date().isoformat(), "ingest_id": ingest_id}
    asides = {e: lake.aside("bronze", f"bronze_{e}") for e in {layout.entity for layout in layouts}}
    spelled = {}
    for entity in asides:
        lake.grow("bronze", f"bronze_{entity}", _with(bronze_schema(entity), "ingest_id"))
        more = reduce(merged_schema, [layout.columns for layout in layouts if layout.entity == entity])
        spelled[entity] = {f.name.lower(): f.name for f in lake.grow("bronze", f"bronze_{entity}", more)}

    def write(layout: Layout) -> str:
        required = ENTITIES[layout.entity].required_columns
        rows = layout.rows(lake.spark, root, layout.paths).where(~F.col("__wide")).join(F.broadcast(lineage), "__file")
        more = [c for c in layout.columns.names if c not in required]
        rows = rows.select(*required, *[c for c in LINEAGE if c not in place], *[F.col(f"`{c}`").alias(spelled[layout.entity][c.lower()]) for c in more])
        folder = f"{asides[layout.entity]}/{layout.layout_id}"
        rows.write.option("compression", RAW_CODEC).parquet(folder)
        return folder

    loading = _of(layouts, verdict)
    try:
        with ThreadPoolExecutor(JOBS) as pool:
            folders = list(pool.map(write, loading))
        for entity, aside in asides.items():
            whole = [f for layout, f in zip(loading, folders, strict=True) if layout.entity == entity]
            if whole:
                lake.put_partition("bronze", f"bronze_{entity}", aside, whole, place)
                _drop_other_days(lake, "bronze", f"bronze_{entity}", BRONZE_PARTITIONS, ingest_id, as_of)
    finally:
        for aside in asides.values():
            delete_path(lake.spark, aside)


def quarantined_rows(spark: SparkSession, root: str, layouts: list[Layout], verdict: DataFrame, ingest_id: str) -> DataFrame | None:
    """Rows with more cells than their header, with file and reason, of the files that load without them."""
    loading = _of(layouts, verdict)
    if not loading:
        return None
    base = scratch_path(spark, "wide")

    def write(layout: Layout) -> None:
        # In the order of the columns that the files of this entity have.
        names = reduce(merged_schema, [x.columns for x in layouts if x.entity == layout.entity]).names
        own = {c.lower(): c for c in layout.columns.names}
        cells = [F.col(f"`{own[n.lower()]}`").alias(n) for n in names if n.lower() in own]
        wide = layout.rows(spark, root, layout.paths).where("__wide").select("__file", F.to_json(F.struct(*cells)).alias("row"))
        wide.write.parquet(f"{base}/{layout.entity}/{layout.layout_id}")

    with ThreadPoolExecutor(JOBS) as pool:
        list(pool.map(write, loading))
    loaded = verdict.where("status = 'success'").select(
        F.col("tmp_file_path").alias("__file"), "batch_id", "run_id", "table_name", "source_file_name", "load_date"
    )
    return (
        spark.read.option("recursiveFileLookup", "true")
        .schema("__file string, row string")
        .parquet(base)
        .join(F.broadcast(loaded), "__file")
        .select(
            "batch_id", "run_id", "table_name", "source_file_name", F.lit("ROW").alias("rejection_level"),
            F.lit("more fields than the header").alias("rejection_reason"), "row", "load_date", F.lit(ingest_id).alias("ingest_id"),
        )
    )


# --- audit logs ---------------------------------------------------------------------------------


def _entries(verdict: DataFrame, *rows: tuple[Column, dict[str, Column]]) -> DataFrame:
    """One output row per verdict and entry whose condition holds."""
    structs = [F.when(cond, F.struct(*[c.alias(n) for n, c in row.items()])) for cond, row in rows]
    exploded = verdict.select("*", F.posexplode(F.array(*structs)).alias("entry_no", "entry")).where("entry is not null")
    return exploded


def _shape(df: DataFrame, log: str, ingest_id: str, given: dict[str, Column]) -> DataFrame:
    columns = [given.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in AUDIT_LOGS[log]]
    return df.select(*columns, F.col("load_date").alias("log_date"), F.lit(ingest_id).alias("ingest_id"))


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def audit_rows(
    verdict: DataFrame, ingest_id: str, bucket: str, skip_step: str = "process_completed"
) -> dict[str, DataFrame]:
    """The rows of the four logs."""
    status = F.col("status")
    ok, skipped, failed = status == "success", status == "skipped", status == "failed"

    def step(name: str, state: str, error: Column | None = None) -> dict[str, Column]:
        return {
            "step_name": _text(name),
            "status": _text(state),
            "error_message": _text(None) if error is None else error,
        }

    def check(name: str, state: str, expected: Column, actual: Column, bad: int = 0) -> dict[str, Column]:
        return {
            "check_name": _text(name),
            "check_status": _text(state),
            "expected_value": expected.cast("string"),
            "actual_value": actual.cast("string"),
            "failed_count": F.lit(bad).cast("bigint"),
        }

    steps = _entries(
        verdict,
        (F.lit(True), step("process_started", "STARTED")),
        (ok, step("bronze_load", "SUCCESS")),
        (ok, step("process_completed", "SUCCESS")),
        (skipped, step(skip_step, "SKIPPED")),
        (failed, step("process_failed", "FAILED", F.col("error"))),
    )
    checks = _entries(
        verdict,
        (F.col("size_bytes") > 0, check("file_not_empty", "PASS", F.lit("file_size > 0"), F.col("size_bytes"))),
        (skipped, check("duplicate_file_check", "FAILED", F.lit("unique file_hash"), F.col("file_hash"), 1)),
        (ok, check("schema_validation", "PASS", _listing(F.col("required")), _listing(F.col("header")))),
        (ok, check("row_count_check", "PASS", F.lit("row_count > 0"), F.col("row_count"))),
        (failed, check("file_validation", "FAILED", F.lit("valid file"), F.col("error"), 1)),
    )
    step_names = ("step_name", "status", "error_message")
    check_names = ("check_name", "check_status", "expected_value", "actual_value", "failed_count")
    request = F.struct(
        F.lit(bucket).alias("bucket_name"), "source_system", "table_name", "tmp_file_path", "batch_id"
    )
    return {
        "rejected_records": _shape(
            verdict.where(failed),
            "rejected_records",
            ingest_id,
            {
                "rejected_id": files.stable_id(F.col("run_id"), F.lit("rejected")),
                "gcs_uri": F.col("target_uri"),
                "rejection_level": F.lit("FILE"),
                "rejection_reason": F.col("error"),
                "rejected_payload": F.to_json(request),
                "created_at": F.col("at"),
            },
        ),
        "data_quality_log": _shape(
            checks,
            "data_quality_log",
            ingest_id,
            {
                "check_id": files.stable_id(F.col("run_id"), F.lit("check"), F.col("entry_no")),
                "created_at": F.col("at"),
                **{n: F.col(f"entry.{n}") for n in check_names},
            },
        ),
        "file_upload_log": _shape(
            verdict,
            "file_upload_log",
            ingest_id,
            {
                "upload_id": files.stable_id(F.col("run_id"), F.lit("upload")),
                "gcs_uri": F.when(skipped, F.col("tmp_uri")).otherwise(F.col("target_uri")),
                "file_hash": F.when(failed, F.lit(UNKNOWN_HASH)).otherwise(F.col("file_hash")),
                "row_count": F.when(ok, F.col("row_count")).otherwise(F.lit(0)),
                "upload_status": F.when(ok, "SUCCESS").when(skipped, "DUPLICATE").otherwise("FAILED"),
                "created_at": F.col("at"),
                "error_message": F.when(skipped, F.lit(DUPLICATE_MESSAGE)).otherwise(F.col("error")),
            },
        ),
        "pipeline_run_log": _shape(
            steps,
            "pipeline_run_log",
            ingest_id,
            {
                "pipeline_name": F.lit(PIPELINE_NAME),
                "start_time": F.col("at"),
                "end_time": F.current_timestamp(),
                **{n: F.col(f"entry.{n}") for n in step_names},
            },
        ),
    }


def _event(name: str, severity: str, message: str) -> dict[str, Column]:
    return {"event": _text(name), "severity": _text(severity), "message": _text(message)}


def _as_events(entries: DataFrame, options: IngestOptions) -> DataFrame:
    elapsed = (F.unix_millis(F.current_timestamp()) - F.unix_millis("at")).cast("bigint")
    fields = entries.select(
        F.col("entry.severity").alias("severity"),
        F.col("entry.event").alias("event"),
        F.col("entry.message").alias("message"),
        F.lit(options.service).alias("service"),
        F.lit(options.environment).alias("environment"),
        F.col("at").alias("timestamp"),
        "run_id",
        "batch_id",
        "table_name",
        "source_file_name",
        "row_count",
        elapsed.alias("duration_ms"),
        "error_type",
        F.col("error").alias("error_message"),
        F.col("http_status").alias("status"),
    )
    line = [c for c in fields.columns if c != "status"]
    return fields.withColumn("json", F.to_json(F.struct(*line)))


def log_events(verdict: DataFrame, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Structured log events of each step: the fields and the same as one line of JSON."""
    status = F.col("status")
    ok, skipped = status == "success", status == "skipped"
    expected, unexpected = F.col("error_class") == "expected", F.col("error_class") == "unexpected"
    entries = _entries(
        verdict,
        (F.lit(True), _event("pipeline_started", "INFO", "File taken up")),
        (ok, _event("schema_validation_passed", "INFO", "All required columns are there")),
        (ok, _event("bronze_load_completed", "INFO", "Raw rows written")),
        (ok, _event("pipeline_completed", "INFO", "File done")),
        (skipped, _event("duplicate_file_detected", "WARNING", DUPLICATE_MESSAGE)),
        (expected, _event("file_validation_failed", "WARNING", "A rule for files is broken")),
        (expected, _event("file_rejected", "WARNING", "File put aside")),
        (unexpected, _event("pipeline_failed", "ERROR", "File lost to an error that no rule foresees")),
    )
    return _as_events(entries, options)


# --- the job ------------------------------------------------------------------------------------


def _with(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in names]])


def read_log(lake: Lake, log: str) -> DataFrame:
    return lake.read("audit", log, _with(AUDIT_LOGS[log], "log_date", "ingest_id")).drop("log_date")


def read_handled(lake: Lake) -> DataFrame:
    """Files that an ingest has loaded or logged, by full path; repeated rows mean nothing."""
    return lake.read("audit", "handled_files", HANDLED)


def read_bronze(lake: Lake, entity: str) -> DataFrame:
    """Raw rows of an entity, with all columns that any of its files had."""
    return lake.read("bronze", f"bronze_{entity}", _with(bronze_schema(entity), "ingest_id"))


def read_quarantine(lake: Lake) -> DataFrame:
    names = ("batch_id", "run_id", "table_name", "source_file_name", "rejection_level", "rejection_reason", "row", "load_date", "ingest_id")
    return lake.read("audit", "quarantined_rows", T.StructType([T.StructField(n, T.StringType()) for n in names]))


def ingest_batch(
    lake: Lake,
    root: str,
    requests: list[UploadRequest],
    ingest_id: str,
    as_of: dt.datetime,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Check, route, load and log one batch of files; returns one result row per file.

    If the job itself breaks down, its raw rows are taken back, every file is logged as failed for a reason that is not in the files (class
    ``unexpected``), and the error is raised; the files count as not handled, so the next run takes them up again.
    """
    if len(requests) > options.max_files:
        raise ValueError(f"{len(requests)} files in one batch, at most {options.max_files} are allowed")
    try:
        return _ingest(lake, root, requests, ingest_id, as_of, options)
    except Exception as error:
        for entity in ENTITIES:
            lake.drop_partitions("bronze", f"bronze_{entity}", "ingest_id", ingest_id)
        _write_logs(lake, root, _broken_down(lake.spark, root, requests, ingest_id, as_of, error), ingest_id, as_of, options)
        raise


def _broken_down(
    spark: SparkSession, root: str, requests: list[UploadRequest], ingest_id: str, as_of: dt.datetime, error: Exception
) -> DataFrame:
    """Verdicts of files whose batch broke down."""
    path = F.col("tmp_file_path")
    rows = landing.requests_frame(spark, requests).withColumns(
        {
            "run_id": files.stable_id(F.lit(ingest_id), F.col("seq"), path),
            "source_file_name": files.file_name(path),
            "tmp_uri": F.concat(F.lit(f"{root}/"), path),
            "required": F.lit(None).cast("array<string>"),
            "header": F.lit(None).cast("array<string>"),
            "size_bytes": F.lit(None).cast("long"),
            "row_count": F.lit(None).cast("long"),
            "file_hash": _text(None),
            "load_date": F.lit(as_of.date().isoformat()),
            "at": F.lit(as_of).cast("timestamp"),
            "status": F.lit("failed"),
            "error": F.lit(str(error)),
            "error_type": F.lit(type(error).__name__),
        }
    )
    return _routed(rows, root)


def _replace(lake: Lake, layer: str, table: str, rows: DataFrame, by: tuple[str, ...], ingest_id: str, as_of: dt.datetime) -> None:
    """Write the rows of one ingest; a run of it on another day is replaced too."""
    lake.replace_partitions(layer, table, rows, by)
    _drop_other_days(lake, layer, table, by, ingest_id, as_of)


def _drop_other_days(lake: Lake, layer: str, table: str, by: tuple[str, ...], ingest_id: str, as_of: dt.datetime) -> None:
    lake.drop_partitions(layer, table, "ingest_id", ingest_id, apart_from=f"{by[0]}={as_of.date().isoformat()}")


def _write_logs(lake: Lake, root: str, verdict: DataFrame, ingest_id: str, as_of: dt.datetime, options: IngestOptions) -> None:
    logs = audit_rows(verdict, ingest_id, root, options.skip_step)
    logs["events"] = log_events(verdict, options).withColumns({"log_date": F.col("timestamp").cast("date").cast("string"), "ingest_id": F.lit(ingest_id)})
    # Small writes of tables of their own, so they share the cluster.
    with ThreadPoolExecutor(len(logs)) as pool:
        list(pool.map(lambda log: _replace(lake, "audit", log, logs[log], LOG_PARTITIONS, ingest_id, as_of), logs))


def _ingest(
    lake: Lake, root: str, requests: list[UploadRequest], ingest_id: str, as_of: dt.datetime, options: IngestOptions
) -> DataFrame:
    marked = manifest(lake.spark, root, requests, read_handled(lake), ingest_id, as_of, options)
    layouts, counted = count_rows(lake, root, marked)
    verdict = route(verdicts(marked, counted, root, options), root)
    load_rows(lake, root, layouts, verdict, ingest_id, as_of)
    if options.wide_rows == "quarantine":
        wide = quarantined_rows(lake.spark, root, layouts, verdict, ingest_id)
        if wide is not None:
            _replace(lake, "audit", "quarantined_rows", wide, BRONZE_PARTITIONS, ingest_id, as_of)
    _write_logs(lake, root, verdict, ingest_id, as_of, options)
    done = verdict.select(
        "tmp_file_path", "file_hash", "status", F.lit(ingest_id).alias("ingest_id"), hash_prefix(F.col("file_hash")).alias("hash_prefix")
    )
    # Last, as it is what makes the files count as handled.
    lake.append("audit", "handled_files", done.repartition("hash_prefix"), HANDLED_PARTITIONS)
    return results(verdict)


def pending_files(lake: Lake, root: str, max_files: int) -> DataFrame:
    """Landed files that no ingest has handled, as requests with their ``part``: numbers of at most ``max_files`` files in path order.

    Paths are told apart whole, so a name that comes again from another source or folder is another file. They are counted per range of
    paths, and only those counts, one row per range, meet in one task.
    """
    spark = lake.spark
    landed = landing.landed_files(spark, root).select("tmp_file_path")
    left = landed.join(read_handled(lake).select("tmp_file_path"), "tmp_file_path", "left_anti")
    ranged = materialize(left.repartitionByRange("tmp_file_path").withColumn("_range", F.spark_partition_id()), "pending")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.join(F.broadcast(sizes.select("_range", before.alias("_before"))), "_range")
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("tmp_file_path")) + F.col("_before") - 1
    numbered = placed.select("tmp_file_path", F.floor(nth / max_files).alias("part"))
    return materialize(landing.describe(numbered), "pending")


def ingest_landing(
    lake: Lake, root: str, ingest_id: str, as_of: dt.datetime, options: IngestOptions = IngestOptions()
) -> list[DataFrame]:
    """Ingest all pending files, ``max_files`` at a time."""
    pending = pending_files(lake, root, options.max_files)
    parts = (pending.agg(F.max("part").alias("last")).first()["last"] or 0) + 1 if not pending.isEmpty() else 0
    done = []
    for part in range(parts):
        requests = landing.collect_requests(pending.where(F.col("part") == part))
        done.append(ingest_batch(lake, root, requests, f"{ingest_id}-{part}", as_of, options))
    return done


def delete_batches(lake: Lake, entity: str, batch_ids: list[str]) -> None:
    """Remove all rows of some batches from a raw table."""
    lake.delete_batches("bronze", f"bronze_{entity}", batch_ids, BRONZE_PARTITIONS, _with(bronze_schema(entity), "ingest_id"))


def rows_loaded(lake: Lake, ingest_id: str) -> DataFrame:
    """Rows in the raw tables per run of one ingest, all its batches: ``(table_name, run_id, row_count)``."""
    batch = F.substring_index("ingest_id", "-", -1).rlike("^[0-9]+$")
    mine = (F.col("ingest_id") == ingest_id) | (batch & (F.regexp_replace("ingest_id", "-[0-9]+$", "") == ingest_id))
    parts = [
        read_bronze(lake, e)
        .where(mine)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(e).alias("table_name"), "run_id", "row_count")
        for e in ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)
