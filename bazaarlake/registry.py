"""The registered queries: name -> function of (session, sample folder), and their SQL twins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .contracts import ENTITIES, MAX_FILE_BYTES, SOURCE_SYSTEMS
from .functions.files import file_name, path_value
from .operators import checks, joins
from .operators.dedup import latest_per_key
from .operators.rank import global_rank
from .plans import gold, ingest, marts, quality, reports, silver
from .session import configure, materialize, scratch_path, scratch_scope
from .sources import landing, sample
from .sources.tables import Lake, union_by_name
from .streaming import events as stream_events
from .streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_AS_OF = dt.datetime.fromisoformat(oracle.AS_OF)


class Tables:
    """The tables of every layer over one sample folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cache
    def bronze(self, entity: str) -> DataFrame:
        return sample.BRONZE[entity](self.spark, self.sf_dir)

    @cache
    def log(self, name: str) -> DataFrame:
        return sample.AUDIT[name](self.spark, self.sf_dir)

    @cache
    def events(self) -> DataFrame:
        return sample.pipeline_events(self.spark, self.sf_dir)

    @cache
    def silver(self, entity: str) -> DataFrame:
        return silver.trusted(entity, self.bronze(entity))

    @cache
    def dim_date(self) -> DataFrame:
        return gold.dim_date_covering(self.silver("orders"))

    @cache
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver("customers"), self.silver("orders"), _AS_OF)

    @cache
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver("products"))

    @cache
    def dim_seller(self) -> DataFrame:
        return gold.dim_seller(self.silver("sellers"))

    @cache
    def fact_orders(self) -> DataFrame:
        return gold.fact_orders(self.silver("orders"), self.silver("order_items"), self.silver("payments"))

    @cache
    def fact_order_items(self) -> DataFrame:
        return gold.fact_order_items(self.silver("order_items"), self.written("silver_orders"))

    @cache
    def fact_payments(self) -> DataFrame:
        return gold.fact_payments(self.silver("payments"), self.written("silver_orders"))

    @cache
    def mart_sales_performance(self) -> DataFrame:
        return marts.mart_sales_performance(self.fact_order_items(), self.written("dim_product"))

    @cache
    def mart_product_performance(self) -> DataFrame:
        return marts.mart_product_performance(self.fact_order_items(), self.dim_product())

    @cache
    def mart_customer_rfm(self) -> DataFrame:
        # The order fact serves three times: per customer, for the analysis date and for the customers only it knows.
        orders = self.written("fact_orders")
        return marts.mart_customer_rfm(orders, gold.dim_customer(self.silver("customers"), orders, _AS_OF))

    @cache
    def mart_pipeline_quality(self) -> DataFrame:
        return marts.mart_pipeline_quality(
            self.log("pipeline_run_log"),
            self.log("data_quality_log"),
            self.log("rejected_records"),
            self.log("file_upload_log"),
        )

    def landed(self) -> str:
        """The root of a landing zone that holds the raw tables as files, and files that can't load."""

        def fill(base: str) -> None:
            with scratch_scope(self.spark):
                sample.land(self.spark, self.sf_dir, base)

        return _once(self, "landing", fill)

    def ingested(self) -> Lake:
        """A lake filled from it by the ingest job, which is also asked for a file that isn't there."""

        def fill(base: str) -> None:
            lake, landed = Lake(self.spark, f"{base}/lake"), self.landed()
            with scratch_scope(self.spark):
                done = ingest.ingest_landing(lake, landed, "sample", _AS_OF)
                done.append(ingest.ingest_batch(lake, landed, [sample.MISSING], "sample-missing", _AS_OF))
                union_by_name(*done).write.parquet(f"{base}/results")

        return Lake(self.spark, _once(self, "ingest", fill) + "/lake")

    def ingest_results(self) -> DataFrame:
        return self.spark.read.parquet(self.ingested().root.removesuffix("/lake") + "/results")

    def streamed(self) -> Lake:
        """The same, filled by the streaming job."""

        def fill(base: str) -> None:
            ingest_available(Lake(self.spark, f"{base}/lake"), self.landed(), f"{base}/checkpoint", clock=lambda: _AS_OF)

        return Lake(self.spark, _once(self, "stream", fill) + "/lake")

    @cache
    def event_windows(self, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Windows of the event stream, as the streaming job leaves them."""
        base = scratch_path(self.spark, "windows")
        stream = build(sample.pipeline_event_stream(self.spark, self.sf_dir))
        stream_events.keep_windows(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
        labels = tuple(c for c in stream.columns if c == "metric")
        return stream_events.current_windows(self.spark, f"{base}/table", stream.schema, labels)

    @cache
    def written(self, name: str) -> DataFrame:
        """A table of any layer, written once to the shared folder, as the build jobs do.

        Used by queries that read one table several times.
        """
        lazy = self.silver(name.removeprefix("silver_")) if name.startswith("silver_") else getattr(self, name)()
        return materialize(lazy, name)


class Layers(Tables):
    """The same tables, each written once before others are derived from it, as the build jobs do; for queries that read all of them."""

    @cache
    def silver(self, entity: str) -> DataFrame:
        return materialize(super().silver(entity), f"silver_{entity}")

    @cache
    def fact_orders(self) -> DataFrame:
        return materialize(super().fact_orders(), "fact_orders")

    @cache
    def fact_order_items(self) -> DataFrame:
        return materialize(super().fact_order_items(), "fact_order_items")

    @cache
    def written(self, name: str) -> DataFrame:
        if name.startswith("silver_"):
            return self.silver(name.removeprefix("silver_"))
        if name in ("fact_orders", "fact_order_items"):
            return getattr(self, name)()
        return super().written(name)


_folders: dict[tuple[str, str, str], str] = {}


def _once(t: Tables, name: str, fill: Callable[[str], None]) -> str:
    """A folder below the shared one that ``fill`` has filled, once per session and sample; several queries read it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _folders or not Lake(t.spark, _folders[key]).exists("", ""):
        base = scratch_path(t.spark, name)
        fill(base)
        _folders[key] = base
    return _folders[key]


def _register(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


def _tables(name: str, build: Callable[[Tables], DataFrame], sql: str) -> None:
    _register(name, oracle.over_tables(sql))(build)


def _logs(name: str, build: Callable[[Tables], DataFrame], sql: str) -> None:
    _register(name, oracle.over_logs(sql))(build)


# --- trusted tables, dimensions, facts, marts ---------------------------------------------------

for _entity in sample.BRONZE:
    _tables(f"silver_{_entity}", lambda t, e=_entity: t.silver(e), f"select * from silver_{_entity}")

for _name in (
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "mart_sales_performance",
    "mart_product_performance",
    "mart_customer_rfm",
):
    _tables(_name, lambda t, n=_name: getattr(t, n)(), f"select * from {_name}")

_logs("mart_pipeline_quality", lambda t: t.mart_pipeline_quality(), "select * from mart_pipeline_quality")

# --- operators ----------------------------------------------------------------------------------

_tables(
    "typed_payments",
    lambda t: silver.typed("payments", t.bronze("payments")).select("order_id", "payment_sequential", "payment_value"),
    """select order_id, case when regexp_matches(payment_sequential, '^\\d+$')
      then cast(payment_sequential as bigint) end as payment_sequential,
      try_cast(payment_value as decimal(28,9)) as payment_value
    from bronze_payments where order_id is not null and trim(order_id) <> '' and payment_sequential is not null""",
)
_tables(
    "latest_per_key",
    lambda t: latest_per_key(t.bronze("payments"), ["order_id"]).select("order_id", "batch_id", "payment_value"),
    """select order_id, batch_id, payment_value from (select *, row_number() over (partition by order_id
      order by ingestion_timestamp desc nulls last, run_id desc) as position from bronze_payments) where position = 1""",
)
_tables(
    "global_rank",
    lambda t: global_rank(t.bronze("payments").select("order_id", "batch_id", "payment_installments"), "payment_installments"),
    """select order_id, batch_id, payment_installments,
      rank() over (order by payment_installments desc nulls last) as rank from bronze_payments""",
)
_tables(
    "items_per_order", lambda t: gold.items_per_order(t.silver("order_items")), "select * from items_agg"
)
_tables(
    "payments_per_order", lambda t: gold.payments_per_order(t.silver("payments")), "select * from payments_agg"
)
_tables(
    "inferred_members",
    lambda t: gold.inferred_customers(t.silver("orders"), t.silver("customers")),
    "select customer_id from inferred",
)
_tables(
    "customer_orders", lambda t: marts.customer_orders(t.fact_orders()), "select * from customer_orders"
)
_tables(
    "items_with_product",
    lambda t: joins.lookup_join(
        t.silver("order_items").select("order_id", "order_item_id", "product_id"),
        t.written("dim_product").select("product_id", "product_category_name"),
        "product_id",
    ),
    """select i.order_id, i.order_item_id, i.product_id, d.product_category_name
    from silver_order_items i left join dim_product d on i.product_id = d.product_id""",
)
_logs(
    "known_files",
    lambda t: t.log("file_upload_log")
    .join(
        t.log("file_upload_log").where("upload_status = 'SUCCESS'").select("file_hash").distinct(), "file_hash", "left_semi"
    )
    .select("upload_id", "file_hash", "upload_status"),
    """select upload_id, file_hash, upload_status from file_upload_log
    where file_hash in (select file_hash from file_upload_log where upload_status = 'SUCCESS')""",
)


def _after_delete(t: Tables) -> DataFrame:
    """Raw payments without two batches, in folders whose names are escaped or stand for NULL."""
    lake = Lake(t.spark, scratch_path(t.spark, "delete"))
    place = F.expr("if(payment_type = 'debit_card', null, concat('kind:', batch_id, '/', payment_type))").alias("place")
    payments = t.bronze("payments").select("order_id", "payment_sequential", "batch_id", "payment_type", place)
    lake.replace_partitions("bronze", "payments", payments, ("place",))
    gone = ["payments_initial", "payments_vouchers"]
    lake.delete_batches("bronze", "payments", gone, ("place",), payments.schema)
    return lake.read("bronze", "payments", payments.schema).drop("place")


_tables(
    "batch_delete",
    _after_delete,
    """select order_id, payment_sequential, batch_id, payment_type from bronze_payments
    where batch_id not in ('payments_initial', 'payments_vouchers')""",
)


def _written_back(df: DataFrame, **layout) -> DataFrame:
    lake = Lake(df.sparkSession, scratch_path(df.sparkSession, "layout"))
    lake.overwrite("gold", "layout", df, **layout)
    return lake.read("gold", "layout")


_logs(
    "day_partitioned_table",
    lambda t: _written_back(
        t.log("pipeline_run_log").withColumn("run_date", F.to_date("start_time")), day="run_date", cluster_by=("status",)
    ),
    "select *, cast(start_time as date) as run_date from pipeline_run_log",
)
_tables(
    "clustered_table",
    lambda t: _written_back(t.dim_product(), cluster_by=("product_category_name",), spread_by=("product_id",)),
    "select * from dim_product",
)


def _with_added_column(t: Tables) -> DataFrame:
    """A log written without a column, to which the column is added, and then rows that have it."""
    lake = Lake(t.spark, scratch_path(t.spark, "added"))
    log = t.log("file_upload_log")
    before, after = log.where("upload_status = 'SUCCESS'").drop("source_file_name"), log.where("upload_status <> 'SUCCESS'")
    lake.grow("audit", "file_upload_log", before.schema)
    lake.replace_partitions("audit", "file_upload_log", before, ("upload_status",))
    lake.add_column("audit", "file_upload_log", "source_file_name", T.StringType())
    lake.replace_partitions("audit", "file_upload_log", after, ("upload_status",))
    return lake.read("audit", "file_upload_log").select("upload_id", "upload_status", "source_file_name")


_logs(
    "added_column",
    _with_added_column,
    """select upload_id, upload_status, case when upload_status <> 'SUCCESS' then source_file_name end
      as source_file_name from file_upload_log""",
)

# --- file ingest --------------------------------------------------------------------------------

# What the landing zone holds, by upload: (entity, batch, rows) that load, with their source.
_LOADED = [(e, f"{e}_good", f"select count(*) from bronze_{e}") for e in sample.BRONZE] + [
    ("sellers", "sellers_quoted", "select count(*) from supplier"),
    ("products", "products_rated", "select count(*) from part"),
    ("customers", "customers_shared", "select count(*) from customer"),
]
_ORDER_COLUMNS = ", ".join(f"''{c}''" for c in ENTITIES["orders"].required_columns)
# (entity, batch, file, error) that don't load, and the text of what no rule foresees.
_REFUSED = [
    ("orders", "orders_wrong", "nations.csv", f"Missing required columns: [{_ORDER_COLUMNS}]"),
    ("orders", "orders_no_rows", "orders.csv", "CSV has header but no rows"),
    ("orders", "orders_empty", "orders.csv", "File is empty"),
    ("payments", "payments_wide", "payments.csv", f"Too many columns: at most {landing.MAX_COLUMNS} are allowed"),
    ("customers", "customers_latin", "customers.csv", "''utf-8'' codec can''t decode byte 0xe9: invalid continuation byte"),
    ("payments", "payments_missing", "none.csv", "File not found: " + sample.MISSING.tmp_file_path),
    ("sellers", "sellers_zipped", "sellers.csv.gz", "unexpected"),
]


def _plain_error(t: Tables, error: str = "error") -> Column:
    """An error without the folder of this session, and without the words of what is beyond the rules."""
    text = F.replace(F.col(error), F.lit(t.landed() + "/"), F.lit(""))
    foreseen = "^(Duplicate file|Missing required|CSV has|File is empty|File not found|Too many columns|.utf-8. codec)"
    return F.when(F.col(error).isNotNull() & ~F.col(error).rlike(foreseen), F.lit("unexpected")).otherwise(text)


def _loaded_sql(row: str) -> list[str]:
    return [row.format(entity=e, batch=b, rows=f"({n})") for e, b, n in _LOADED]


def _refused_sql(row: str, refused: list[tuple[str, ...]] = _REFUSED) -> list[str]:
    return [row.format(entity=e, batch=b, file=f, error=x, http=500 if x == "unexpected" else 400) for e, b, f, x in refused]


def _union(*rows: str) -> str:
    return " union all ".join(f"select {r}" for r in rows)


_UPLOADS_SQL = _union(
    *_loaded_sql("'{entity}' as table_name, '{batch}' as batch_id, 'SUCCESS' as upload_status, {rows} as rows_loaded, cast(null as varchar) as error_message"),
    f"'orders', 'orders_repeat', 'DUPLICATE', 0, '{ingest.DUPLICATE_MESSAGE}'",
    *_refused_sql("'{entity}', '{batch}', 'FAILED', 0, '{error}'"),
)
_tables(
    "bronze_ingest",
    lambda t: ingest.read_log(t.ingested(), "file_upload_log")
    .groupBy("table_name", "batch_id", "upload_status", _plain_error(t, "error_message").alias("error_message"))
    .agg(F.sum("row_count").alias("rows_loaded")),
    _UPLOADS_SQL,
)
for _entity in ENTITIES:
    # An empty cell of a CSV file is a missing value.
    _columns = ", ".join(f"nullif({c}, '') as {c}" for c in ENTITIES[_entity].required_columns)
    _more = {
        "sellers": "select 'q-' || s_suppkey, '00100', s_name || ', \"town\"', 'QQ', 'sellers_quoted', 'olist' from supplier",
        "products": "select 'r-' || p_partkey, 'rated'" + ", cast(null as varchar)" * 7 + ", 'products_rated', 'olist' from part",
        "customers": "select 's-' || c_custkey, 'person-' || c_custkey, '00200', 'shared', 'SH', 'customers_shared', "
        "case when c_custkey % 2 = 0 then 'olist' else 'partner' end from customer",
    }
    _tables(
        f"ingested_{_entity}",
        lambda t, e=_entity: ingest.read_bronze(t.ingested(), e).select(
            *ENTITIES[e].required_columns, "batch_id", "source_system"
        ),
        f"select {_columns}, '{_entity}_good' as batch_id, 'olist' as source_system from bronze_{_entity}"
        + (f" union all {_more[_entity]}" if _entity in _more else ""),
    )
_tables(
    "ingested_extra_columns",
    lambda t: union_by_name(
        ingest.read_bronze(t.ingested(), "sellers").select(F.col("seller_id").alias("key"), "batch_id", F.col("note__extra").alias("value")),
        ingest.read_bronze(t.ingested(), "products").select(F.col("product_id").alias("key"), "batch_id", F.col("rating").alias("value")),
    ),
    """select nullif(seller_id, '') as key, 'sellers_good' as batch_id, cast(null as varchar) as value from bronze_sellers
    union all select 'q-' || s_suppkey, 'sellers_quoted', s_name from supplier
    union all select product_id, 'products_good', null from bronze_products
    union all select 'r-' || p_partkey, 'products_rated', cast(p_size as varchar) from part""",
)
_tables(
    "rows_loaded",
    lambda t: ingest.rows_loaded(t.ingested(), "sample")
    .groupBy("table_name")
    .agg(F.sum("row_count").alias("row_count")),
    f"select table_name, sum(rows_loaded) as row_count from ({_UPLOADS_SQL}) where rows_loaded > 0 group by table_name",
)
_tables(
    "stream_ingest",
    lambda t: ingest.read_log(t.streamed(), "file_upload_log")
    .groupBy("table_name", "batch_id", "upload_status")
    .agg(F.sum("row_count").alias("rows_loaded")),
    f"select table_name, batch_id, upload_status, rows_loaded from ({_UPLOADS_SQL}) where batch_id <> 'payments_missing'",
)
_tables(
    "ingest_results",
    lambda t: t.ingest_results()
    .groupBy("batch_id", "table_name", "status", "reason", "bronze_table", "http_status", _plain_error(t).alias("error"))
    .agg(F.sum("row_count").alias("row_count"), F.min(F.col("file_hash").isNotNull()).alias("has_hash")),
    _union(
        *_loaded_sql(
            "'{batch}' as batch_id, '{entity}' as table_name, 'success' as status, cast(null as varchar) as reason, "
            "'bronze_{entity}' as bronze_table, 200 as http_status, cast(null as varchar) as error, {rows} as row_count, true as has_hash"
        ),
        "'orders_repeat', 'orders', 'skipped', 'duplicate_file', null, 200, null, 0, true",
        *_refused_sql("'{batch}', '{entity}', 'failed', null, null, {http}, '{error}', 0, false"),
    ),
)
_tables(
    "ingest_steps",
    lambda t: ingest.read_log(t.ingested(), "pipeline_run_log")
    .groupBy("batch_id", "pipeline_name", "step_name", "status", _plain_error(t, "error_message").alias("error_message"))
    .agg(
        # As many rows as files, and a clock on each.
        (F.count(F.lit(1)) == F.count_distinct("run_id")).alias("once_per_file"),
        F.min(F.col("end_time") >= F.col("start_time")).alias("timed"),
    ),
    "select batch_id, 'gcs_to_bronze_ingestion' as pipeline_name, step_name, status, error_message, true as once_per_file, true as timed from ("
    + _union(
        *[
            r
            for b in [b for _, b, _ in _LOADED] + ["orders_repeat"] + [r[1] for r in _REFUSED]
            for r in [f"'{b}' as batch_id, 'process_started' as step_name, 'STARTED' as status, cast(null as varchar) as error_message"]
        ],
        *_loaded_sql("'{batch}', 'bronze_load', 'SUCCESS', null"),
        *_loaded_sql("'{batch}', 'process_completed', 'SUCCESS', null"),
        "'orders_repeat', 'process_completed', 'SKIPPED', null",
        *_refused_sql("'{batch}', 'process_failed', 'FAILED', '{error}'"),
    )
    + ")",
)
_NO_BYTES = ("orders_empty", "payments_missing")
_tables(
    "ingest_checks",
    lambda t: ingest.read_log(t.ingested(), "data_quality_log")
    .groupBy("table_name", "batch_id", "check_name", "check_status")
    .agg(
        (F.count(F.lit(1)) == F.count_distinct("run_id")).alias("once_per_file"),
        F.sum(F.when(F.col("check_name") == "row_count_check", F.col("actual_value").cast("long"))).alias("counted_rows"),
        F.min(F.when(F.col("check_name") == "file_not_empty", F.col("actual_value").cast("long") > 0)).alias("bytes_seen"),
        F.max(F.when(F.col("check_name") == "file_validation", _plain_error(t, "actual_value"))).alias("error"),
        (F.sum("failed_count") / F.count(F.lit(1))).cast("long").alias("failed_per_file"),
    ),
    _union(
        *_loaded_sql(
            "'{entity}' as table_name, '{batch}' as batch_id, 'file_not_empty' as check_name, 'PASS' as check_status, true as once_per_file, "
            "cast(null as bigint) as counted_rows, true as bytes_seen, cast(null as varchar) as error, 0 as failed_per_file"
        ),
        *_loaded_sql("'{entity}', '{batch}', 'schema_validation', 'PASS', true, null, null, null, 0"),
        *_loaded_sql("'{entity}', '{batch}', 'row_count_check', 'PASS', true, {rows}, null, null, 0"),
        "'orders', 'orders_repeat', 'file_not_empty', 'PASS', true, null, true, null, 0",
        "'orders', 'orders_repeat', 'duplicate_file_check', 'FAILED', true, null, null, null, 1",
        *_refused_sql("'{entity}', '{batch}', 'file_validation', 'FAILED', true, null, null, '{error}', 1"),
        *_refused_sql(
            "'{entity}', '{batch}', 'file_not_empty', 'PASS', true, null, true, null, 0", [r for r in _REFUSED if r[1] not in _NO_BYTES]
        ),
    ),
)
_tables(
    "ingest_rejections",
    lambda t: ingest.read_log(t.ingested(), "rejected_records").select(
        "batch_id",
        "source_file_name",
        F.replace("gcs_uri", F.lit(t.landed() + "/"), F.lit("")).alias("place"),
        "rejection_level",
        _plain_error(t, "rejection_reason").alias("rejection_reason"),
        F.get_json_object("rejected_payload", "$.tmp_file_path").alias("asked_path"),
    ),
    _union(
        *_refused_sql(
            "'{batch}' as batch_id, '{file}' as source_file_name, 'rejected/source=olist/table={entity}/load_date=2002-01-01/batch_id={batch}/{file}' as place, "
            "'FILE' as rejection_level, '{error}' as rejection_reason, 'tmp/source=olist/table={entity}/upload_id={batch}/{file}' as asked_path"
        )
    ),
)
_tables(
    "ingest_events",
    lambda t: t.ingested()
    .read("audit", "events")
    .select("batch_id", "event", "severity", "status", "error_type", _plain_error(t, "error_message").alias("error_message"))
    .withColumn("error_type", F.when(F.col("status") < 500, F.col("error_type")))
    .distinct(),
    "select batch_id, event, severity, status, case when status = 400 then 'ValueError' end as error_type, error_message from ("
    + _union(
        *[
            r
            for event in ("pipeline_started", "schema_validation_passed", "bronze_load_completed", "pipeline_completed")
            for r in _loaded_sql(f"'{{batch}}' as batch_id, '{event}' as event, 'INFO' as severity, 200 as status, cast(null as varchar) as error_message")
        ],
        "'orders_repeat', 'pipeline_started', 'INFO', 200, null",
        "'orders_repeat', 'duplicate_file_detected', 'WARNING', 200, null",
        *_refused_sql("'{batch}', 'pipeline_started', 'INFO', {http}, '{error}'"),
        *[
            r
            for event in ("file_validation_failed", "file_rejected")
            for r in _refused_sql(f"'{{batch}}', '{event}', 'WARNING', 400, '{{error}}'", [r for r in _REFUSED if r[3] != "unexpected"])
        ],
        *_refused_sql("'{batch}', 'pipeline_failed', 'ERROR', 500, '{error}'", [r for r in _REFUSED if r[3] == "unexpected"]),
    )
    + ")",
)


def _zones(t: Tables) -> DataFrame:
    """The uploads whose files lie in the raw and the rejected zone."""
    path = F.col("tmp_file_path")
    found = union_by_name(*[landing.landed_files(t.spark, t.landed(), zone) for zone in ("raw", "rejected")])
    parts = [path_value(path, n).alias(n) for n in ("source", "table", "load_date", "batch_id")]
    return found.select(F.substring_index(path, "/", 1).alias("zone"), *parts).distinct()


_tables(
    "routed_files",
    lambda t: (t.ingested(), _zones(t))[1],
    "select zone, source, \"table\", '2002-01-01' as load_date, batch_id from ("
    + _union(
        *_loaded_sql("'raw' as zone, 'olist' as source, '{entity}' as \"table\", '{batch}' as batch_id"),
        "'raw', 'partner', 'customers', 'customers_shared'",
        *_refused_sql("'rejected', 'olist', '{entity}', '{batch}'", [r for r in _REFUSED if r[1] != "payments_missing"]),
    )
    + ")",
)
_LOG_IDS = {"file_upload_log": "upload_id", "data_quality_log": "check_id", "rejected_records": "rejected_id"}
_tables(
    "ingest_ids",
    lambda t: union_by_name(
        *[
            ingest.read_log(t.ingested(), log).agg(
                F.lit(log).alias("log"),
                (F.count(F.lit(1)) == F.count_distinct(key)).alias("told_apart"),
                F.min(F.col(key).rlike("^[0-9a-f]{64}$")).alias("well_formed"),
            )
            for log, key in _LOG_IDS.items()
        ]
    ),
    _union(*[f"'{log}' as log, true as told_apart, true as well_formed" for log in _LOG_IDS]),
)
_tables(
    "path_metadata",
    lambda t: union_by_name(*[t.bronze(e).select("gcs_uri") for e in sample.BRONZE])
    .select(
        path_value(F.col("gcs_uri"), "source").alias("source"),
        path_value(F.col("gcs_uri"), "table").alias("entity"),
        path_value(F.col("gcs_uri"), "batch_id").alias("batch"),
        path_value(F.col("gcs_uri"), "load_date").alias("load_day"),
        file_name(F.col("gcs_uri")).alias("file_name"),
    )
    .groupBy("source", "entity", "batch", "load_day", "file_name")
    .agg(F.count(F.lit(1)).alias("row_count")),
    f"""select source, entity, batch, cast(null as varchar) as load_day, file_name, count(*) as row_count from (
      select regexp_extract(gcs_uri, 'source=([^/]+)/', 1) as source,
        regexp_extract(gcs_uri, 'table=([^/]+)/', 1) as entity,
        regexp_extract(gcs_uri, 'batch_id=([^/]+)/', 1) as batch,
        regexp_extract(gcs_uri, '([^/]+)$', 1) as file_name
      from ({" union all ".join(f"select gcs_uri from bronze_{e}" for e in sample.BRONZE)}))
    group by all""",
)
_register(
    "upload_screening",
    """with uploads as (
      select case when p_brand = 'Brand#1' then 'other' else 'olist' end as source_system,
        case when p_type = 'PROMO' then 'widgets' when p_type = 'SMALL' then 'sellers' else 'orders' end as table_name,
        case when p_size = 2 then '' when p_size = 3 then p_name || '.txt'
          else 'in box/' || p_name || ' (' || p_partkey || ').CSV' end as file_name,
        (p_size - 1) * 3 as size_mb, substr(sha256(cast(p_partkey as varchar)), 1, 8) as short_hash
      from part),
    named as (
      select *, 'ui_20020101_000000_' || short_hash as batch_id,
        case when file_name = '' then 'uploaded_file_' || short_hash || '.csv'
          else regexp_replace(regexp_replace(file_name, '^.*/', ''), '[^\\pL\\pN_.-]', '_', 'g') end as source_file_name,
        case when source_system <> 'olist' then 'Only source_system=''olist'' is supported in v1.'
          when table_name = 'widgets' then 'Unsupported table_name: widgets'
          when file_name = '' then 'No file selected.'
          when not lower(file_name) like '%.csv' then 'Only .csv files are allowed.'
          when size_mb = 0 then 'Uploaded file is empty.'
          when size_mb > 100 then 'File size exceeds 100 MB limit.' end as reason
      from uploads)
    select reason, source_file_name, batch_id, case when reason is null then 'tmp/source=olist/table=' || table_name
      || '/upload_id=' || batch_id || '/' || source_file_name end as tmp_file_path
    from named""",
)(
    lambda t: landing.screen_uploads(
        sample.uploads(t.spark, t.sf_dir), F.lit(_AS_OF), SOURCE_SYSTEMS, tuple(ENTITIES), MAX_FILE_BYTES
    ).select("reason", "source_file_name", "batch_id", "tmp_file_path")
)
# --- rows set aside ------------------------------------------------------------------------------


def _set_aside(t: Tables) -> DataFrame:
    """Rows that loaded and rows that were set aside, from an upload in which some rows have a cell too many."""
    base = scratch_path(t.spark, "wide")
    rows = sample.read(t.spark, t.sf_dir, "supplier").select(
        F.expr("concat_ws(',', s_suppkey, '1', 'city', if(s_suppkey % 4 = 0, 'ST,surplus', 'ST'))").alias("value")
    )
    header = t.spark.range(1).select(F.lit(",".join(ENTITIES["sellers"].required_columns)).alias("value"))
    lines = header.withColumn("at", F.lit(0)).unionByName(rows.withColumn("at", F.lit(1))).coalesce(1).sortWithinPartitions("at")
    lines.select("value").write.text(f"{base}/tmp/source=olist/table=sellers/upload_id=wide")
    lake = Lake(t.spark, f"{base}/lake")
    ingest.ingest_landing(lake, base, "wide", _AS_OF, ingest.IngestOptions(wide_rows="quarantine"))
    good = ingest.read_bronze(lake, "sellers").select(F.col("seller_id").alias("key"), F.lit(None).cast("string").alias("reason"))
    bad = ingest.read_quarantine(lake).select(F.get_json_object("row", "$.seller_id").alias("key"), F.col("rejection_reason").alias("reason"))
    return good.unionByName(bad)


_tables(
    "ingest_set_aside",
    _set_aside,
    """select cast(s_suppkey as varchar) as key, case when s_suppkey % 4 = 0 then 'more fields than the header' end as reason
    from supplier""",
)

# --- operational queries ------------------------------------------------------------------------

_tables("bronze_row_count", lambda t: reports.total_rows(t.bronze("orders")), "select count(*) as total_rows from bronze_orders")
_tables(
    "rows_per_batch",
    lambda t: reports.rows_per(t.bronze("orders"), "batch_id"),
    "select batch_id, count(*) as row_count from bronze_orders group by batch_id",
)
_tables(
    "rows_per_source_file",
    lambda t: reports.rows_per(t.bronze("payments"), "source_file_name", largest_first=True),
    "select source_file_name, count(*) as row_count from bronze_payments group by source_file_name",
)
_tables(
    "lineage_sample",
    lambda t: reports.lineage_sample(t.bronze("orders")),
    """select batch_id, run_id, source_system, source_file_name, gcs_uri, file_hash, load_date, ingestion_timestamp
    from bronze_orders order by ingestion_timestamp desc, batch_id, run_id limit 10""",
)
_tables(
    "lineage_of_batch",
    lambda t: reports.lineage_sample(t.bronze("payments"), "payments_vouchers"),
    """select batch_id, run_id, source_system, source_file_name, gcs_uri, file_hash, load_date, ingestion_timestamp
    from bronze_payments where batch_id = 'payments_vouchers' order by ingestion_timestamp desc limit 10""",
)
_tables(
    "value_frequency",
    lambda t: reports.value_frequency(t.silver("orders"), "order_status"),
    "select order_status, count(*) as row_count from silver_orders group by order_status",
)
_tables(
    "total_vs_distinct",
    lambda t: reports.total_vs_distinct(t.bronze("orders"), "order_id"),
    "select count(*) as total_rows, count(distinct order_id) as distinct_keys from bronze_orders",
)
_tables(
    "table_row_counts",
    lambda t: reports.table_row_counts({f"silver_{e}": t.silver(e) for e in sample.BRONZE}),
    " union all ".join(
        f"select 'silver_{e}' as table_name, count(*) as row_count from silver_{e}" for e in sample.BRONZE
    ),
)
_tables(
    "having_duplicates",
    lambda t: checks.repeated_keys(t.bronze("order_items"), "order_id", "order_item_id"),
    """select order_id, order_item_id, count(*) as row_count from bronze_order_items
    group by order_id, order_item_id having count(*) > 1""",
)
_tables(
    "missing_parents",
    lambda t: reports.missing_parent_rows(t.silver("order_items"), "product_id", t.silver("products")),
    """select product_id as missing_key, count(*) as row_count from silver_order_items i
    where not exists (select 1 from silver_products p where p.product_id = i.product_id) group by product_id""",
)
_tables(
    "missing_parent_count",
    lambda t: reports.missing_parent_count(t.silver("order_items"), "seller_id", t.silver("sellers")),
    """select count(*) as missing_rows from silver_order_items i left join silver_sellers s
    on i.seller_id = s.seller_id where s.seller_id is null""",
)
_logs(
    "latest_uploads",
    lambda t: reports.latest_uploads(t.log("file_upload_log")),
    """select table_name, source_file_name, upload_status, row_count, error_message, created_at
    from file_upload_log order by created_at desc nulls last, upload_id limit 20""",
)
_logs(
    "latest_steps",
    lambda t: reports.latest_steps(t.log("pipeline_run_log")),
    """select batch_id, step_name, status, error_message, start_time
    from pipeline_run_log order by start_time desc nulls last, run_id limit 50""",
)
_logs(
    "latest_checks",
    lambda t: reports.latest_checks(t.log("data_quality_log")),
    """select batch_id, table_name, check_name, check_status, actual_value, failed_count, created_at
    from data_quality_log order by created_at desc nulls last, check_id limit 50""",
)
_logs(
    "latest_rejections",
    lambda t: reports.latest_rejections(t.log("rejected_records")),
    """select batch_id, source_file_name, gcs_uri, rejection_level, rejection_reason, created_at
    from rejected_records order by created_at desc nulls last, rejected_id limit 20""",
)
_logs(
    "batch_steps",
    lambda t: reports.batch_steps(t.log("pipeline_run_log"), "batch_7"),
    """select batch_id, step_name, status, error_message, start_time from pipeline_run_log
    where batch_id = 'batch_7'""",
)
_logs(
    "batch_trace",
    lambda t: reports.batch_trace(
        t.log("pipeline_run_log"), t.log("data_quality_log"), t.log("file_upload_log"), t.log("rejected_records")
    ),
    """select batch_id, run_id, 'pipeline_run_log' as log, step_name as entry, status, start_time as at
    from pipeline_run_log
    union all select batch_id, run_id, 'data_quality_log', check_name, check_status, created_at from data_quality_log
    union all select batch_id, run_id, 'file_upload_log', source_file_name, upload_status, created_at from file_upload_log
    union all select batch_id, run_id, 'rejected_records', rejection_reason, rejection_level, created_at
    from rejected_records""",
)
_logs(
    "events_named",
    lambda t: reports.events_named(t.events(), "pipeline_failed"),
    "select * from pipeline_events where event = 'pipeline_failed'",
)
_logs(
    "events_of_batch",
    lambda t: reports.events_of_batch(t.events(), "batch_7"),
    "select * from pipeline_events where batch_id = 'batch_7'",
)
_logs("server_errors", lambda t: reports.server_errors(t.events()), "select * from pipeline_events where status >= 500")

# --- data tests ---------------------------------------------------------------------------------

_tables(
    "dq_not_null",
    lambda t: checks.null_rows(t.silver("customers"), "customer_unique_id"),
    "select * from silver_customers where customer_unique_id is null",
)
_tables(
    "dq_non_negative",
    lambda t: checks.negative_rows(t.silver("products"), "product_weight_g"),
    "select * from silver_products where product_weight_g < 0",
)
_tables(
    "dq_unique",
    lambda t: checks.repeated_values(t.bronze("payments"), "order_id"),
    "select order_id, count(*) as row_count from bronze_payments group by order_id having count(*) > 1",
)
_tables(
    "dq_accepted_values",
    lambda t: checks.unaccepted_values(t.bronze("payments"), "payment_type", quality.PAYMENT_TYPES),
    """select payment_type as value_field, count(*) as n_records from bronze_payments
    where payment_type not in ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined') group by payment_type""",
)
_tables(
    "dq_relationships",
    lambda t: joins.missing_parents(t.silver("orders"), "customer_id", t.silver("customers"), "customer_id"),
    """select customer_id as missing_key, count(*) as row_count from silver_orders o
    where customer_id is not null and not exists
      (select 1 from silver_customers c where c.customer_id = o.customer_id) group by customer_id""",
)


def _rule_sql(model: str, test: str, column: str, failures: str) -> str:
    return f"select '{model}' as model, '{test}' as test, '{column}' as column_name, cast(({failures}) as bigint) as failures"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _tests_sql(tests: dict[str, checks.TableTests]) -> str:
    rows = []
    for model, t in tests.items():
        rows += [_rule_sql(model, "not_null", c, f"select count(*) from {model} where {c} is null") for c in t.not_null]
        rows += [_rule_sql(model, "non_negative", c, f"select count(*) from {model} where {c} < 0") for c in t.non_negative]
        rows += [
            _rule_sql(
                model, "accepted_values", c, f"select count(distinct {c}) from {model} where {c} not in ({_listed(v)})"
            )
            for c, v in t.accepted.items()
        ]
        rows += [
            _rule_sql(
                model,
                "unique",
                c,
                f"select count(*) from (select {c} from {model} where {c} is not null group by 1 having count(*) > 1)",
            )
            for c in t.unique
        ]
        rows += [
            _rule_sql(
                model,
                "unique_together",
                ",".join(cs),
                f"select count(*) from (select {', '.join(cs)} from {model} group by all having count(*) > 1)",
            )
            for cs in t.unique_together
        ]
        rows += [
            _rule_sql(
                model,
                "relationships",
                c,
                f"select count(*) from {model} m where {c} is not null and not exists "
                f"(select 1 from {parent} p where p.{key} = m.{c})",
            )
            for c, (parent, key) in t.parents.items()
        ]
    return f"select *, case when failures = 0 then 'PASS' else 'ERROR' end as status from ({' union all '.join(rows)})"


_GOLD_TABLE_TESTS = {n: t for n, t in quality.GOLD_TESTS.items() if n != "mart_pipeline_quality"}

_tables(
    "dq_silver_results",
    lambda t: checks.run_tests(quality.SILVER_TESTS, t.written),
    _tests_sql(quality.SILVER_TESTS),
)
_tables(
    "dq_gold_results",
    lambda t: checks.run_tests(_GOLD_TABLE_TESTS, Layers(t.spark, t.sf_dir).written),
    _tests_sql(_GOLD_TABLE_TESTS),
)
_logs(
    "dq_mart_quality_results",
    lambda t: checks.run_tests({"mart_pipeline_quality": quality.GOLD_TESTS["mart_pipeline_quality"]}, t.written),
    _tests_sql({"mart_pipeline_quality": quality.GOLD_TESTS["mart_pipeline_quality"]}),
)
_tables(
    "dq_summary",
    lambda t: checks.summarize(checks.run_tests(quality.SILVER_TESTS, t.written)),
    f"""select count(*) filter (status = 'PASS') as passed, count(*) filter (status = 'WARN') as warned,
      count(*) filter (status = 'ERROR') as failed, cast(0 as bigint) as skipped, count(*) as total
    from ({_tests_sql(quality.SILVER_TESTS)})""",
)
_tables(
    "freshness",
    lambda t: checks.freshness({e: t.bronze(e) for e in sample.BRONZE}, F.lit(_AS_OF), warn_after_hours=24 * 100),
    "select *, case when latest >= timestamp '2002-01-01 00:00:00' - interval 2400 hour then 'PASS' else 'WARN' end as status from ("
    + " union all ".join(
        f"select '{e}' as table_name, max(ingestion_timestamp) as latest from bronze_{e}" for e in sample.BRONZE
    )
    + ")",
)
_tables(
    "quarantined_rows",
    lambda t: checks.quarantine(
        silver.typed("order_items", t.bronze("order_items")),
        {"order_item_id": F.col("order_item_id").isNotNull(), "price": F.col("price") >= 5},
    )[1].select("order_id", "order_item_id", "price", "rejection_level", "rejection_reason"),
    """select order_id, order_item_id, price, 'ROW' as rejection_level,
      concat_ws('; ', case when order_item_id is null then 'order_item_id' end, case when price < 5 then 'price' end)
        as rejection_reason
    from (select order_id, case when regexp_matches(order_item_id, '^\\d+$') then cast(order_item_id as bigint) end
        as order_item_id, cast(price as decimal(28,9)) as price from bronze_order_items where trim(seller_id) <> '')
    where order_item_id is null or price < 5""",
)

# --- event counters and alerts, over a table and as streaming jobs ------------------------------

_FIVE = "time_bucket(interval 5 minute, timestamp)"
_WINDOW_SQL = f"{_FIVE} as window_start, {_FIVE} + interval 5 minute as window_end"

_WINDOWED: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "event_counts_5min": (
        stream_events.event_counts,
        f"""select {_WINDOW_SQL}, case event when 'pipeline_completed' then 'pipeline_success_count'
      when 'file_rejected' then 'rejected_file_count' else 'duplicate_file_count' end as metric, count(*) as n
    from pipeline_events where event in ('pipeline_completed', 'file_rejected', 'duplicate_file_detected')
    group by all""",
    ),
    "failure_alerts": (
        stream_events.failure_alerts,
        f"select {_WINDOW_SQL}, count(*) as n from pipeline_events where event = 'pipeline_failed' group by all",
    ),
    "server_error_alerts": (
        stream_events.server_error_alerts,
        f"select {_WINDOW_SQL}, count(*) as n from pipeline_events where status >= 500 group by all",
    ),
    "rejection_alerts": (
        lambda events: stream_events.rejection_alerts(events, threshold=1),
        f"""select {_WINDOW_SQL}, count(*) as n from pipeline_events where event = 'file_rejected'
    group by all having count(*) > 1""",
    ),
    "ops_series": (
        stream_events.ops_series,
        f"""select {_WINDOW_SQL}, count(*) as requests, count(*) filter (status >= 500) as errors,
      quantile_disc(duration_ms, 0.95) as p95_duration_ms
    from pipeline_events group by all""",
    ),
}
for _name, (_build, _sql) in _WINDOWED.items():
    _logs(_name, lambda t, f=_build: f(t.events()), _sql)
    _logs(f"stream_{_name}", lambda t, f=_build: t.event_windows(f), _sql)

# --- dashboard tiles ----------------------------------------------------------------------------

_tables(
    "kpi_totals",
    lambda t: reports.kpi_totals(t.fact_orders()),
    """select cast(count(*) as bigint) as total_orders, count(distinct customer_id) as total_customers,
      cast(sum(item_revenue) as decimal(38,9)) as item_revenue,
      cast(sum(gross_order_value) as decimal(38,9)) as gross_revenue,
      cast(sum(total_payment_value) as decimal(38,9)) as total_payments from fact_orders""",
)
_tables(
    "monthly_sales",
    lambda t: reports.monthly_sales(t.mart_sales_performance(), t.dim_date()),
    """select d.year, d.month, d.month_name, cast(sum(s.total_items_sold) as bigint) as total_items_sold,
      cast(sum(s.gross_revenue) as decimal(38,9)) as gross_revenue
    from mart_sales_performance s join dim_date d on s.order_purchase_date = d.date_key group by all""",
)
_tables(
    "status_split",
    lambda t: reports.status_split(t.fact_orders()),
    "select order_status, count(*) as total_orders from fact_orders group by order_status",
)
_tables(
    "customers_by_state",
    lambda t: reports.customers_by_state(t.dim_customer()),
    "select customer_state, count(*) as total_customers from dim_customer group by customer_state",
)
_tables(
    "segment_sizes",
    lambda t: reports.segment_sizes(t.mart_customer_rfm()),
    """select customer_segment, count(*) as total_customers, cast(sum(monetary_value) as decimal(38,9)) as monetary_value
    from mart_customer_rfm group by customer_segment""",
)
_tables(
    "top_products",
    lambda t: reports.top_products(t.mart_product_performance()),
    "select * from mart_product_performance order by revenue_rank, product_id limit 10",
)
_tables(
    "seller_performance",
    lambda t: reports.seller_performance(t.fact_order_items(), t.dim_seller()),
    """select f.seller_id, count(distinct f.order_id) as total_orders, count(*) as units_sold,
      cast(sum(f.gross_item_value) as decimal(38,9)) as gross_revenue, d.seller_city, d.seller_state
    from fact_order_items f left join dim_seller d on f.seller_id = d.seller_id
    group by f.seller_id, d.seller_city, d.seller_state""",
)
_tables(
    "category_revenue",
    lambda t: reports.category_revenue(t.mart_sales_performance()),
    """select product_category_name, cast(sum(total_items_sold) as bigint) as total_items_sold,
      cast(sum(gross_revenue) as decimal(38,9)) as gross_revenue
    from mart_sales_performance group by product_category_name""",
)
_logs(
    "pipeline_health",
    lambda t: reports.pipeline_health(t.mart_pipeline_quality()),
    "select "
    + ", ".join(
        f"cast(sum({c}) as bigint) as {c}"
        for c in marts.QUALITY_MEASURES
    )
    + " from mart_pipeline_quality",
)
