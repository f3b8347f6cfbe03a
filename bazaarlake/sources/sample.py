"""Raw commerce tables derived from a TPC-H-like sample (parquet folder).

The raw tables are all text with the flaws real uploads have: spare blanks, upper case, blank and
unknown keys, numbers that are not numbers, half dates, and rows delivered more than once. Every
row of every sample table is used.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ENTITIES, bronze_schema
from ..session import release_shuffles, scratch_path, scratch_scope
from .landing import UploadRequest, copy_files, landed_files

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of a sample table that one task takes on; the raw rows made of them are wide, and tasks sort them.
ROWS_PER_TASK = 250_000


def read_spread(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a table, dealt out by a hash of the whole row when it has fewer files than tasks.

    There is a task per core or, for large tables, per `ROWS_PER_TASK` rows, which the files tell without being read. The sample
    files hold few row groups each, which few tasks read alone. A table of many files is read as it is.
    """
    df = read(spark, sf_dir, table).select(*columns)
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(tasks, *columns) if len(df.inputFiles()) < tasks else df


def _txt(sql: str) -> Column:
    return F.expr(f"cast({sql} as string)")


def _raw(df: DataFrame, entity: str, columns: dict[str, Column], batch: str, clock: Column) -> DataFrame:
    """Select the landed columns, then stamp the lineage of ``batch`` ingested at ``clock``."""
    name = f"{batch}.csv"
    lineage = {
        "batch_id": F.lit(batch),
        "run_id": F.lit(f"run_{batch}"),
        "source_system": F.lit("olist"),
        "source_file_name": F.lit(name),
        "gcs_uri": F.lit(f"raw/source=olist/table={entity}/batch_id={batch}/{name}"),
        "file_hash": F.lit(hashlib.sha256(batch.encode()).hexdigest()),
        "load_date": F.to_date(clock).cast("string"),
        "ingestion_timestamp": clock.cast("timestamp"),
    }
    wanted = {**columns, **lineage}
    return df.select(*[wanted[f.name].alias(f.name) for f in bronze_schema(entity)])


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries per order: first as created, a day later with its final status."""
    src = read_spread(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    key = _txt("o_orderkey")
    placed = _txt("o_orderdate")
    # Orders of low priority come from guests, who are not in the customer file.
    customer = F.expr("if(o_orderpriority = '5-LOW', concat('guest-', o_orderkey), cast(o_custkey as string))")

    def days_later(days: str) -> str:
        return f"cast(o_orderdate + make_interval(0, 0, 0, cast({days} as int)) as string)"

    status = F.expr(
        "case o_orderstatus when 'F' then ' Delivered ' when 'O' then 'SHIPPED' else concat(chr(9), 'processing') end"
    )
    estimated = F.expr(days_later("20"))
    nothing = F.lit(None).cast("string")
    first = {
        "order_id": key,
        "customer_id": customer,
        "order_status": F.lit("created"),
        "order_purchase_timestamp": placed,
        "order_approved_at": nothing,
        "order_delivered_carrier_date": nothing,
        "order_delivered_customer_date": nothing,
        "order_estimated_delivery_date": estimated,
    }
    final = {
        **first,
        "order_status": status,
        "order_approved_at": F.expr("if(o_orderstatus = 'P', '2017', cast(o_orderdate as string))"),
        "order_delivered_carrier_date": F.expr(f"if(o_orderstatus = 'F', {days_later('3')}, '')"),
        "order_delivered_customer_date": F.expr(f"if(o_orderstatus = 'F', {days_later('o_orderkey % 40')}, '10:56:33')"),
    }
    clock = F.col("o_orderdate")
    return _raw(src, "orders", first, "orders_initial", clock).unionByName(
        _raw(src, "orders", final, "orders_final", F.expr("o_orderdate + interval 1 day"))
    )


def bronze_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; the sample repeats some (order, line) pairs."""
    src = read_spread(
        spark,
        sf_dir,
        "lineitem",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_returnflag",
        "l_shipdate",
    )
    columns = {
        "order_id": _txt("l_orderkey"),
        # A line number written as a float cannot be read as an integer.
        "order_item_id": F.expr("if(l_quantity = 50, concat(l_linenumber, '.0'), cast(l_linenumber as string))"),
        "product_id": _txt("l_partkey"),
        "seller_id": F.expr("if(l_returnflag = 'A' and l_tax = 0.08, '  ', cast(l_suppkey as string))"),
        "shipping_limit_date": _txt("l_shipdate"),
        "price": _txt("cast(l_extendedprice as decimal(18,2)) * cast(0.005 as decimal(4,3))"),
        "freight_value": _txt("cast(l_extendedprice as decimal(18,2)) * cast(0.0005 as decimal(5,4))"),
    }
    return _raw(src, "order_items", columns, "items_full", F.col("l_shipdate"))


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, corrected two days later; urgent orders also use a voucher."""
    src = read_spread(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    kind = F.expr(
        "case o_orderpriority when '1-URGENT' then 'CREDIT_CARD' when '2-HIGH' then ' boleto' "
        "when '3-MEDIUM' then 'Voucher ' when '4-NOT SPECIFIED' then 'not_defined' else 'debit_card' end"
    )
    value = "cast(cast(o_totalprice as decimal(18,2)) * cast(0.005 as decimal(4,3)) as string)"
    first = {
        "order_id": _txt("o_orderkey"),
        "payment_sequential": F.lit("1"),
        "payment_type": kind,
        "payment_installments": _txt("1 + o_orderkey % 12"),
        "payment_value": F.expr(value),
    }
    fixed = {**first, "payment_value": F.expr(f"if(o_orderstatus = 'P', 'pending', {value})")}
    voucher = {
        **first,
        "payment_sequential": F.lit("2"),
        "payment_type": F.lit("VOUCHER"),
        "payment_installments": F.lit("1.0"),
        "payment_value": F.lit("10.00"),
    }
    clock = F.col("o_orderdate")
    return (
        _raw(src, "payments", first, "payments_initial", clock)
        .unionByName(_raw(src, "payments", fixed, "payments_fixed", F.expr("o_orderdate + interval 2 days")))
        .unionByName(
            _raw(src.where("o_orderpriority = '1-URGENT'"), "payments", voucher, "payments_vouchers", clock)
        )
    )


_OLD = "timestamp_ntz'2001-08-01 06:00:00'"
_NEW = "timestamp_ntz'2001-09-01 06:00:00'"


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old and a new product list; the new one has some unusable ids and numbers."""
    src = read(spark, sf_dir, "part")
    new = {
        "product_id": F.expr("if(p_size = 50, '  ', cast(p_partkey as string))"),
        "product_category_name": F.expr(
            "case p_type when 'PROMO' then '  ' when 'LARGE' then cast(null as string) else concat(' ', p_type) end"
        ),
        "product_name_lenght": _txt("length(p_name)"),
        "product_description_lenght": F.expr("if(p_size > 40, concat(p_size, '.0'), cast(p_size * 10 as string))"),
        "product_photos_qty": _txt("p_size % 7"),
        "product_weight_g": F.expr("if(p_brand = 'Brand#7', 'abc', cast(p_size - 5 as string))"),
        "product_length_cm": _txt("cast(p_retailprice as decimal(18,2))"),
        "product_height_cm": F.lit("12.5"),
        "product_width_cm": F.lit(""),
    }
    # The old list knows no product of size 50.
    old = {**new, "product_category_name": F.lit("legacy")}
    return _raw(src, "products", old, "products_old", F.expr(_OLD)).unionByName(
        _raw(src, "products", new, "products_new", F.expr(_NEW))
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the nation as city; customers in debt have no person id."""
    src = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    columns = {
        "customer_id": _txt("c_custkey"),
        "customer_unique_id": F.expr("if(c_acctbal < 0, cast(null as string), concat('person-', c_custkey))"),
        "customer_zip_code_prefix": F.expr("lpad(cast(c_nationkey as string), 5, '0')"),
        "customer_city": F.expr("concat('  ', n_name, chr(9))"),
        "customer_state": F.expr("concat(lower(c_mktsegment), ' ')"),
    }
    return _raw(src, "customers", columns, "customers_full", F.expr(_NEW))


def bronze_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers with the nation as state; sellers in debt come without an id."""
    src = read(spark, sf_dir, "supplier").join(
        read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    columns = {
        "seller_id": F.expr("if(s_acctbal < 0, '', cast(s_suppkey as string))"),
        "seller_zip_code_prefix": F.expr("lpad(cast(s_nationkey as string), 5, '0')"),
        "seller_city": F.expr("upper(s_name)"),
        "seller_state": F.expr("concat(' ', lower(n_name))"),
    }
    return _raw(src, "sellers", columns, "sellers_full", F.expr(_NEW))


BRONZE = {
    "orders": bronze_orders,
    "customers": bronze_customers,
    "order_items": bronze_order_items,
    "products": bronze_products,
    "payments": bronze_payments,
    "sellers": bronze_sellers,
}


# --- landing zone -------------------------------------------------------------------------------

#: Files asked for that nobody landed.
MISSING = UploadRequest("olist", "payments", "tmp/source=olist/table=payments/upload_id=payments_missing/none.csv", "payments_missing")


def _upload(df: DataFrame, root: str, source: str, entity: str, upload: str, name: str, text: bool = False, **options) -> None:
    """Land the parts of ``df`` as files of one upload, named ``name`` with ``{n}`` for the number of the part."""
    spark = df.sparkSession
    # Blanks around values are kept.
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "header": "true", "escape": '"'} | options
    with scratch_scope(spark):
        base = scratch_path(spark, "upload")
        if text:
            df.write.text(f"{base}/parts")
        else:
            df.write.options(**kept).csv(f"{base}/parts")
        parts = landed_files(spark, base, "parts").where(F.col("tmp_file_path").rlike("/part-[^/]*$"))
        number = F.regexp_extract("tmp_file_path", "/part-(\\d+)", 1)
        stem, _, end = name.partition("{n}")
        target = F.concat(F.lit(f"{root}/tmp/source={source}/table={entity}/upload_id={upload}/{stem}"), *([number, F.lit(end)] if end else []))
        copied = copy_files(parts.select(F.concat(F.lit(f"{base}/"), "tmp_file_path").alias("source"), target.alias("target")))
        lost = copied.where("error is not null").first()
    if lost:
        raise OSError(lost.error)


def quoted_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers in another column order, with a name that holds a comma."""
    return read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("note, extra"),
        F.expr("concat('q-', s_suppkey)").alias("seller_id"),
        F.lit("QQ").alias("seller_state"),
        F.expr("concat(s_name, ', \"town\"')").alias("seller_city"),
        F.lit("00100").alias("seller_zip_code_prefix"),
    )


def rated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a column that no other file has."""
    columns = {c: F.lit(None).cast("string") for c in ENTITIES["products"].required_columns}
    columns |= {"product_id": F.expr("concat('r-', p_partkey)"), "product_category_name": F.lit("rated"), "rating": _txt("p_size")}
    return read(spark, sf_dir, "part").select(*[c.alias(n) for n, c in columns.items()])


def shared_customers(spark: SparkSession, sf_dir: str, remainder: int) -> DataFrame:
    """Half of the customers, under new ids."""
    return read(spark, sf_dir, "customer").where(F.col("c_custkey") % 2 == remainder).select(
        F.expr("concat('s-', c_custkey)").alias("customer_id"),
        F.expr("concat('person-', c_custkey)").alias("customer_unique_id"),
        F.lit("00200").alias("customer_zip_code_prefix"),
        F.lit("shared").alias("customer_city"),
        F.lit("SH").alias("customer_state"),
    )


def land(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the raw tables as uploaded CSV files below ``root``, in all the ways that files arrive.

    Besides one good upload per entity: a copy of the orders (a duplicate); sellers in another column order under a quoted name;
    products with an extra column; customers under one file name from two sources; and files that can't load: nations sent as orders
    (missing columns), a header without rows, a file without bytes, one of 10,000 columns, one that isn't UTF-8 and one whose name says
    it is compressed, which it isn't.
    """

    def folder(entity: str, upload: str) -> str:
        return f"tmp/source=olist/table={entity}/upload_id={upload}"

    def lines(df: DataFrame, header: str, row: Column) -> DataFrame:
        """The header and a line per row, in this order, in one file; for tables of fixed size."""
        head = spark.range(1).select(F.lit(header).alias("value"), F.lit(0).alias("at"))
        body = df.select(row.alias("value"), F.lit(1).alias("at"))
        return head.unionByName(body).coalesce(1).sortWithinPartitions("at").select("value")

    for entity, build in BRONZE.items():
        rows = build(spark, sf_dir).select(*ENTITIES[entity].required_columns)
        writer = rows.write.option("header", "true").option("maxRecordsPerFile", 400_000)
        writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        writer.csv(f"{root}/{folder(entity, f'{entity}_good')}")
    good = spark.read.format("binaryFile").load(f"{root}/{folder('orders', 'orders_good')}").select("path")
    again = F.replace(F.col("path"), F.lit("/upload_id=orders_good/"), F.lit("/upload_id=orders_repeat/"))
    copy_files(good.select(F.col("path").alias("source"), again.alias("target")), linked=True)

    _upload(quoted_sellers(spark, sf_dir), root, "olist", "sellers", "sellers_quoted", "sellers-{n}.csv")
    _upload(rated_products(spark, sf_dir), root, "olist", "products", "products_rated", "products-{n}.csv")
    for remainder, source in enumerate(("olist", "partner")):
        _upload(shared_customers(spark, sf_dir, remainder), root, source, "customers", "customers_shared", "customers-{n}.csv")

    nation, region = read(spark, sf_dir, "nation").coalesce(1), read(spark, sf_dir, "region").coalesce(1)
    _upload(nation, root, "olist", "orders", "orders_wrong", "nations.csv")
    header = ",".join(ENTITIES["orders"].required_columns)
    _upload(lines(region.limit(0), header, F.lit("")), root, "olist", "orders", "orders_no_rows", "orders.csv", text=True)
    _upload(region.limit(0).coalesce(1).select("r_name"), root, "olist", "orders", "orders_empty", "orders.csv", text=True)
    wide = ",".join([*ENTITIES["payments"].required_columns, *[f"c{i}" for i in range(10_000)]])
    _upload(lines(region, wide, _txt("r_regionkey")), root, "olist", "payments", "payments_wide", "payments.csv", text=True)
    names = {c: F.expr("concat(n_name, '\u00e9')") for c in ENTITIES["customers"].required_columns}
    latin = nation.select(*[c.alias(n) for n, c in names.items()])
    _upload(latin, root, "olist", "customers", "customers_latin", "customers.csv", encoding="ISO-8859-1")
    zipped = lines(region, ",".join(ENTITIES["sellers"].required_columns), F.expr("concat(r_regionkey, ',1,a,A')"))
    _upload(zipped, root, "olist", "sellers", "sellers_zipped", "sellers.csv.gz", text=True)
    release_shuffles(spark)


# --- audit logs and events ----------------------------------------------------------------------
# Every event becomes a row of exactly one log. Some rows have no time, and no log covers all days,
# so the joins of the quality mart have unmatched sides.


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumns(
        {
            "run_id": F.expr("concat('run_', user_id)"),
            "batch_id": F.expr("concat('batch_', user_id)"),
            "at": F.expr("cast(if(value < 0.5, null, ts) as timestamp)"),
        }
    )


def pipeline_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .where("event_type in ('view', 'click')")
        .select(
            "run_id",
            "batch_id",
            F.lit("gcs_to_bronze_ingestion").alias("pipeline_name"),
            F.expr("if(event_type = 'click', 'bronze_load', if(value < 5, 'process_failed', 'process_started'))").alias(
                "step_name"
            ),
            F.expr("if(event_type = 'click', 'SUCCESS', if(value < 5, 'FAILED', 'STARTED'))").alias("status"),
            F.col("at").alias("start_time"),
            F.col("at").alias("end_time"),
            F.expr("if(event_type = 'view' and value < 5, 'File is empty', cast(null as string))").alias("error_message"),
        )
    )


def data_quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .where("event_type = 'signup' and day(ts) <= 20")
        .select(
            F.expr("concat('check_', event_id)").alias("check_id"),
            "run_id",
            "batch_id",
            F.lit("orders").alias("table_name"),
            F.expr("if(value < 10, 'file_validation', 'row_count_check')").alias("check_name"),
            F.expr("if(value < 10, 'FAILED', 'PASS')").alias("check_status"),
            F.lit("row_count > 0").alias("expected_value"),
            F.col("props").alias("actual_value"),
            F.expr("if(value < 10, 1L, 0L)").alias("failed_count"),
            F.col("at").alias("created_at"),
        )
    )


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .where("event_type = 'error' and day(ts) >= 10")
        .select(
            F.expr("concat('rejected_', event_id)").alias("rejected_id"),
            "run_id",
            "batch_id",
            F.lit("orders.csv").alias("source_file_name"),
            F.lit("rejected/orders.csv").alias("gcs_uri"),
            F.lit("FILE").alias("rejection_level"),
            F.lit("File is empty").alias("rejection_reason"),
            F.col("props").alias("rejected_payload"),
            F.col("at").alias("created_at"),
        )
    )


def file_upload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .where(
            "event_type = 'purchase' or (event_type = 'signup' and day(ts) > 20) or (event_type = 'error' and day(ts) < 10)"
        )
        .select(
            F.expr("concat('upload_', event_id)").alias("upload_id"),
            "run_id",
            "batch_id",
            F.lit("olist").alias("source_system"),
            F.expr("if(event_type = 'purchase', 'orders', 'payments')").alias("table_name"),
            F.expr("concat(event_type, '.csv')").alias("source_file_name"),
            F.expr("concat('raw/', event_type, '.csv')").alias("gcs_uri"),
            # The same content arrives again and again.
            F.expr("if(event_type = 'error', 'UNKNOWN', sha2(cast(cast(floor(value) as bigint) as string), 256))").alias(
                "file_hash"
            ),
            F.expr("if(event_type = 'purchase', event_id, 0L)").alias("row_count"),
            F.expr(
                "case event_type when 'purchase' then 'SUCCESS' when 'signup' then 'DUPLICATE' else 'FAILED' end"
            ).alias("upload_status"),
            F.col("at").alias("created_at"),
            F.expr("if(event_type = 'error', 'File is empty', cast(null as string))").alias("error_message"),
        )
    )


AUDIT = {
    "pipeline_run_log": pipeline_run_log,
    "data_quality_log": data_quality_log,
    "file_upload_log": file_upload_log,
    "rejected_records": rejected_records,
}


def pipeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log events of the ingest service."""
    return _as_events(read(spark, sf_dir, "events"))


def pipeline_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream of files."""
    schema = read(spark, sf_dir, "events").schema
    return _as_events(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def _as_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.expr("cast(ts as timestamp)").alias("timestamp"),
        F.expr(
            "case event_type when 'purchase' then 'pipeline_completed' when 'signup' then 'pipeline_started' "
            "when 'click' then 'duplicate_file_detected' when 'view' then 'file_rejected' else 'pipeline_failed' end"
        ).alias("event"),
        F.expr("case event_type when 'error' then 500 when 'view' then 400 else 200 end").cast("bigint").alias("status"),
        F.expr("concat('run_', user_id)").alias("run_id"),
        F.expr("concat('batch_', user_id)").alias("batch_id"),
        F.expr("cast(cast(value as decimal(18,2)) * 1000 as bigint)").alias("duration_ms"),
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files offered for upload, one per part, many of them not acceptable."""
    return read(spark, sf_dir, "part").select(
        F.expr("if(p_brand = 'Brand#1', 'other', 'olist')").alias("source_system"),
        F.expr("if(p_type = 'PROMO', 'widgets', lower(if(p_type = 'SMALL', 'sellers', 'orders')))").alias("table_name"),
        F.expr(
            "case when p_size = 2 then cast(null as string) when p_size = 3 then concat(p_name, '.txt') "
            "else concat('in box/', p_name, ' (', p_partkey, ').CSV') end"
        ).alias("file_name"),
        F.expr("cast(p_size - 1 as bigint) * 3 * 1024 * 1024").alias("size_bytes"),
        F.expr("sha2(cast(p_partkey as string), 256)").alias("file_hash"),
    )
