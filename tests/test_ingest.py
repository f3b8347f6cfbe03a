import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from bazaarlake import registry
from bazaarlake.contracts import ENTITIES, SOURCE_SYSTEMS
from bazaarlake.plans import ingest, pipeline, quality
from bazaarlake.session import shared_dir
from bazaarlake.sources import landing
from bazaarlake.sources.landing import UploadRequest

AT = dt.datetime(2024, 1, 2, 3, 4, 5)
HEADER = ",".join(ENTITIES["orders"].required_columns)
GOOD = f'{HEADER}\n1,c1,delivered,2017-10-02 10:56:33,,,,\n2,c2,"ship\n""ped""",2017-10-03,,,,\n'


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "landing")


def put(root, table, batch, name, content):
    folder = f"{root}/tmp/source=olist/table={table}/upload_id={batch}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(content)
    return UploadRequest("olist", table, f"tmp/source=olist/table={table}/upload_id={batch}/{name}", batch)


def outcome(result):
    return {r.batch_id: (r.status, r.error or r.reason) for r in result.collect()}


def test_verdicts(lake, root, rows):
    requests = [
        put(root, "orders", "good", "a.csv", GOOD),
        put(root, "orders", "copy", "b.csv", GOOD),
        put(root, "orders", "bad", "bad.csv", "wrong_col_1,wrong_col_2\n1,test\n2,test\n"),
        put(root, "orders", "no_rows", "h.csv", HEADER + "\n"),
        put(root, "orders", "zero", "z.csv", ""),
        put(root, "orders", "blank", "l.csv", "\n\n"),
        put(root, "orders", "ragged", "r.csv", HEADER + "\n1,2,3,4,5,6,7,8,9\n"),
        put(root, "widgets", "entity", "w.csv", "a\n1\n"),
        put(root, "sellers", "moved", "with space.csv", "\ufeffseller_state,more,seller_id,seller_city,"
            "seller_zip_code_prefix\r\n SP ,x,s1,Sao Paulo,01409\r\n"),
        UploadRequest("olist", "orders", "tmp/source=olist/table=orders/upload_id=none/x.csv", "none"),
    ]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    missing = "Missing required columns: " + str(ENTITIES["orders"].required_columns)
    assert got == {
        "good": ("success", None),
        "copy": ("skipped", "duplicate_file"),
        "bad": ("failed", missing),
        "no_rows": ("failed", "CSV has header but no rows"),
        "zero": ("failed", "File is empty"),
        "blank": ("failed", "No columns to parse from file"),
        "ragged": ("failed", "Error tokenizing data: a row has more fields than the header"),
        "entity": ("failed", "Unsupported table_name: widgets"),
        "moved": ("success", None),
        "none": ("failed", f"File not found: {root}/tmp/source=olist/table=orders/upload_id=none/x.csv"),
    }

    # Raw rows: bound by name, quoted line breaks kept, missing values are NULL.
    assert rows(ingest.read_bronze(lake, "orders"), "order_id", "order_status", "order_approved_at") == [
        ("1", "delivered", None),
        ("2", 'ship\n"ped"', None),
    ]
    seller = ingest.read_bronze(lake, "sellers").first()
    assert (seller.seller_zip_code_prefix, seller.seller_state, seller.source_file_name) == (
        "01409",
        " SP ",
        "with space.csv",
    )
    assert (seller.batch_id, seller.load_date, seller.source_system) == ("moved", "2024-01-02", "olist")
    assert len(seller.file_hash) == 64

    # Files: copies in their zone, nothing for duplicates and missing files.
    def batches(zone):
        return {r[0].split("batch_id=")[1].split("/")[0] for r in landing.landed_files(lake.spark, root, zone).collect()}

    moved, rejected = batches("raw"), batches("rejected")
    assert moved == {"good", "moved"}
    assert rejected == {"bad", "no_rows", "zero", "blank", "ragged", "entity"}
    with open(f"{root}/raw/source=olist/table=orders/load_date=2024-01-02/batch_id=good/a.csv") as f:
        assert f.read() == GOOD

    # Logs.
    steps = ingest.read_log(lake, "pipeline_run_log")
    assert rows(steps.where("batch_id = 'good'"), "step_name", "status") == [
        ("bronze_load", "SUCCESS"),
        ("process_completed", "SUCCESS"),
        ("process_started", "STARTED"),
    ]
    assert rows(steps.where("batch_id = 'copy'"), "step_name", "status") == [
        ("process_completed", "SKIPPED"),
        ("process_started", "STARTED"),
    ]
    assert rows(steps.where("batch_id = 'zero'"), "step_name", "status", "error_message") == [
        ("process_failed", "FAILED", "File is empty"),
        ("process_started", "STARTED", None),
    ]
    tests = ingest.read_log(lake, "data_quality_log")
    assert rows(tests.where("batch_id = 'good'"), "check_name", "check_status", "failed_count") == [
        ("file_not_empty", "PASS", 0),
        ("row_count_check", "PASS", 0),
        ("schema_validation", "PASS", 0),
    ]
    assert rows(tests.where("batch_id = 'copy'"), "check_name", "check_status", "failed_count") == [
        ("duplicate_file_check", "FAILED", 1),
        ("file_not_empty", "PASS", 0),
    ]
    assert rows(tests.where("batch_id = 'zero'"), "check_name", "actual_value") == [("file_validation", "File is empty")]
    uploads = ingest.read_log(lake, "file_upload_log")
    assert uploads.count() == len(requests)
    assert rows(uploads.where("batch_id in ('good', 'copy', 'bad')"), "batch_id", "upload_status", "row_count") == [
        ("bad", "FAILED", 0),
        ("copy", "DUPLICATE", 0),
        ("good", "SUCCESS", 2),
    ]
    assert uploads.where("batch_id = 'bad'").first().file_hash == "UNKNOWN"
    refused = ingest.read_log(lake, "rejected_records").where("batch_id = 'bad'").first()
    assert (refused.rejection_level, refused.rejection_reason) == ("FILE", missing)
    assert json.loads(refused.rejected_payload) == {
        "bucket_name": root,
        "source_system": "olist",
        "table_name": "orders",
        "tmp_file_path": "tmp/source=olist/table=orders/upload_id=bad/bad.csv",
        "batch_id": "bad",
    }
    events = lake.read("audit", "events")
    assert rows(events.where("batch_id = 'bad'"), "event", "severity", "status") == [
        ("file_rejected", "WARNING", 400),
        ("file_validation_failed", "WARNING", 400),
        ("pipeline_started", "INFO", 400),
    ]
    assert json.loads(events.first().json)["service"] == "ingestion-service"

    # The same batch again replaces its rows.
    ingest.ingest_batch(lake, root, requests, "i1", AT)
    assert ingest.read_bronze(lake, "orders").count() == 2
    assert ingest.read_log(lake, "file_upload_log").count() == len(requests)
    assert rows(ingest.rows_loaded(lake, "i1"), "table_name", "row_count") == [("orders", 2), ("sellers", 1)]

    # Known content in a later batch is skipped; everything else was logged and is not pending.
    put(root, "orders", "later", "c.csv", GOOD)
    (later,) = ingest.ingest_landing(lake, root, "i2", AT)
    assert outcome(later) == {"later": ("skipped", "duplicate_file")}
    assert ingest.ingest_landing(lake, root, "i3", AT) == []


def test_first_good_copy_loads(lake, root):
    """Equal content sent under a wrong entity first does not block the right upload."""
    requests = [
        put(root, "customers", "wrong", "a.csv", GOOD),
        put(root, "orders", "right", "a.csv", GOOD),
        put(root, "customers", "after", "a.csv", GOOD),
    ]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert [got[b][0] for b in ("wrong", "right", "after")] == ["failed", "success", "skipped"]


def test_size_limit_and_batch_bound(lake, root):
    requests = [put(root, "orders", "big", "a.csv", GOOD), put(root, "orders", "b2", "b.csv", GOOD + "3,,,,,,,\n")]
    options = ingest.IngestOptions(max_bytes=10)
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT, options))
    assert got["big"] == ("failed", "File size exceeds 0 MB limit.")
    with pytest.raises(ValueError):
        ingest.ingest_batch(lake, root, requests, "i2", AT, ingest.IngestOptions(max_files=1))
    parts = ingest.ingest_landing(lake, root, "i3", AT, ingest.IngestOptions(max_files=1))
    assert parts == []


def test_files_above_100_mib_load(lake, root):
    """The size limit is one of the upload form; landed files of any size load and are hashed whole."""
    wide = "x" * (1 << 12)
    content = HEADER + "\n" + "".join(f"{i},{wide},delivered,2024-01-02,,,,\n" for i in range(101 << 8))
    requests = [put(root, "orders", "big", "a.csv", content), put(root, "orders", "copy", "b.csv", content)]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert got == {"big": ("success", None), "copy": ("skipped", "duplicate_file")}
    loaded = ingest.read_bronze(lake, "orders")
    assert loaded.where(F.length("customer_id") == 1 << 12).count() == 101 << 8
    assert loaded.first().file_hash == hashlib.sha256(content.encode()).hexdigest()


def test_many_copies_of_one_content(lake, root):
    requests = [put(root, "orders", f"b{i:02d}", "a.csv", GOOD) for i in range(30)]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert got["b00"][0] == "success"
    assert {got[f"b{i:02d}"][0] for i in range(1, 30)} == {"skipped"}
    assert ingest.read_bronze(lake, "orders").count() == 2


def test_unexpected_failure_is_logged(lake, root, monkeypatch, rows):
    requests = [put(root, "orders", "b1", "a.csv", GOOD)]

    def broken(*_):
        raise RuntimeError("disk gone")

    monkeypatch.setattr(landing, "copy_files", broken)
    with pytest.raises(RuntimeError):
        ingest.ingest_batch(lake, root, requests, "i1", AT)
    assert rows(lake.read("audit", "events"), "event", "severity", "status", "error_type", "error_message") == [
        ("pipeline_failed", "ERROR", 500, "RuntimeError", "disk gone"),
        ("pipeline_started", "INFO", 500, "RuntimeError", "disk gone"),
    ]
    assert rows(ingest.read_log(lake, "pipeline_run_log"), "step_name", "status") == [
        ("process_failed", "FAILED"),
        ("process_started", "STARTED"),
    ]
    for log in ("rejected_records", "data_quality_log", "file_upload_log"):
        assert ingest.read_log(lake, log).count() == 1
    # Nothing of it stays, and the file is taken up again.
    assert ingest.read_bronze(lake, "orders").count() == 0
    monkeypatch.undo()
    (again,) = ingest.ingest_landing(lake, root, "i2", AT)
    assert outcome(again) == {"b1": ("success", None)}


def test_delete_batches(lake, root, rows):
    requests = [
        put(root, "orders", "keep", "a.csv", GOOD),
        put(root, "orders", "drop", "b.csv", GOOD.replace("c1", "c9")),
    ]
    ingest.ingest_batch(lake, root, requests, "i1", AT)
    ingest.ingest_batch(lake, root, [put(root, "orders", "drop2", "c.csv", GOOD.replace("c1", "c8"))], "i2", AT)
    assert ingest.read_bronze(lake, "orders").count() == 6
    ingest.delete_batches(lake, "orders", ["drop", "drop2"])
    left = ingest.read_bronze(lake, "orders")
    assert rows(left, "order_id", "batch_id") == [("1", "keep"), ("2", "keep")]


SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_headers_by_csv_rules(lake, root, rows):
    """Quoted names, names that can't be columns, repeated ones and lineage names, in files of different layouts."""
    requests = [
        put(root, "sellers", "quoted", "q.csv", '"note, extra",seller_id,seller_city,seller_state,seller_zip_code_prefix\n"a, b",01,sp,SP,001\n'),
        put(root, "sellers", "rated", "r.csv", "seller_id,rating,seller_zip_code_prefix,seller_city,seller_state\n02,5,002,rio,RJ\n"),
        put(root, "sellers", "plain", "p.csv", SELLERS + "03,003,ilheus,BA\n"),
        put(root, "sellers", "odd", "o.csv", SELLERS.strip() + ',Rating,rating,,batch_id,"a\nb","say ""hi"""\n04,004,x,Y,1,2,3,mine,5,6\n'),
    ]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert set(got.values()) == {("success", None)}
    bronze = ingest.read_bronze(lake, "sellers")
    assert rows(bronze, "seller_id", "seller_city", "seller_state", "seller_zip_code_prefix") == [
        ("01", "sp", "SP", "001"),
        ("02", "rio", "RJ", "002"),
        ("03", "ilheus", "BA", "003"),
        ("04", "x", "Y", "004"),
    ]
    assert rows(bronze, "seller_id", "note__extra", "rating") == [("01", "a, b", None), ("02", None, "5"), ("03", None, None), ("04", None, "1")]
    odd = bronze.where("seller_id = '04'").first()
    assert (odd.rating_1, odd.column_6, odd.a_b, odd.say__hi_, odd.batch_id) == ("2", "3", "5", "6", "odd")
    # A later file without them reads NULL.
    ingest.ingest_batch(lake, root, [put(root, "sellers", "later", "l.csv", SELLERS + "05,005,z,Z\n")], "i2", AT)
    assert rows(ingest.read_bronze(lake, "sellers").where("batch_id = 'later'"), "seller_id", "rating") == [("05", None)]


def test_column_names():
    required = ["a", "b"]
    assert ingest.column_names(["b", "A", "a", "a", None, "load_date", "__file", "x y", "x_y"], required) == [
        "b", "A_1", "a", "a_2", "column_4", None, None, "x_y", "x_y_1"
    ]


def test_refused_contents(lake, root, monkeypatch):
    """Too many columns, bytes that aren't UTF-8 and a header without end fail alone, beside a file that loads."""
    monkeypatch.setattr(landing, "MAX_HEADER_BYTES", 1 << 16)
    folder = f"{root}/tmp/source=olist/table=sellers/upload_id=latin"
    os.makedirs(folder)
    with open(f"{folder}/l.csv", "wb") as f:
        f.write((SELLERS + "01,001,s\xe3o paulo,SP\n").encode("latin-1"))
    wide = ",".join(f"c{i}" for i in range(10_000))
    requests = [
        UploadRequest("olist", "sellers", "tmp/source=olist/table=sellers/upload_id=latin/l.csv", "latin"),
        put(root, "sellers", "wide", "w.csv", SELLERS.strip() + "," + wide.replace("c", "") + "\n1,2,3,4\n"),
        put(root, "sellers", "endless", "e.csv", "x" * (1 << 17)),
        put(root, "sellers", "half_wide", "h.csv", SELLERS.strip() + "," + ",".join(f"c{i}" for i in range(200)) + "\n1,2,3,4\n"),
        put(root, "sellers", "good", "a [1]{2}*.csv", SELLERS + "1,2,3,4\n"),
    ]
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert got == {
        "latin": ("failed", "'utf-8' codec can't decode byte 0xe3: invalid continuation byte"),
        "wide": ("failed", f"Too many columns: at most {landing.MAX_COLUMNS} are allowed"),
        "endless": ("failed", "Header line does not end within 65536 bytes"),
        "half_wide": ("success", None),
        "good": ("success", None),
    }
    bronze = ingest.read_bronze(lake, "sellers")
    assert bronze.count() == 2 and "c199" in bronze.columns


def test_large_files_are_split(lake, root):
    """A file without quoted line breaks is read by several tasks; one with them is not, and both load."""
    spark = lake.spark
    lines = "".join(f"{i},{i:05d},city {i},ST\n" for i in range(60_000))
    plain = put(root, "sellers", "plain", "p.csv", SELLERS + lines)
    quoted = put(root, "sellers", "quoted", "q.csv", SELLERS + '0,0,"two\nlines",ST\n' + lines)
    prints = landing.fingerprints(spark, root, landing.requests_frame(spark, [plain, quoted]))
    assert {r.tmp_file_path: r.multi_line for r in prints.collect()} == {plain.tmp_file_path: False, quoted.tmp_file_path: True}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200KB")
    try:
        names = ENTITIES["sellers"].required_columns
        assert landing.read_rows(spark, root, [plain.tmp_file_path], names, False).rdd.getNumPartitions() > 4
        got = outcome(ingest.ingest_batch(lake, root, [plain, quoted], "i1", AT))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(got.values()) == {("success", None)}
    counts = ingest.read_bronze(lake, "sellers").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {"plain": 60_000, "quoted": 60_001}


def test_same_name_from_other_folders(lake, root):
    """Files are told apart by their whole path: another source, another folder of the same batch name."""
    put(root, "sellers", "b1", "s.csv", SELLERS + "1,1,a,A\n")
    other = f"{root}/tmp/source=partner/table=sellers/upload_id=b1"
    again = f"{root}/tmp/again/source=olist/table=sellers/upload_id=b1"
    for folder, line in ((other, "2,2,b,B\n"), (again, "1,1,a,A\n")):
        os.makedirs(folder)
        with open(f"{folder}/s.csv", "w") as f:
            f.write(SELLERS + line)
    results = ingest.ingest_landing(lake, root, "i1", AT, ingest.IngestOptions(max_files=2))
    assert len(results) == 2
    uploads = ingest.read_log(lake, "file_upload_log")
    assert sorted((r.source_system, r.upload_status) for r in uploads.collect()) == [
        ("olist", "DUPLICATE"), ("olist", "SUCCESS"), ("partner", "SUCCESS")
    ]
    assert ingest.read_bronze(lake, "sellers").count() == 2
    assert ingest.ingest_landing(lake, root, "i2", AT) == []


def test_one_bad_file_leaves_the_others(lake, root, rows, monkeypatch):
    """Files that Spark can't read stand alone in the end, with the four log rows and the class ``unexpected``."""
    requests = [put(root, "sellers", f"b{i}", f"{i}.csv", SELLERS + f"{i},1,a,A\n") for i in range(6)]
    # Spark takes the name for a compressed file.
    requests.insert(3, put(root, "sellers", "bad", "bad.csv.gz", SELLERS + "9,1,a,A\n"))
    got = outcome(ingest.ingest_batch(lake, root, requests, "i1", AT))
    assert {b for b, (status, _) in got.items() if status == "success"} == {f"b{i}" for i in range(6)}
    assert got["bad"][0] == "failed"
    assert ingest.read_bronze(lake, "sellers").count() == 6
    for log, status in (("pipeline_run_log", "status"), ("data_quality_log", "check_status"), ("file_upload_log", "upload_status")):
        assert ingest.read_log(lake, log).where(f"batch_id = 'bad' and {status} = 'FAILED'").count() == 1
    assert ingest.read_log(lake, "rejected_records").where("batch_id = 'bad'").count() == 1
    events = lake.read("audit", "events").where("batch_id = 'bad'")
    assert rows(events, "event", "severity", "status") == [("pipeline_failed", "ERROR", 500), ("pipeline_started", "INFO", 500)]

    # A file that can't be copied fails too, and its rows stay out.
    good = put(root, "sellers", "c1", "c1.csv", SELLERS + "20,1,a,A\n")
    stuck = put(root, "sellers", "c2", "c2.csv", SELLERS + "21,1,a,A\n")
    blocked = f"{root}/raw/source=olist/table=sellers/load_date=2024-01-02/batch_id=c2"
    with open(blocked, "w") as f:
        f.write("a file where a folder should be")
    got = outcome(ingest.ingest_batch(lake, root, [good, stuck], "i2", AT))
    assert (got["c1"][0], got["c2"][0]) == ("success", "failed")
    assert ingest.read_bronze(lake, "sellers").where("batch_id in ('c1', 'c2')").count() == 1


def test_known_hashes_read_only_their_folders(lake, root):
    """The lookup of a batch's contents prunes the table of handled files to the folders of their first digits."""
    for k in range(3):
        ingest.ingest_batch(lake, root, [put(root, "sellers", f"k{k}", "s.csv", SELLERS + f"{k},1,a,A\n")], f"i{k}", AT)
    spark = lake.spark
    digest = hashlib.sha256((SELLERS + "1,1,a,A\n").encode()).hexdigest()
    contents = spark.createDataFrame([(digest,), ("0" * 64,)], "file_hash string")
    contents.write.parquet(f"{root}/contents")
    asked = spark.read.parquet(f"{root}/contents").where(F.length("file_hash") > 0)
    found = ingest.known_hashes(ingest.read_handled(lake), asked, "later")
    assert [r.file_hash for r in found.collect()] == [digest]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dynamicpruning" in plan.lower()


def test_wide_rows_are_set_aside(lake, root, rows):
    content = SELLERS + "1,1,a,A\n2,2,b,B,surplus\n3,3,c,C\n"
    options = ingest.IngestOptions(wide_rows="quarantine")
    result = ingest.ingest_batch(lake, root, [put(root, "sellers", "w", "w.csv", content)], "i1", AT, options)
    assert rows(result, "status", "row_count") == [("success", 2)]
    assert rows(ingest.read_bronze(lake, "sellers"), "seller_id") == [("1",), ("3",)]
    (bad,) = ingest.read_quarantine(lake).collect()
    assert json.loads(bad.row)["seller_id"] == "2" and (bad.batch_id, bad.rejection_level) == ("w", "ROW")


def test_root_that_only_spark_can_open(lake, root, rows):
    """The same verdicts and rows where Arrow knows no client for the store."""
    conf = lake.spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.landing.link./in", f"file://{root}")
    put(root, "orders", "good", "a.csv", GOOD)
    put(root, "orders", "copy", "b.csv", GOOD)
    put(root, "orders", "zero", "z.csv", "")
    put(root, "orders", "no_rows", "h.csv", HEADER + "\n\n")
    put(root, "orders", "bad", "b.csv", "x,y\n1,2\n")
    put(root, "sellers", "quoted", "q.csv", '\ufeff"note, extra",seller_id,seller_city,seller_state,seller_zip_code_prefix\n"a, b",01,sp,SP,001\n')
    os.makedirs(f"{root}/tmp/source=olist/table=orders/upload_id=latin")
    with open(f"{root}/tmp/source=olist/table=orders/upload_id=latin/l.csv", "wb") as f:
        f.write((HEADER + "\n1,\xe9,,,,,,\n").encode("latin-1"))
    assert not landing.opened_by_arrow("viewfs://landing/in")
    (result,) = ingest.ingest_landing(lake, "viewfs://landing/in", "i1", AT)
    got = outcome(result)
    assert {b: status for b, (status, _) in got.items()} == {
        "copy": "success", "good": "skipped", "zero": "failed", "no_rows": "failed", "bad": "failed", "quoted": "success", "latin": "failed"
    }
    assert got["zero"][1] == "File is empty" and got["no_rows"][1] == "CSV has header but no rows"
    assert rows(ingest.read_bronze(lake, "sellers"), "seller_id", "note__extra") == [("01", "a, b")]
    loaded = ingest.read_bronze(lake, "orders")
    assert loaded.count() == 2 and loaded.first().file_hash == hashlib.sha256(GOOD.encode()).hexdigest()
    assert os.path.exists(f"{root}/raw/source=olist/table=orders/load_date=2024-01-02/batch_id=copy/b.csv")


def test_replay_on_another_day_replaces(lake, root):
    requests = [put(root, "orders", "b1", "a.csv", GOOD)]
    ingest.ingest_batch(lake, root, requests, "run: 1", AT)
    ingest.ingest_batch(lake, root, requests, "run: 1", AT + dt.timedelta(days=1))
    assert ingest.read_bronze(lake, "orders").count() == 2
    assert ingest.read_log(lake, "file_upload_log").count() == 1


def test_screen_uploads(spark, rows):
    uploads = spark.createDataFrame(
        [
            ("olist", "orders", "my orders.CSV", 10, "abcdef012345"),
            ("other", "orders", "a.csv", 10, "x"),
            ("olist", "widgets", "a.csv", 10, "x"),
            ("olist", "orders", None, 10, "x"),
            ("olist", "orders", "a.txt", 10, "x"),
            ("olist", "orders", "a.csv", 0, "x"),
            ("olist", "orders", "b.csv", 2**30, "x"),
        ],
        "source_system string, table_name string, file_name string, size_bytes long, file_hash string",
    )
    at = F.lit(AT)
    got = landing.screen_uploads(uploads, at, SOURCE_SYSTEMS, tuple(ENTITIES), 100 * 1024 * 1024).collect()
    assert [r.reason for r in got] == [
        None,
        "Only source_system='olist' is supported in v1.",
        "Unsupported table_name: widgets",
        "No file selected.",
        "Only .csv files are allowed.",
        "Uploaded file is empty.",
        "File size exceeds 100 MB limit.",
    ]
    assert got[0].tmp_file_path == (
        "tmp/source=olist/table=orders/upload_id=ui_20240102_030405_abcdef01/my_orders.CSV"
    )


FILES = {
    "orders": f"{HEADER}\no1,c1,Delivered ,2024-01-01 10:00:00,,,2024-01-03,2024-01-05\no2,c2,shipped,2024-01-02,,,,\n",
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,u1,01409,Sao Paulo,sp\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2024-01-02,10.50,1.25\no1,2,p2,s1,2024-01-02,3,0\no2,1,p1,s1,2024-01-02,10.50,1.25\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,Toys,1,2,3,4,5,6,7\np2,,1,2,3,4,5,6,7\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,credit_card,1,14.75\no2,1,boleto,1,11.75\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,00001,Rio,rj\n",
}

# Customers that only orders know have no person id; the test on it reports them.
UNKNOWN_PEOPLE = (("dim_customer", "not_null", "customer_unique_id"),)


def test_files_to_marts(lake, root, rows):
    for entity, content in FILES.items():
        put(root, entity, f"{entity}_1", f"{entity}.csv", content)
    ingest.ingest_landing(lake, root, "i1", AT)
    results = pipeline.refresh(lake, AT, warn_only=UNKNOWN_PEOPLE)
    assert len(results) == 102
    assert {(r.model, r.column_name) for r in results if r.status != "PASS"} == {("dim_customer", "customer_unique_id")}
    sales = lake.read("gold", "mart_sales_performance")
    assert rows(sales, F.col("order_purchase_date").cast("string"), "product_category_name", "total_items_sold") == [
        ("2024-01-01", "toys", 1),
        ("2024-01-01", "unknown", 1),
        ("2024-01-02", "toys", 1),
    ]
    products = lake.read("gold", "mart_product_performance")
    assert rows(products, "product_id", "revenue_rank", "units_sold") == [("p1", 1, 2), ("p2", 2, 1)]
    health = lake.read("gold", "mart_pipeline_quality")
    assert rows(health, "total_file_uploads", "successful_file_uploads", "pipeline_steps", "rejected_file_count") == [
        (6, 6, 18, 0)
    ]
    # Without the waiver the layer fails, as its test demands.
    with pytest.raises(quality.QualityGateError, match="customer_unique_id"):
        pipeline.build_gold(lake, AT)


def test_gold_waits_for_silver(lake, root):
    for entity, content in FILES.items():
        put(root, entity, f"{entity}_1", f"{entity}.csv", content.replace("shipped", "teleported"))
    ingest.ingest_landing(lake, root, "i1", AT)
    with pytest.raises(quality.QualityGateError, match="order_status accepted_values"):
        pipeline.refresh(lake, AT)
    assert not lake.exists("gold", "fact_orders")


def _bytes_below(*folders):
    """Bytes on disk; a file of two names counts once."""
    met = {}
    for folder in folders:
        for place, _, names in os.walk(folder):
            met |= {(s := os.lstat(f"{place}/{n}")).st_ino: s.st_size for n in names}
    return sum(met.values())


def test_rows_are_written_once(lake, root, rows):
    """Besides the raw table nothing holds the rows: an ingest leaves little scratch, and a repeated one replaces its partition."""
    spark = lake.spark
    shared = shared_dir(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    digest = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000)]
    good = put(root, "sellers", "many", "m.csv", SELLERS + "".join(f"{d},1,{d[:30]},ST\n" for d in digest))
    other = put(root, "sellers", "rated", "r.csv", "Rating," + SELLERS + "5,x,1,a,A\n")
    lower = put(root, "sellers", "again", "a.csv", "rating,more," + SELLERS + "6,y,z,1,a,A\n")
    for _ in range(2):
        ingest.ingest_batch(lake, root, [good, other, lower], "i1", AT)
        assert ingest.read_bronze(lake, "sellers").count() == 20_002
    found = ingest.read_bronze(lake, "sellers").where("batch_id <> 'many'")
    assert rows(found, "batch_id", "rating", "more", "ingest_id") == [("again", "6", "y", "i1"), ("rated", "5", None, "i1")]
    table = lake.path("bronze", "bronze_sellers")
    assert not [n for n in os.listdir(table) if n.startswith("_next")]
    scratch = [f"{shared}/{n}" for n in set(os.listdir(shared)) - before]
    assert _bytes_below(*scratch) < _bytes_below(table) / 4


def test_landing_and_ingest_leave_no_scratch(spark, tmp_path):
    """The registered ingest keeps the landing zone, the lake and the results; the repeated delivery takes no disk, the raw copies are files of their own."""
    sf, day = str(tmp_path / "sf"), dt.datetime(1997, 3, 4)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "CHINA", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(i, f"c{i}", 0, 1.0, "BUILDING") for i in range(4)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(i, f"s{i}", 0, 1.0) for i in range(4)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(i, f"p{i}", "Brand#1", "SMALL", 7, 2.5) for i in range(4)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
            [(i, i % 4, "P", 10.0, day, "1-URGENT") for i in range(40)],
        ),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
            [(i // 2, i % 4, i % 4, i % 2, 3.0, 20.0, 0.01, "N", day) for i in range(80)],
        ),
    }
    for name, (schema, content) in tables.items():
        spark.createDataFrame(content, schema).write.parquet(f"{sf}/{name}.parquet")
    shared = shared_dir(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    steps = registry.QUERIES["rows_loaded"](spark, sf)
    assert {r.table_name: r.row_count for r in steps.collect()} == {
        "orders": 80, "customers": 8, "order_items": 80, "products": 12, "payments": 120, "sellers": 8
    }
    left = {n.rpartition("-")[0]: f"{shared}/{n}" for n in set(os.listdir(shared)) - before}
    assert left.keys() == {"landing", "ingest"}

    def upload(zone, batch):
        found = {n: os.stat(f"{place}/{n}") for place, _, names in os.walk(f"{left['landing']}/{zone}") for n in names if f"={batch}" in place and n.endswith(".csv")}
        return {n: s.st_ino for n, s in found.items()}, {s.st_nlink for s in found.values()}

    good, again, raw = upload("tmp", "orders_good"), upload("tmp", "orders_repeat"), upload("raw", "orders_good")
    assert good[0] and again[0] == good[0]
    assert raw[0].keys() == good[0].keys() and raw[1] == {1}
