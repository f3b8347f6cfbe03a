"""Refreshing what has changed gives the tables that a rebuild gives, and failing tests keep the last good ones."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from bazaarlake.plans import ingest, pipeline, quality
from bazaarlake.plans.candidate import Candidate, among
from bazaarlake.sources.tables import Lake
from test_ingest import FILES, UNKNOWN_PEOPLE, put

AT = dt.datetime(2024, 1, 2, 3, 4, 5)
LATER = AT + dt.timedelta(days=1)
GOLD = [n for n in quality.GOLD_TESTS if n != "mart_pipeline_quality"]
HEADERS = {e: text.splitlines()[0] for e, text in FILES.items()}

# A changed order that moves to another day, a new one, a new line and payment of an old one, a product that changes its category.
CHANGES = {
    "orders": "o1,c1,delivered,2024-01-05 10:00:00,,,2024-01-07,2024-01-09\no3,c9,shipped,2024-01-06,,,,\n",
    "order_items": "o2,2,p2,s2,2024-01-02,7,1\no3,1,p1,s1,2024-01-02,2,0\n",
    "payments": "o2,2,voucher,1,8\no3,1,boleto,1,2\n",
    "products": "p1,Games,1,2,3,4,5,6,7\n",
    "sellers": "s2,00002,Recife,pe\n",
}


@pytest.fixture(scope="module")
def first_build(spark, tmp_path_factory):
    """A lake after its first ingest and refresh; the first refresh of changes builds all."""
    base = tmp_path_factory.mktemp("first")
    for entity, content in FILES.items():
        put(str(base / "landing"), entity, f"{entity}_1", f"{entity}.csv", content)
    lake = Lake(spark, str(base / "lake"))
    ingest.ingest_landing(lake, str(base / "landing"), "i1", AT)
    assert len(pipeline.refresh_changes(lake, AT, warn_only=UNKNOWN_PEOPLE)) == 102
    assert lake.read("gold", "fact_orders").count() == 2
    return base


@pytest.fixture
def filled(first_build, lake, tmp_path):
    """A copy of it; the landing root."""
    shutil.copytree(first_build / "lake", lake.root)
    shutil.copytree(first_build / "landing", tmp_path / "landing")
    return str(tmp_path / "landing")


def tables_of(lake, rows):
    silver = {e: rows(pipeline.read_silver(lake, e)) for e in FILES}
    gold = {}
    for name in GOLD:
        df = lake.read("gold", name)
        gold[name] = rows(df.select(*sorted(df.columns)))
    return silver | gold


def test_changes_equal_a_rebuild(lake, filled, rows):
    for entity, lines in CHANGES.items():
        put(filled, entity, f"{entity}_2", f"{entity}.csv", f"{HEADERS[entity]}\n{lines}")
    ingest.ingest_landing(lake, filled, "i2", LATER)
    results = pipeline.refresh_changes(lake, AT, warn_only=UNKNOWN_PEOPLE)
    assert len(results) == 102
    changed = tables_of(lake, rows)
    assert [r[0] for r in rows(lake.read("gold", "fact_orders"), "order_id")] == ["o1", "o2", "o3"]
    days = {str(r[0]) for r in lake.read("gold", "mart_sales_performance").select("order_purchase_date").distinct().collect()}
    assert days == {"2024-01-02", "2024-01-05", "2024-01-06"}
    # Nothing new, nothing done.
    assert pipeline.refresh_changes(lake, AT, warn_only=UNKNOWN_PEOPLE) == []
    pipeline.refresh(lake, AT, warn_only=UNKNOWN_PEOPLE)
    whole = tables_of(lake, rows)
    assert {n for n in whole if whole[n] != changed[n]} == set()


def test_failed_tests_keep_the_last_good_tables(lake, filled, rows):
    before = tables_of(lake, rows)
    put(filled, "orders", "bad", "o.csv", f"{HEADERS['orders']}\no1,c1,teleported,2024-01-05,,,,\n")
    ingest.ingest_landing(lake, filled, "i2", LATER)
    with pytest.raises(quality.QualityGateError, match="order_status accepted_values"):
        pipeline.refresh_changes(lake, AT, warn_only=UNKNOWN_PEOPLE)
    with pytest.raises(quality.QualityGateError):
        pipeline.refresh(lake, AT, warn_only=UNKNOWN_PEOPLE)
    assert tables_of(lake, rows) == before
    # A later correction is taken up together with the bad rows.
    put(filled, "orders", "good", "o.csv", f"{HEADERS['orders']}\no1,c1,delivered,2024-01-05,,,,\n")
    ingest.ingest_landing(lake, filled, "i3", LATER + dt.timedelta(days=1))
    pipeline.refresh_changes(lake, AT, warn_only=UNKNOWN_PEOPLE)
    assert rows(lake.read("gold", "fact_orders").where("order_id = 'o1'"), "order_status") == [("delivered",)]


def test_only_touched_folders_are_read(lake, filled):
    """The folders of other numbers and days are pruned from the scans of a refresh."""
    tables = Candidate(lake, pipeline._LAYERS)
    keys = lake.spark.createDataFrame([("o1",)], "order_id string")
    plan = pipeline._restricted(tables, "orders", keys, [1])._jdf.queryExecution().executedPlan().toString()
    assert "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    days = tables.current("fact_orders").where(among(F.col("order_purchase_date"), [dt.date(2024, 1, 1)]))
    assert "order_purchase_date" in days._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_candidate_replaces_values(spark, tmp_path, rows):
    lake = Lake(spark, str(tmp_path / "lake"))
    data = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None), (4, dt.date(2024, 1, 3))]
    lake.overwrite("gold", "t", spark.createDataFrame(data, "v int, day date"), day="day")
    tables = Candidate(lake, {"": "gold"})
    new = spark.createDataFrame([(9, dt.date(2024, 1, 2))], "v int, day date")
    tables.replace("t", new, "day", [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None])
    assert rows(tables.read("t"), "v") == [(4,), (9,)]
    assert rows(lake.read("gold", "t"), "v") == [(1,), (2,), (3,), (4,)]
    tables.commit()
    assert rows(lake.read("gold", "t"), "v") == [(4,), (9,)]
