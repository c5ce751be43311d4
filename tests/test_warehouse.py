import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tillmark.operators import dedup, facts, quality, reports
from tillmark.operators.normalise import normalise_lines
from tillmark.plans import warehouse
from tillmark.sources import external, files, landing, schemas, tables

D = dt.date

FILES = {
    "SALES_S01_20240101.csv": (
        "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"
        "S01/20240101/1,1,P1,2,10.50,SALE,2024-01-01 10:00:00\n"
        'S01/20240101/1,2,"P2",1,3.00,TENDER,2024-01-01 10:00:00\n'
        "S01/20240101/2,1,P1,x,10.50,RETURN,garbage\n"
    ),
    # Other names, other order, epoch seconds.
    "SALES_S02_20240101.csv": (
        "txn_time,rate,quantity,type,item_code,line_no,bill_no\n"
        "1704103200,4.25,4,SALE,P2,1,S02/20240101/1\n"
        "1704103200,1.00,1,sale,P2,2,S02/20240101/1\n"
    ),
    # A mixed header and a re-sent, newer version of a line.
    "SALES_S01_20240102.csv": (
        "line_no,bill_no,item_code,qty,unit_price,type,ts\n"
        "1,S01/20240101/1,P1,3,10.50,SALE,2024-01-02 01:00:00\n"
    ),
    "readme.txt": "not a sales file",
    "SALES_S04_20240101.csv": "",
    "OTHER_S01_20240101.csv": "bill_no,line_no\nX,1\n",
}


@pytest.fixture(scope="module")
def sales_root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sales")
    for name, content in FILES.items():
        (root / name).write_text(content)
    import pyarrow as pa
    import pyarrow.parquet as pq

    day = {"bill_no": ["S03/20240201/1"], "line_no": [1], "product_code": ["P1"], "qty": [5.0],
           "unit_price": [2.5], "line_type": ["SALE"], "ts": ["2024-02-01 09:00:00"]}
    pq.write_table(pa.table(day), root / "SALES_S03_20240201.parquet")
    return str(root)


def test_union_by_name(spark, sales_root):
    df = files.read_union_by_name(spark, sales_root, "SALES_*.csv")
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    got = {(r.bill_no, r.line_no): r for r in df.where("file_path not like '%0102.csv'").collect()}
    assert got[("S02/20240101/1", "1")].quantity == "4" and got[("S02/20240101/1", "1")].item_code == "P2"
    assert got[("S02/20240101/1", "1")].product_code is None
    assert got[("S01/20240101/1", "1")].product_code == "P1" and got[("S01/20240101/1", "1")].item_code is None


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_union_by_name(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_sales(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_notices(spark, str(tmp_path))


def test_csv_only_leaves_parquet_days_out(spark, sales_root):
    both = files.read_sales(spark, sales_root)
    only = files.read_sales(spark, sales_root, ("csv",))
    assert both.where("bill_no like 'S03%'").count() == 1
    assert only.where("bill_no like 'S03%'").count() == 0


def test_load_normalises_and_keeps_latest(spark, sales_root):
    lines = warehouse.sales_lines(files.read_sales(spark, sales_root).drop("file_path"))
    got = {(r.bill_no, r.line_no): r for r in lines.collect()}
    assert got[("S01/20240101/1", "1")].quantity == 3.0
    assert got[("S01/20240101/2", "1")].quantity is None and got[("S01/20240101/2", "1")].timestamp is None
    assert got[("S02/20240101/1", "1")].timestamp == dt.datetime(2024, 1, 1, 10, 0)
    assert lines.schema["quantity"].dataType.simpleString() == "double"


def test_load_is_idempotent(spark, sales_root, tmp_path):
    seen = {tuple(warehouse.load_sales(spark, sales_root, "sales_fact_t").first()) for _ in range(3)}
    assert len(seen) == 1
    missing = str(tmp_path / "absent")
    assert tuple(warehouse.load_sales(spark, missing, "sales_fact_t", mirror=sales_root).first()) in seen


def test_other_errors_do_not_fall_back(spark):
    def fail(source):
        raise ValueError(source)

    with pytest.raises(ValueError, match="primary"):
        files.read_with_fallback(fail, "primary", "mirror")


def test_fallback_covers_failures_while_reading(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    spark.range(5).write.parquet(str(good))
    spark.range(3).write.parquet(str(bad))
    for part in bad.glob("*.parquet"):
        part.write_bytes(b"PAR1 broken")
    for crc in bad.glob(".*.crc"):
        crc.unlink()
    run = lambda path: spark.read.schema("id bigint").parquet(path).agg(F.sum("id")).first()[0]
    assert files.read_with_fallback(run, str(bad), str(good)) == 10


def test_a_failing_write_does_not_fall_back(spark, tmp_path):
    good = tmp_path / "good"
    spark.range(5).write.parquet(str(good))
    seen = []

    def read(path):
        seen.append(path)
        return spark.read.parquet(path)

    def write(df):
        raise OSError("No space left on device: java.io.IOException")

    with pytest.raises(OSError, match="No space"):
        files.read_with_fallback(read, str(good), "mirror", write)
    assert seen == [str(good)]


def test_unreadable_files_found_while_writing_fall_back(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    for folder, n in ((good, 5), (bad, 3)):
        spark.range(n).write.parquet(str(folder))
    for part in bad.glob("*.parquet"):
        part.write_bytes(b"PAR1 broken")
    for crc in bad.glob(".*.crc"):
        crc.unlink()
    read = lambda path: spark.read.schema("id bigint").parquet(path)
    assert files.read_with_fallback(read, str(bad), str(good), lambda df: df.agg(F.sum("id")).first()[0]) == 10


def test_long_and_quoted_headers(spark, tmp_path):
    names = [f"column_{i:05d}_{'x' * 30}" for i in range(5000)]
    (tmp_path / "long.csv").write_text(",".join(names) + "\n" + ",".join("7" for _ in names) + "\n")
    (tmp_path / "quoted.csv").write_text('"bill\nno","line, no",rate\n"a\nb",2,3\n')
    (tmp_path / "empty.csv").write_text("")
    df = files.read_union_by_name(spark, str(tmp_path))
    assert set(names) < set(df.columns) and {"bill\nno", "line, no", "rate"} < set(df.columns)
    got = df.select(names[-1], F.col("`bill\nno`"), F.col("`line, no`"), "rate").collect()
    assert sorted(map(tuple, got), key=repr) == [("7", None, None, None), (None, "a\nb", "2", "3")]


def test_plan_does_not_depend_on_size(spark, tmp_path):
    for name, n in (("small", 10), ("large", 300_000)):
        spark.range(n).write.parquet(str(tmp_path / name))
    plans = [plan_of(files.read_spread(spark, str(tmp_path / n), "id", "id")) for n in ("small", "large")]
    assert all("Exchange" not in p for p in plans)


def test_land_partitioned(spark, sales_root, tmp_path):
    target = str(tmp_path / "landed")
    counts = landing.land_partitioned(spark, sales_root, target)
    got = {(r.store, r.year, r.month): (r["files"], r["lines"]) for r in counts.collect()}
    assert got == {("S01", 2024, 1): (2, 4), ("S02", 2024, 1): (1, 2), ("S03", 2024, 2): (1, 1)}
    landed = spark.read.parquet(target)
    one = files.filter_partition(landed, "S01", 2024, 1)
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(year" in plan and "store" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert len(one.inputFiles()) < len(landed.inputFiles()) or one.count() == 4
    assert one.count() == 4
    assert rows(one.select("file_date").distinct()) == [(D(2024, 1, 1),), (D(2024, 1, 2),)]


def test_landing_again_touches_only_what_changed(spark, tmp_path):
    inbox, target = tmp_path / "in box", str(tmp_path / "landed")
    inbox.mkdir()
    head = "bill_no,line_no,qty\n"

    def run():
        return {(r.store, r.month): (r["files"], r["lines"]) for r in landing.land_new(spark, str(inbox), target).collect()}

    def state():
        return {str(p): p.stat().st_mtime_ns for p in tmp_path.glob("landed/**/*.parquet")}

    assert run() == {}
    (inbox / "SALES_S01_20240101.csv").write_text(head + "a,1,2\na,2,2\n")
    (inbox / "SALES_S01_20240102.csv").write_text("line_no,bill_no,rate\n1,b,3\n")
    (inbox / "SALES_S02_20240201.csv").write_text(head + "c,1,2\n")
    (inbox / "notes.csv").write_text("x\n1\n")
    assert run() == {("S01", 1): (2, 3), ("S02", 2): (1, 1)}
    before = state()
    assert run() == {} and state() == before
    (inbox / "SALES_S01_20240102.csv").write_text("line_no,bill_no,rate\n1,b,3\n2,b,77\n")
    (inbox / "SALES_S02_20240201.csv").unlink()
    assert run() == {("S01", 1): (2, 4)}
    after = state()
    assert {p for p in before if "S02" in p} == {p for p in after if "S02" in p}
    got = rows(spark.read.option("mergeSchema", "true").parquet(target).select("store", "bill_no", "line_no", "qty", "rate"))
    assert got == sorted([("S01", "a", "1", "2", None), ("S01", "a", "2", "2", None), ("S01", "b", "1", None, "3"),
                          ("S01", "b", "2", None, "77"), ("S02", "c", "1", "2", None)], key=repr)
    (inbox / "SALES_S02_20240201.csv").write_text(head)
    assert run() == {("S02", 2): (0, 0)}
    assert spark.read.parquet(target).where("store = 'S02'").isEmpty()


def test_landing_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "landed")
    (tmp_path / "SALES_S01_20240101.csv").write_text("bill_no,line_no\na,1\n")
    with monkeypatch.context() as m:
        m.setattr(landing, "_drop_folders", None)
        m.setattr(landing, "files_and_lines", None)
        with pytest.raises(TypeError):
            landing.land_new(spark, str(tmp_path), target, ("csv",))
    assert [tuple(r)[2:] for r in landing.land_new(spark, str(tmp_path), target, ("csv",)).collect()] == [("S01", 1, 1)]
    assert spark.read.parquet(target).count() == 1


def test_many_small_files_of_three_headers(spark, tmp_path):
    heads = ["a,b", "b,a,c", " c ,A"]
    for i in range(1000):
        (tmp_path / f"f {i}%.csv").write_text(f"{heads[i % 3]}\n" + ",".join(f"{n.strip().lower()}{i}" for n in heads[i % 3].split(",")) + "\n")
    df = files.read_union_by_name(spark, str(tmp_path))
    want = [(f"a{i}", f"b{i}" if i % 3 < 2 else None, f"c{i}" if i % 3 else None) for i in range(1000)]
    assert rows(df.select("a", "b", "c")) == sorted(want, key=repr)
    assert plan_of(df).count("FileScan csv") == 1


def test_blank_first_lines_and_repeated_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,x\n1,2,3\n4\n5,6,7,8\n")
    assert rows(files.read_union_by_name(spark, str(tmp_path)).select("x", "y")) == [("1", "2"), ("4", None), ("5", "6")]
    (tmp_path / "b.csv").write_text("\nq\n9\n")
    assert rows(files.read_union_by_name(spark, str(tmp_path)).select("x", "y")) == [("1", "2"), ("4", None), ("5", "6")]


def test_dedup_ties_nulls_and_order(spark):
    data = [("b", "1", None, 1.0), ("b", "1", 5, 2.0), ("b", "1", 5, 3.0), (None, None, 1, 1.0), (None, None, 2, 9.0), ("c", "1", None, 4.0)]
    df = spark.createDataFrame(data, "bill_no string, line_no string, timestamp int, quantity double")
    once = rows(dedup.dedup_latest(df, ["bill_no", "line_no"], "timestamp"))
    assert once == sorted([("b", "1", 5, 3.0), (None, None, 2, 9.0), ("c", "1", None, 4.0)], key=repr)
    again = df.unionAll(df).orderBy(F.rand(1))
    assert rows(dedup.dedup_latest(again, ["bill_no", "line_no"], "timestamp")) == once


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(dedup.dedup_latest(df, ["k"], "id"))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


PRODUCTS = [
    (1, "P1", "C1", D(2019, 4, 1), D(2024, 5, 31)),
    (2, "P1", "C2", D(2024, 6, 1), D(9999, 12, 31)),
    (3, "P2", "C1", D(2019, 4, 1), None),
]


def products(spark):
    return spark.createDataFrame(PRODUCTS, "product_sk bigint, product_code string, category_id string, valid_from date, valid_to date")


def categories(spark):
    return spark.createDataFrame([("C1", "Spices"), ("C2", "Sweets")], "category_id string, category_name string")


def lines(spark):
    data = [
        ("S01/20240531/1", "1", "P1", 2.0, 10.0, "SALE", "2024-05-31 10:00:00"),
        ("S01/20240601/1", "1", "P1", 1.0, 10.0, "RETURN", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "1", "P2", 3.0, 1.0, "VOID", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "2", "P9", 1.0, 7.0, "DISCOUNT", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "3", "P2", 1.0, 99.0, "TENDER", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "4", "P2", 1.0, 9.0, "TAX", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "5", "P2", 1.0, 9.0, "sale", "2024-06-01 10:00:00"),
        ("S02/20240601/1", "6", "P2", 1.0, 9.0, None, "2024-06-01 10:00:00"),
        # A bill after midnight: its file and its number carry the day before.
        ("S03/20240630/9", "1", "P2", 1.0, 5.0, "SALE", "2024-07-01 01:00:00"),
        ("S03/20240630/9", "2", "P1", 1.0, 5.0, "SALE", None),
    ]
    schema = "bill_no string, line_no string, product_code string, quantity double, unit_price double, line_type string, t string"
    df = spark.createDataFrame(data, schema)
    path = F.concat(F.lit("SALES_"), F.split_part("bill_no", F.lit("/"), F.lit(1)), F.lit("_"), F.split_part("bill_no", F.lit("/"), F.lit(2)), F.lit(".csv"))
    return df.withColumn("timestamp", F.to_timestamp("t")).withColumn("file_path", path).drop("t")


def test_star_fact(spark):
    fact = facts.star_fact(lines(spark), products(spark))
    assert fact.columns == ["bill_no", "line_no", "store_id", "product_sk", "quantity", "unit_price", "line_revenue",
                            "business_date", "day_of_week", "sales_month", "line_type"]
    got = {(r.bill_no, r.line_no): r for r in fact.collect()}
    assert len(got) == 6
    assert got[("S01/20240531/1", "1")].product_sk == 1
    assert got[("S01/20240601/1", "1")].product_sk == 2
    assert got[("S02/20240601/1", "2")].product_sk is None
    assert got[("S03/20240630/9", "2")].product_sk is None
    row = got[("S01/20240531/1", "1")]
    assert (row.store_id, row.line_revenue, row.day_of_week, row.sales_month) == ("S01", 20.0, "Friday", "May")


def test_business_date_sources(spark):
    for source, expected in (("timestamp", D(2024, 7, 1)), ("filename", D(2024, 6, 30)), ("bill", D(2024, 6, 30))):
        fact = facts.star_fact(lines(spark), products(spark), source).where("bill_no like 'S03%' and line_no = '1'")
        assert fact.first().business_date == expected
    with pytest.raises(ValueError):
        facts.business_date("other")


def finance(spark):
    return spark.createDataFrame([("2024-05", Decimal("25.00")), ("2024-06", Decimal("10.00")), ("2024-08", Decimal("1.50"))], "month string, revenue_inr decimal(18,2)")


def test_reconcile(spark):
    monthly = reports.monthly_revenue(facts.star_fact(lines(spark), products(spark)))
    null = [(r.month, r.pipeline_revenue, r.variance) for r in reports.reconcile(finance(spark), monthly).collect()]
    assert null == [("2024-05", Decimal("20.0000"), Decimal("-5.0000")), ("2024-06", Decimal("20.0000"), Decimal("10.0000")), ("2024-08", None, None)]
    zero = [(r.month, r.variance) for r in reports.reconcile(finance(spark), monthly, "zero").collect()]
    assert zero == [("2024-05", Decimal("-5.00")), ("2024-06", Decimal("10.00")), ("2024-08", Decimal("-1.50"))]
    average = reports.average_variance(reports.reconcile(finance(spark), monthly, "zero")).first()
    assert average.months == 3 and float(average.avg_variance) == pytest.approx(3.5 / 3, abs=1e-4)
    with pytest.raises(ValueError):
        reports.reconcile(finance(spark), monthly, "other")


def test_kpis_and_categories(spark):
    fact = facts.star_fact(lines(spark), products(spark))
    assert tuple(reports.kpis(fact).first()) == (6, Decimal("50.0000"), 3, 3)
    assert tuple(reports.kpis(fact.where("false")).first()) == (0, None, 0, 0)
    by_category = reports.revenue_by_category(fact, products(spark), categories(spark))
    assert rows(by_category) == [("Spices", Decimal("28.00")), ("Sweets", Decimal("10.00"))]
    assert [r.category_name for r in reports.top_categories(by_category, 1).collect()] == ["Spices"]
    shares = {r.category_name: r.share for r in reports.share_of_max(by_category, "revenue").collect()}
    assert shares == {"Spices": 1.0, "Sweets": pytest.approx(10 / 28)}


def test_top_k_plan(spark):
    df = spark.createDataFrame([("a", 1.0)], "category_name string, revenue double")
    assert "TakeOrderedAndProject" in plan_of(reports.top_categories(df))


def test_federated_counts_reissued_codes_twice(spark):
    raw = spark.createDataFrame(
        [("P1", None, "2", None, "10", None), ("P2", None, None, "1", None, "4"), (None, "P2", "5", None, "5", None), ("P2", None, "x", None, "1", None)],
        "product_code string, item_code string, qty string, quantity string, unit_price string, rate string",
    )
    got = rows(reports.federated_category(raw, products(spark), categories(spark)))
    assert got == [("Spices", Decimal("24.0000")), ("Sweets", Decimal("20.0000"))]
    valid = rows(reports.federated_category_validity(lines(spark), products(spark), categories(spark)))
    assert valid[0][0] == "Spices" and valid[1] == ("Sweets", Decimal("10.0000"))


def test_period_revenue(spark):
    fact = spark.createDataFrame(
        [(1, D(2019, 7, 17), 2.0, "SALE"), (1, D(2019, 7, 18), 1.0, "SALE"), (1, D(2019, 7, 18), 1.0, "VOID"), (None, D(2019, 7, 18), 1.0, "SALE"),
         (1, D(2019, 9, 2), 1.5, "SALE")],
        "product_sk bigint, business_date date, quantity double, line_type string",
    )
    revisions = spark.createDataFrame(
        [(1, Decimal("61.40"), D(2016, 3, 5), D(2019, 7, 17)), (1, Decimal("70.10"), D(2019, 7, 18), None)],
        "product_sk bigint, selling_price decimal(12,2), effective_from date, effective_to date",
    )
    periods = [("Jul", D(2019, 7, 1), D(2019, 7, 31)), ("Both", D(2019, 7, 18), D(2019, 9, 2)), ("None", D(2020, 1, 1), D(2020, 1, 2))]
    half = {r[0]: r[1] for r in reports.period_revenue(fact, revisions, periods).collect()}
    closed = {r[0]: r[1] for r in reports.period_revenue(fact, revisions, periods, "[]").collect()}
    assert half == {"Jul": Decimal("70.10"), "Both": Decimal("175.25"), "None": None}
    assert closed == {"Jul": Decimal("192.90"), "Both": Decimal("175.25"), "None": None}


def test_quality(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 9), (4, 9), (5, None)], "id int, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    checks = quality.violations([
        quality.repeated_keys(child, "child", ["id"]),
        quality.orphans(child, "child", "parent", parent, "id"),
        quality.missing_values(child, "child", ["id", "parent"]),
    ])
    assert rows(checks) == [
        ("not null", "child", "id", 0, 0), ("not null", "child", "parent", 0, 1),
        ("primary key", "child", "id", 1, 2), ("reference", "child", "parent", 1, 2),
    ]


def test_key_counts_equal_the_single_checks(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 9), (4, 9), (5, None), (5, None)], "id int, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    counts = quality.KeyCounts(child, "child", ["id"], ["parent"], ["id", "parent"])
    parents = quality.KeyCounts(parent, "parent", ["id"])
    for got, want in (
        (counts.repeated(["id"]), quality.repeated_keys(child, "child", ["id"])),
        (counts.repeated(["id", "parent"]), quality.repeated_keys(child, "child", ["id", "parent"])),
        (counts.orphans("parent", parents, "id"), quality.orphans(child, "child", "parent", parent, "id")),
    ):
        assert rows(got) == rows(want)


def test_star_build_inventory_and_dashboard(spark, sales_root):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    warehouse.load_sales(spark, sales_root, "sales_fact")
    masters = {
        "stores": spark.createDataFrame([("S01", "One")], "store_id string, store_name string"),
        "product_categories": categories(spark),
        "products": products(spark),
    }
    star = warehouse.build_star(spark, masters)
    listed = {r.table_name: r.row_count for r in tables.catalog_inventory(spark, "default").collect()}
    assert listed["dim_product"] == 3 and listed["fact_sales"] == star["fact_sales"].count()
    payload = json.loads(warehouse.dashboard(star, finance(spark)).first().payload)
    assert set(payload) == {"kpis", "monthly", "categories", "tables"}
    assert payload["kpis"]["fact_rows"] == listed["fact_sales"]
    assert [m["month"] for m in payload["monthly"]] == ["2024-05", "2024-06", "2024-08"]
    assert payload["tables"] == sorted(payload["tables"], key=lambda t: t["name"])
    revenues = [c["revenue"] for c in payload["categories"]]
    assert revenues == sorted(revenues, reverse=True)


def test_masters_finance_dims_and_object_store(spark, tmp_path, monkeypatch):
    (tmp_path / "stores.csv").write_text("store_id,store_name,address_line,city,state,region,floor_area_sqft,opened_on\nS07,Seven,\"7, Lane\",Q,Z,Island,431,2018-02-27\n")
    (tmp_path / "product_categories.csv").write_text("category_id,category_name,department,gst_rate\nK9,Bread,Bakery,0.075\n")
    (tmp_path / "products.csv").write_text("product_sk,product_code,product_name,category_id,brand,pack_size,uom,valid_from,valid_to,is_current\n77,Q5,Rusk,K9,Y,9U,PK,2017-06-08,9999-12-31,TRUE\n")
    (tmp_path / "price_revisions.csv").write_text("revision_id,product_sk,mrp,selling_price,effective_from,effective_to\n3,77,12.75,11.10,2017-06-08,2018-05-31\n")
    masters = external.load_masters(spark, str(tmp_path))
    assert set(masters) == set(schemas.MASTERS)
    assert masters["stores"].first().opened_on == D(2018, 2, 27)
    assert masters["product_categories"].first().gst_rate == Decimal("0.075")
    assert masters["products"].first().is_current is True
    assert masters["price_revisions"].first().selling_price == Decimal("11.10")

    masters["stores"].write.parquet(str(tmp_path / "db" / "stores"))
    assert external.read_dim(spark, str(tmp_path / "db"), "stores").count() == 1

    (tmp_path / "finance.csv").write_text("month,revenue_inr\n2018-03,9173.64\n")
    assert tuple(files.read_finance(spark, str(tmp_path / "finance.csv")).first()) == ("2018-03", Decimal("9173.64"))

    monkeypatch.setenv("AWS_ENDPOINT_URL", "http://store:9000")
    external.configure_object_store(spark, ssl=False)
    assert spark.conf.get("fs.s3a.endpoint") == "http://store:9000"
    assert external.object_uri("s3://bucket/x") == "s3a://bucket/x"


def test_notices_from_csv_and_parquet(spark, tmp_path):
    (tmp_path / "a.csv").write_text('portal_id,notice_id,body\nP1,N1,"line one\nline ""two"", end"\nP1,N3,\n')
    spark.createDataFrame([("N2", "text", "P2")], "notice_id string, body string, portal_id string").write.parquet(str(tmp_path / "b"))
    assert rows(files.read_notices(spark, str(tmp_path))) == [("N1", 'line one\nline "two", end', "P1", None), ("N2", "text", "P2", None)]
    (tmp_path / "labels.csv").write_text("notice_id_a,notice_id_b,label\nN1,N2,same\n")
    assert rows(files.read_labelled_pairs(spark, str(tmp_path / "labels.csv"))) == [("N1", "N2", "same")]


def test_missing_columns_normalise_to_null(spark):
    raw = spark.createDataFrame([("b", "1", "P")], "bill_no string, line_no string, item_code string")
    row = normalise_lines(raw).first()
    assert (row.product_code, row.quantity, row.line_type, row.timestamp) == ("P", None, None, None)
    assert normalise_lines(raw, "bigint").first().line_no == 1
