import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricetide.operators import marketplace as M
from pricetide.operators import profiling as P
from pricetide.operators.cleaning import clean_sales
from pricetide.sources import readers, sinks
from pricetide.sources.replay import RECORD_REPLAY
from pricetide.sources.schemas import MARKET_FEATURES, ORDER_EVENT, STREAM_EVENT, validate_schema
from pricetide.sources.warehouse import Warehouse
from pricetide.streaming.windows import typed_events


def test_csv_sources_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                                    "1,x,MUG,3,2011-01-01 10:00:00,2.5,,France\n2,y,CUP,bad,never,1,9,Spain\n")
    (tmp_path / "b.csv").write_text("Invoice,StockCode,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                                    "3,z,4,2010-01-01 10:00:00,1.5,8,Malta\n")
    a = readers.load_source(spark, str(tmp_path / "a.csv"), "retail_i", "2010-2011", "csv")
    b = readers.load_source(spark, str(tmp_path / "b.csv"), "retail_ii", "2009-2011", "csv")
    rows = {r["invoice_no"]: r for r in readers.union_sources([a, b]).collect()}
    assert rows["1"]["customer_id"] is None and rows["1"]["invoice_date"] == datetime(2011, 1, 1, 10)
    assert rows["2"]["quantity"] is None and rows["2"]["invoice_date"] is None
    assert rows["3"]["description"] is None and rows["3"]["unit_price"] == 1.5 and rows["3"]["source"] == "retail_ii"


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b"\xef\xbb\xbfproduct_category_name,product_category_name_english\nbebes,baby\n")
    star = readers.load_star(spark, {"translations": str(tmp_path / "t.csv")})
    assert [tuple(r) for r in star["translations"].collect()] == [("bebes", "baby")]


def test_load_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    assert readers.load_or_build(spark, path, build).count() == 3
    assert readers.load_or_build(spark, path, build).count() == 3 and len(calls) == 1


def test_validate_and_ensure(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "price double, optimal_price double")
    with pytest.raises(ValueError, match="nope"):
        validate_schema(df, ["price", "nope"])
    full = M.ensure_columns(df)
    assert full.count() == 1 and set(MARKET_FEATURES) <= set(full.columns) and full.first()["is_holiday"] == 0.0


def test_event_parsing(spark, tmp_path):
    good = {"sku_id": "a", "price": 2.0, "timestamp": "2024-01-01T10:00:00Z"}
    lines = [json.dumps(good), json.dumps({"sku_id": "b", "timestamp": "2024-01-01T12:00:00+02:00"}), "{broken",
             json.dumps({"price": 1.0, "timestamp": "2024-01-01T10:00:00"}), json.dumps({"sku_id": "c", "timestamp": "x"})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.txt").write_text("\n".join(lines))
    stream = typed_events(readers.event_stream(spark, STREAM_EVENT, "text", path=str(tmp_path / "in")))
    assert stream.isStreaming
    query = sinks.flushed(stream.writeStream.format("memory").queryName("parsed")).start()
    query.processAllAvailable()
    query.stop()
    got = sorted((r["sku_id"], r["price"], r["ts"]) for r in spark.table("parsed").collect())
    assert got == [("a", 2.0, datetime(2024, 1, 1, 10)), ("b", 0.0, datetime(2024, 1, 1, 10))]
    one = spark.createDataFrame([('{"stock_code": "p", "timestamp": "2024-01-01T00:00:00"}',)], "value string")
    assert typed_events(readers.parse_json(one, ORDER_EVENT)).first()["quantity"] == 1


def test_replay_admits_records(spark, tmp_path):
    """Batches of two over files of other lengths; a new query on the checkpoint goes on where the first stopped."""
    folder = tmp_path / "lines"
    folder.mkdir()
    record = lambda i: json.dumps({"n": i, "t": "\u00e9" * i})

    def run(name):
        stream = readers.event_stream(spark, StructType.fromDDL("n int, t string"), RECORD_REPLAY, flush=2, path=str(folder))
        query = sinks.flushed(stream.writeStream.foreachBatch(
            lambda batch, number: sinks.commit_batch(batch, str(tmp_path / "out"), number)).option(
            "checkpointLocation", str(tmp_path / "checkpoint")), "10 milliseconds").start()
        query.processAllAvailable()
        query.stop()
        rows = spark.read.schema("n int, t string, commit int").json(str(tmp_path / "out")).collect()
        assert all(r["t"] == "\u00e9" * r["n"] for r in rows)
        found = {}
        for r in rows:
            found.setdefault(r["commit"], []).append(r["n"])
        return {k: sorted(v) for k, v in found.items()}

    (folder / "a").write_text("\n".join(map(record, range(3))), encoding="utf-8")  # no end of the last line
    (folder / "b").write_text("")
    (folder / "_SUCCESS").write_text("no record")
    (folder / "c").write_text("\n" + record(3) + "\r\n\n{broken\n" + record(4) + "\n", encoding="utf-8")
    assert run("first") == {0: [0, 1], 1: [2, 3], 2: [4]}
    (folder / "d").write_text("\n".join(map(record, range(5, 8))), encoding="utf-8")
    assert run("second") == {0: [0, 1], 1: [2, 3], 2: [4], 3: [5, 6], 4: [7]}
    with pytest.raises(Exception, match="at least one record"):
        spark.readStream.format(RECORD_REPLAY).option("path", str(folder)).option("records", 0).load().writeStream.format(
            "noop").start().processAllAvailable()


def test_sinks(spark, tmp_path):
    t = datetime(2024, 1, 2, 3, 4, 5)
    d = spark.createDataFrame([("a", 9.5, "why", t)], "sku_id string, final_price double, reasoning string, timestamp timestamp")
    sinks.publish_updates(d.select(*d.columns), "json", path=str(tmp_path / "updates"))
    body = json.loads(spark.read.json(str(tmp_path / "updates")).first()["value"])
    assert body["sku_id"] == "a" and body["price"] == 9.5 and body["timestamp"] == "2024-01-02T03:04:05"
    for batch in (0, 1, 1, "nightly"):  # the second try of a batch takes the place of the first
        sinks.audit_log(d, str(tmp_path / "audit"), batch)
    assert (tmp_path / "audit" / "commit=0000000001" / "date=2024-01-02").is_dir()
    assert spark.read.json(str(tmp_path / "audit")).count() == 3
    sinks.audit_log(d.limit(0), str(tmp_path / "audit"), 1)
    assert spark.read.schema(d.schema).json(str(tmp_path / "audit")).count() == 2
    sinks.report_csv(d, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == d.columns
    sinks.write_metrics_json(d, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["final_price"] == 9.5
    sinks.write_stage(d.withColumn("month", F.lit("2024-01")), str(tmp_path / "stage"), ["month"])
    assert (tmp_path / "stage" / "month=2024-01").is_dir()
    wide = spark.range(1).select(*[F.lit(float(i)).alias(f"m{i:02d}") for i in range(25)])
    batches = sinks.batch_metrics(sinks.metric_rows(wide, F.lit(t).cast("timestamp"))).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in batches} == {0: 20, 1: 5}


def test_fingerprint_ignores_row_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    a, b = P.data_fingerprint(df).first(), P.data_fingerprint(df.orderBy(F.desc("id"))).first()
    assert a == b and a != P.data_fingerprint(df.withColumn("x", F.col("x") + 1)).first()


def test_samples_repeat(spark):
    df = spark.range(1000).withColumn("id", F.col("id").cast("string"))
    pick = lambda d: sorted(r[0] for r in P.sample_n(d, "id", 50).collect())
    assert pick(df) == pick(df.repartition(7)) and len(pick(df)) == 50
    assert 150 < P.sample_fraction(df, "id", 0.2).count() < 250


def test_replay_takes_many_flushes_in_one_batch(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    lines = spark.range(0, 1037, 1, 3).select(F.to_json(F.struct(F.col("id").alias("n"))).alias("value"))

    def run():
        stream = readers.event_stream(spark, StructType.fromDDL("n int"), RECORD_REPLAY, flush=10, keep=("flush",),
                                      path=folder, flushes=20)
        query = stream.writeStream.foreachBatch(
            lambda batch, number: sinks.commit_batch(batch, out, number, "parquet")).option("checkpointLocation", ckpt).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        rows = spark.read.parquet(out).groupBy("commit", "flush").agg(F.min("n"), F.max("n"), F.count("n")).collect()
        return sorted(map(tuple, rows))

    lines.write.text(folder)
    want = [(k // 20, k, 10 * k, min(10 * k + 9, 1036), 10 if k < 103 else 7) for k in range(104)]
    assert run() == want
    (tmp_path / "in" / "z").write_text('{"n": 2000}\n', encoding="utf-8")  # behind the checkpoint: a flush of its own
    assert run() == [*want, (6, 104, 2000, 2000, 1)]


def test_filters_on_the_invoice_reach_the_lines(spark, tmp_path):
    """Cancelled lines are dropped before lines travel to their orders."""
    tables = {"lineitem": "bigint(1) l_orderkey, bigint(5) l_partkey, 2.0D l_quantity, 8.0D l_extendedprice, 'N' l_returnflag, 'O' l_linestatus",
              "orders": "bigint(1) o_orderkey, bigint(1) o_custkey, 'F' o_orderstatus, timestamp'1995-01-02' o_orderdate",
              "customer": "bigint(1) c_custkey, 0 c_nationkey", "nation": "0 n_nationkey, 'X' n_name",
              "part": "bigint(5) p_partkey, 'ivory' p_name, 'SMALL' p_type, 3 p_size"}
    for name, columns in tables.items():
        spark.sql(f"select {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    clean = clean_sales(Warehouse(spark, str(tmp_path)).sales())
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" in plan.split("Join Inner, (l_orderkey")[1]
    row = clean.first().asDict()
    assert (row["invoice_no"], row["revenue"], row["is_bulk"], row["country"]) == ("1", 8.0, 0, "United Kingdom")
    assert clean.columns[-2:] == ["revenue", "is_bulk"]
