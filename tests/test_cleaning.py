from datetime import datetime

from pricetide.functions.text import categorise, word_count
from pricetide.operators import cleaning as C
from pricetide.sources.schemas import SALES


def line(invoice="1", code=" 85123a ", text="WHITE MUG", qty=1, day=1, price=2.5, customer="7"):
    return (invoice, code, text, qty, datetime(2011, 1, day), price, customer, "France", "retail_i", "2010-2011")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SALES)


def test_each_case(spark):
    good = [line(price=0.01), line("2", price=5000.0), line("3", qty=10000)]
    bad = [line("C4"), line("5", qty=0), line("6", qty=-1), line("7", qty=10001), line("8", price=0.0),
           line("9", price=5000.01), line("10", text=None), line("11", text="AB"), line("12", text="dotcom postage"),
           line("13", code="D"), line("14", code="ab"), line("15", code="post")]
    out = C.clean_sales(frame(spark, *good, *bad)).collect()
    assert sorted(r["invoice_no"] for r in out) == ["1", "2", "3"]
    assert {r["stock_code"] for r in out} == {"85123A"}
    report = C.clean_report(frame(spark, *good, *bad, *good)).first()
    assert (report["rows_in"], report["rows_out"], report["removed_duplicate"]) == (18, 3, 3)
    assert (report["removed_cancelled"], report["removed_price"], report["removed_quantity"]) == (3, 2, 1)
    assert (report["removed_description"], report["removed_code"]) == (3, 3)


def test_earliest_copy_is_kept(spark):
    out = C.dedup_sales(frame(spark, line(day=3), line(day=2, text="BLUE MUG"), line(day=5))).collect()
    assert [(r["invoice_date"].day, r["description"]) for r in out] == [(2, "BLUE MUG")]


def test_guest_and_flags(spark):
    out = C.clean_sales(frame(spark, line(customer=None, qty=12))).first()
    assert (out["customer_id"], out["is_bulk"], out["revenue"]) == ("GUEST_1", 1, 30.0)


def test_tail(spark):
    kept = C.drop_tail(frame(spark, *[line(str(d), day=d) for d in (1, 2, 3, 10)]), "invoice_date").collect()
    assert sorted(r["invoice_no"] for r in kept) == ["1", "2"]


def test_text(spark):
    texts = {"white mug box": "KITCHEN", "paper bag": "STATIONERY", "TEA TOWEL": "TEXTILE", "bird table": "GARDEN",
             "glass star": "OTHER", "GIFT TAG": "GIFT", "xmas heart": "SEASONAL", "wooden frame": "HOME_DECOR"}
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    assert {r[0]: r[1] for r in df.select("d", categorise("d")).collect()} == texts
    counts = spark.createDataFrame([(" a  b\tc ",), ("",), (None,)], "d string").select(word_count("d")).collect()
    assert [r[0] for r in counts] == [3, 0, 0]
