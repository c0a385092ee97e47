import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import landed
from tidemark.sources.landed import EmptyBatchError

from conftest import T1


def test_csv_lines_typed_and_stamped(spark):
    df = spark.createDataFrame([("2024-01-02,10.0,11.5,9.5,11.0,1000",), ("",),
                                ("2024-01-03,11.0,12.0,10.5,11.5,2000",)], "line string")
    rows = landed.price_rows_from_csv_lines(df, "line", F.lit("PKO"), "stooq", T1)
    clean, bad = landed.split_corrupt(rows)
    out = landed.to_bronze_prices(clean).orderBy("date").collect()
    assert bad.count() == 0
    assert [r.date for r in out] == ["2024-01-02", "2024-01-03"]  # date stays text
    assert out[0].close == 11.0 and out[0].volume == 1000 and out[0].ticker == "PKO"
    assert out[0].source == "stooq" and out[0].retrieved_at == T1


def test_csv_short_row_quarantined_and_empty_volume_null(spark):
    df = spark.createDataFrame([("2024-01-02,10.0,11.5",), ("2024-01-03,1.0,2.0,0.5,1.5,",)], "line string")
    rows = landed.price_rows_from_csv_lines(df, "line", F.lit("X"), "stooq", T1)
    clean, bad = landed.split_corrupt(rows)
    assert bad.count() == 1
    assert clean.collect()[0].volume is None


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_landed_csv_files_and_header_check(spark, scratch):
    _write(scratch, "pko.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,10\n")
    _write(scratch, "bad.csv", "date,open,high,low,close,vol\n2024-01-02,1,2,0.5,1.5,10\n")
    m = spark.createDataFrame([("PKO", "pko")], "ticker string, stooq_symbol string")
    rows = landed.read_price_csv(spark, scratch, m, "stooq", T1).collect()
    assert {r.ticker for r in rows} == {"PKO", None}
    status = landed.csv_header_status(landed.first_lines(spark, scratch)).collect()
    ok = {os.path.basename(r.file_path): r.header_ok for r in status}
    assert ok == {"pko.csv": True, "bad.csv": False}


def test_fx_json_code_on_each_rate(spark):
    body = json.dumps({"table": "A", "currency": "dolar", "code": "USD",
                       "rates": [{"no": "1", "effectiveDate": "2024-01-02", "mid": 3.8117},
                                 {"no": "2", "effectiveDate": "2024-01-03", "mid": 3.95}]})
    df = spark.createDataFrame([(body,)], "b string")
    out = landed.fx_rows_from_json(df, "b", "nbp", T1).orderBy("effective_date").collect()
    assert [(r.currency_code, r.effective_date, r.mid_rate) for r in out] == [
        ("USD", "2024-01-02", 3.8117), ("USD", "2024-01-03", 3.95)]


def test_macro_json_nested(spark):
    body = json.dumps({"results": [{"id": "1", "name": "cpi", "values": [
        {"year": "2022", "val": 114.4, "attrId": 1}, {"year": "2023", "val": None, "attrId": 1}]}]})
    df = spark.createDataFrame([(body,), ("{}",)], "b string")
    out = landed.macro_rows_from_json(df, "b", "cpi", 217230, "%", "gus", T1).orderBy("year").collect()
    assert [(r.year, r.value) for r in out] == [(2022, 114.4), (2023, None)]
    assert out[0].indicator_name == "cpi" and out[0].variable_id == 217230 and out[0].unit == "%"


def test_statement_json_field_union(spark, scratch):
    recs = [{"date": "2024-03-31", "totalAssets": 100, "goodwill": None, "epsdiluted": 123456},
            {"date": "2023-12-31", "cash": 5.5, "goodwill": None, "epsdiluted": 123456.5}]
    _write(scratch, "a.json", "\n".join(json.dumps(r) for r in recs))
    df = landed.read_statement_json(spark, scratch)
    types = dict(df.dtypes)
    assert types["goodwill"] == "string"          # all-null field
    assert types["epsdiluted"] == "double"        # int + float widen
    row = df.where("date = '2023-12-31'").first()
    assert row.totalAssets is None                 # absent key is null


def test_statement_json_empty_raises(spark, scratch):
    _write(scratch, "e.json", "")
    with pytest.raises(Exception):
        landed.read_statement_json(spark, scratch)


def test_payload_guards(spark):
    df = spark.createDataFrame([("  <html>",), ("\n\t ",), ("Date,Open",), ('[{"a":1}]',), ('{"a":1}',),
                                ("nope",)], "b string")
    csv = [r.s for r in df.select(landed.classify_payload(F.col("b"), "csv").alias("s")).collect()]
    js = [r.s for r in df.select(landed.classify_payload(F.col("b"), "json_array").alias("s")).collect()]
    assert csv == ["html", "empty", "ok", "ok", "ok", "ok"]
    assert js == ["html", "empty", "not_json", "ok", "not_json_array", "not_json"]


def test_require_rows(spark):
    with pytest.raises(EmptyBatchError):
        landed.require_rows(spark.range(0), "nbp")
    assert landed.require_rows(spark.range(1), "nbp").count() == 1


def test_strict_header_reader_raises(spark, scratch):
    _write(scratch, "bad.csv", "when,o,h,l,c,v\n2024-01-02,1,2,0.5,1.5,10\n")
    with pytest.raises(Exception):
        landed.read_price_csv(spark, scratch, None, "stooq", T1, strict_header=True).collect()
    assert landed.read_price_csv(spark, scratch, None, "stooq", T1).count() == 1


def test_union_widens_conflicting_types(spark):
    from tidemark.operators.union import union_all_by_name
    a = spark.createDataFrame([(1, 10)], "id int, x bigint")
    b = spark.createDataFrame([(2, "n/a", 1.5)], "id int, x string, y double")
    c = spark.createDataFrame([(3, 2.5)], "id bigint, y float")
    out = union_all_by_name([a, b, c])
    assert dict(out.dtypes) == {"id": "bigint", "x": "string", "y": "double"}
    assert sorted(tuple(r) for r in out.collect()) == [(1, "10", None), (2, "n/a", 1.5), (3, None, 2.5)]
