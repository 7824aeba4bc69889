"""Work that must be done once: script counts, profile counts, searches for amounts, texts that are not shuffled with attachments."""
import datetime as dt

import pyspark.sql.functions as F

from paperlane.operators import classify as cl
from paperlane.operators import extract as ex
from paperlane.operators import language as lg
from paperlane.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_script_letters_are_counted_once_a_text(spark):
    df = lg.detect_language(spark.createDataFrame([("это просто текст",), ("これはテストです",), ("中文文字",), (None,)], "text string"))
    assert [r.lang_code for r in df.select("lang_code").collect()] == ["ru", "ja", "zh", "xx"]
    assert _plan(df).count(r"[\p{IsCyrillic}]") <= 2  # the count and the search for any such letter


def test_profiles_read_the_texts_once(spark):
    rows = spark.createDataFrame([("en", "aaa aab"), ("de", "zzz"), (None, "x"), ("fr", None)], "lang string, text string")
    df = lg.learn_profiles(rows, most=2)
    assert _plan(df).count("Generate explode(flatten") == 1
    found = sorted((r.lang, r.gram is None) for r in df.collect())
    assert found == [("de", False), ("de", False), ("de", True), ("en", False), ("en", False), ("en", True)]


def test_an_amount_takes_one_search_a_label(spark):
    df = spark.createDataFrame([("Total: 5 items\nTotal: USD 1,200.50",), ("total 8% 7 EUR",), ("Total 3 kg",), (None,)], "t string")
    out = df.select(ex.amount_after("t", ["total"]).alias("a"))
    assert [None if r.a is None else str(r.a) for r in out.collect()] == ["1200.50", "7.00", None, None]
    assert _plan(out).count("regexp_extract_all(t") == 1


def test_title_kinds_have_one_search_before_them(spark):
    df = cl.classify_rules(spark.createDataFrame([("PURCHASE ORDER\nNo 1",), ("Invoice\nquote",), (None,)], "text string"))
    assert df.select("doc_kind").first()[0] == "purchase order"
    assert _plan(df).lower().count("{0,5}") == 1


def test_texts_are_joined_last(spark, tmp_path):
    d = str(tmp_path)
    ts = dt.datetime(2001, 1, 1)
    spark.createDataFrame([(1, 7, 3, 1, 5.0, 9.0, "A", "O", ts), (1, 7, 3, 2, 5.0, 9.0, "A", "O", ts), (2, 8, 3, None, 5.0, 9.0, "R", "O", ts)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(1, 1, 10.0, ts), (1, 1, 10.0, ts)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"
                          ).write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(3, "S")], "s_suppkey long, s_name string").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(7, "prose"), (7, "prose")], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    df = fx.attachments_with_text(spark, d)
    got = [(r.line_no, (r.ocr_text or "-")[:5]) for r in df.collect()]
    # an id that comes twice on each side gives four rows of a line
    assert sorted(got, key=str) == sorted([(1, "INVOI")] * 4 + [(2, "prose")] * 4 + [(None, "-")], key=str)
    union = df.where(F.col("ocr_text").isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert union.startswith("Union")
