"""URL predicates and index operators on literal rows."""
from pyspark.sql import functions as F

from textsift.functions import urls as U
from textsift.operators import index as IX


def test_country_url(spark):
    rows = [("http://x.pt/", "pt,x)/", True), ("http://x.com/pt/", "com,x)/pt/", True),
            ("http://x.com/pt-a", "com,x)/pt-a", True), ("http://x.com/a/pt", "com,x)/a/pt", True),
            ("http://x.pt", "pt,x)/", True), ("http://x.com/apt", "com,x)/apt", False), (None, "x", False)]
    df = spark.createDataFrame(rows, "url string, surt string, want boolean")
    got = df.select(U.country_url(F.col("url"), F.col("surt")).alias("g"), "want").collect()
    assert all(r["g"] == r["want"] for r in got)


def test_foreign_variant(spark):
    rows = [("http://a.com.br/", False), ("http://www.brown.example/", False), ("http://a.com/pt-brasil", False),
            ("http://a.com/x", True), (None, False)]
    df = spark.createDataFrame(rows, "url string, want boolean")
    got = df.select(U.not_foreign_variant(F.col("url")).alias("g"), "want").collect()
    assert all(r["g"] == r["want"] for r in got)


def test_netloc(spark):
    df = spark.createDataFrame([("http://u@h.pt:80/a",), ("http://a b/",), ("",)], "url string")
    got = [r[0] for r in df.select(U.netloc(F.col("url"))).collect()]
    assert got[0] == "u@h.pt:80" and got[1] is None and got[2] in (None, "")


def test_batch_numbers_are_global_row_numbers(spark):
    rows = [(f"s{i:04d}", "2008", f"u{i}") for i in range(2500)]
    df = spark.createDataFrame(rows, "surt string, timestamp string, url string")
    out = IX.fetch_list(df, batch=990, partitions=7).collect()
    by = {r["surt"]: r["batch"] for r in out}
    assert by["s0000"] == 0 and by["s0989"] == 0 and by["s0990"] == 1 and by["s2499"] == 2


def test_dedup_index_global(spark):
    rows = [("a", "1", "u1"), ("a", "1", "u1"), ("a", "2", "u1"), ("b", "1", "u2")] * 300
    df = spark.createDataFrame(rows, "surt string, timestamp string, url string")
    assert IX.dedup_index(df).count() == 3
