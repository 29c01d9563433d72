import pytest
from oracle import canonical, connect
from pyspark.sql import functions as F
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.revisits import canonical_url, merged_headers, plain_headers, resolve_revisits

RECORDS = (
    "record_id long, url string, ts long, is_revisit boolean, etag string, modified string, digest string,"
    " headers map<string,string>"
)
A = "http://www.Site.org:80/a/?b=2&utm_source=x&a=1#top"


@pytest.mark.parametrize(
    "url, want",
    [
        (A, "site.org/a?a=1&b=2"),
        ("HTTPS://site.org/a?a=1&b=2", "site.org/a?a=1&b=2"),
        ("http://m.site.org", "m.site.org"),
        ("http://site.org/?ref=q", "site.org"),
        ("site.org:8080/A/B//", "site.org:8080/A/B"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(canonical_url(F.col("u"))).first()[0] == want


def answers(spark, *rows):
    got = resolve_revisits(spark.createDataFrame(list(rows), RECORDS).withColumn("site", F.lit("mine"))).collect()
    return sorted((str(r.record_id), r.status, r.refers_to, r.headers) for r in got)


def test_validators_and_order(spark):
    full = {"ETag": "t", "Content-Length": "9", "X": "old"}
    rows = [
        (1, A, 10, False, '"t1"', "m1", "d1", full),
        (2, "https://site.org/a?a=1&b=2", 20, False, '"t2"', None, "d2", None),
        (11, A, 15, True, 'W/"t1"', "other", "d9", {"content-length": "0", "x": "new", "Date": "d"}),
        (12, A, 10, True, '"t1"', None, None, None),
        (13, A, 20, True, None, "m1", None, None),
        (14, A, 21, True, '"t1"', None, "d2", None),
        (15, A, 22, True, None, "m1", None, None),
        (16, A, 23, True, None, None, "d2", None),
        (17, A, 24, True, None, None, None, None),
        (18, "http://else.org/", 99, True, '"t1"', None, None, None),
        (19, None, 99, True, '"t1"', None, None, None),
        (20, A, None, True, '"t1"', None, None, None),
        (None, A, 15, True, '"t1"', None, None, {}),
    ]
    kept = {"etag": "t", "content-length": "9", "x": "old"}
    assert answers(spark, *rows) == sorted(
        [
            ("11", "etag", 1, {**kept, "x": "new", "date": "d"}),
            ("12", "missing", None, None),
            ("13", "modified", 1, kept),
            ("14", "mismatch", None, None),
            ("15", "unverified", None, None),
            ("16", "digest", 2, {}),
            ("17", "unverified", None, None),
            ("18", "missing", None, None),
            ("19", "missing", None, None),
            ("20", "missing", None, None),
            ("None", "etag", 1, kept),
        ]
    )


def test_ties_and_repeated_rows(spark):
    one = (1, A, 10, False, '"a"', None, "d1", None)
    two = (2, A, 10, False, '"b"', None, "d2", None)
    again = (9, A, 11, True, '"b"', None, None, None)
    assert answers(spark, one, two, two, again, again) == [("9", "etag", 2, {})] * 2


def test_a_hot_url_spreads(spark):
    rows = [(i, A, i, i % 3 > 0, f'"{i - i % 3}"', None, None, None) for i in range(3000)]
    got = answers(spark, *rows)
    assert len(got) == 2000 and all(s == "etag" and to == int(i) - int(i) % 3 for i, s, to, _ in got)


def test_empty_table_and_headers(spark):
    assert answers(spark) == []
    df = spark.createDataFrame([({"A": "1", "a": "2", "ETag": "x"}, {"a": "3", "Content-Type": "t"})], "r map<string,string>, v map<string,string>")
    got = df.select(merged_headers(plain_headers(F.col("r")), plain_headers(F.col("v")))).first()[0]
    assert got == {"a": "3", "etag": "x"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    rows, want = QUERIES[name](spark, folder).toPandas(), connect(folder).execute(SQL[name]).df()
    assert canonical(rows) == canonical(want)
