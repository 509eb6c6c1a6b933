import pytest

from annualis.llm import queries, url_filter
from tests.parity import compare, connect

URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.org/es/page?x=/en/1#y", "http://a.example.org/en/1", "http://example.org/en/2",
    "http://myexample.org/es/x", "http://example.org", "http://org/", "x://shop.com/fr/a", "http://shop.com/de/a?b", "http://shop.com/en/a",
    "http://casino.net/a", "http://www.casino.net/a/", "HTTP://CASINO.NET/a#top", "http://casino.net/b", "http://a.net?u=http://casino.net/a",
    "http://ÄÖ.com/fr/é", "http://user:pw@shop.com:80/de/", "http://a.net/" + "x" * 50_000, "://z.org/q", "a://b://c.com/fr/",
]
RULES_BY_HAND = {4: ("example.org/es/", "block"), 5: ("example.org/en/1", "block"), 6: ("org/", "allow"), 7: ("org/", "allow"), 9: ("org/", "allow"),
                 10: ("com/fr/", "allow"), 11: ("com/de/", "block"), 18: ("com/fr/", "allow"), 21: ("org/", "allow")}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, u, "<p>", "x") for k, u in enumerate(URLS)] + [(13, URLS[13], None, "x"), (None, URLS[14], None, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, entry string")


def test_rules_hosts_and_list(pages, spark):
    listed = spark.createDataFrame([("https://casino.net/a",), (None,), ("nothing",)], "url string")
    out = {r["page_id"]: r for r in url_filter.judge_urls(pages, listed).collect()}
    for k, (rule, verdict) in RULES_BY_HAND.items():
        assert (out[k]["rule"], out[k]["verdict"]) == (rule, verdict), URLS[k]
    assert all(out[k]["rule"] is None for k in out if k is not None and k not in RULES_BY_HAND)
    assert {k for k, r in out.items() if r["listed"]} == {13, 14, 15, None}
    assert out[13]["verdict"] == "block" and out[16]["verdict"] == "allow" and out[17]["verdict"] == "allow"
    assert (out[4]["host"], out[4]["path"]) == ("example.org", "/es/page") and (out[0]["host"], out[2]["path"]) == ("", "")
    assert out[19]["host"] == "user:pw@shop.com:80" and len(out[20]["path"]) == 50_001


def test_sql_agrees(pages, spark, tmp_path):
    pages.select("page_id", "url").filter("page_id is not null").dropDuplicates(["page_id"]).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = connect(str(tmp_path / "none")) if (tmp_path / "none").exists() else __import__("duckdb").connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert compare(queries.QUERIES["op8_url_bloom"](spark, str(tmp_path)), con, queries.ORACLE["op8_url_bloom"]) == []


def test_large_lists_and_false_positives(spark, monkeypatch):
    """A filter with hardly a bit for each entry, joined by shuffle: the exact join removes what it lets through."""
    monkeypatch.setattr(url_filter, "BITS_PER_ENTRY", 1)
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", 0)
    pages = spark.range(4_000).selectExpr("id as page_id", "concat('http://h', id % 7, '.net/', id) as url")
    out = url_filter.judge_urls(pages, pages.filter("page_id % 3 = 0").select("url"))
    assert out.filter("listed").count() == pages.filter("page_id % 3 = 0").count()
    assert out.filter("listed and page_id % 3 <> 0").count() == 0 and out.count() == 4_000


def test_no_list_no_pages(pages, spark):
    none = pages.filter("false")
    assert url_filter.judge_urls(pages, none.select("url")).filter("listed").count() == 0
    assert url_filter.judge_urls(none, pages.select("url")).count() == 0
