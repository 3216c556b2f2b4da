import duckdb
import pytest

from helpers import folder
from postline.llm import url_filter
from postline.llm.url_filter import ORACLE, Rule, glob_rule, judge_urls, op8_url_filter, site_rule

URLS = [None, "", "foo", "http://NET", "http://net/", "http://a.Net/x?y", "http://a.Net/x?y", "x://org/fr/", "http://org/fr",
        "http://casino-x.org/", "http://xcasino-x.org/", "https://www.example.net/en/1", "https://example.net/enx",
        "https://example.com/de/?q#f", "https://notexample.com/de/", "ftp://a://b/c", "http://h?x/y", "http://h#/net/",
        "http://x.net:80/", "http://ADS-TRACK.example/\nz", "http://é.net/é", "http://a.b/adserver/x", "http://a.b/xadserver/"]


def pages(spark, urls):
    return spark.createDataFrame([(k if k % 5 else None, u, "") for k, u in enumerate(urls)], "page_id long, url string, host string")


@pytest.mark.parametrize("most", [20_000, 0])
def test_equals_the_sql_twin(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", most)
    path = folder(tmp_path, pages=pages(spark, URLS))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/pages.parquet/*.parquet'")
    assert sorted(map(repr, map(tuple, op8_url_filter(spark, path).collect()))) == sorted(map(repr, con.execute(ORACLE).fetchall()))


def test_a_rule_is_filed_under_its_rarest_whole_token(spark):
    rules = [site_rule("common.rare", "/x/", "block"), glob_rule("^common^", "block")]
    urls = [f"http://common.site{k}/x/" for k in range(9)] + ["http://common.rare/x/"]
    frame = url_filter.with_host_and_path(pages(spark, urls).drop("host")).withColumn(
        "tokens", url_filter._tokens(url_filter.F.concat("host", "path")))
    assert {r.name: r.token for r in url_filter.rule_index(frame, rules).collect()} == {
        "common.rare/x/": "rare", "^common^": "common"}
    assert glob_rule("part*whole-x", "block").tokens == () and glob_rule("^a-bc", "block").tokens == ("a",)


def test_rules_without_a_token_and_empty_tables(spark):
    rules = [Rule("any z", "z", (), "block", 1)]
    got = {r.url: r.verdict for r in judge_urls(pages(spark, ["http://az/", "http://b/"]), rules).collect()}
    assert got == {"http://az/": "block", "http://b/": "allow"}
    assert judge_urls(pages(spark, ["x"]).limit(0)).collect() == []
