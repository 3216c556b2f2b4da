"""Cases that the operators' docstrings name and no other test covers."""

from helpers import docs, folder
from postline.llm.decontaminate import contaminated
from postline.llm.simhash import op5_simhash
from postline.llm.url_filter import op8_url_filter


def test_decontaminate_very_long_text_ties_and_short_items(spark):
    item = " ".join(f"b{k}" for k in range(20))
    bench = spark.createDataFrame([(9, item + " left"), (4, "right " + item), (5, "yes"), (6, "of the")], "item_id long, text string")
    long = " ".join(f"w{k % 5000}" for k in range(200_000))
    rows = [(1, long + " " + item), (2, long), (3, "x " + item + " y"), (4, "yes of the"), (5, "Yes."), (6, "of the")]
    got = {r.doc_id: r for r in contaminated(docs(spark, rows), bench).collect()}
    assert set(got) == {1, 3, 5, 6}
    assert all(got[i].n_items == 2 and got[i].item_id == 4 for i in (1, 3))  # both overlaps are as long: the smaller id
    assert got[5].item_id == 5 and got[6].item_id == 6


def test_url_filter_very_long_url_and_repeated_rows(spark, tmp_path):
    long = "http://a.example.com/de/" + "x" * 200_000
    rows = [(1, long, ""), (1, long, ""), (2, "http://" + "y" * 50_000 + ".net/", ""), (2, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.rule or "", r.verdict) for r in op8_url_filter(spark, folder(tmp_path, pages=pages)).collect())
    assert got[:2] == [(1, "example.com/de/", "block")] * 2 and (2, "net/", "block") in got and len(got) == 4


def test_simhash_clashing_columns(spark, tmp_path):
    frame = docs(spark, [(1, "some words here"), (2, "some words here"), (3, None)]).selectExpr(
        "*", "1L AS fp", "2L AS component_id", "'r' AS root", "3L AS first", "4 AS text_hash")
    got = {r.doc_id: r.component_id for r in op5_simhash(spark, folder(tmp_path, documents=frame)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
