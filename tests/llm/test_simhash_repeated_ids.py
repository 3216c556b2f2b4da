from helpers import docs
from postline.llm.simhash import keep_first_of_group


def test_each_component_keeps_one_row_where_ids_repeat(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(5, a), (9, a), (5, b), (1, b), (7, c), (7, c), (7, c + " end"), (None, a)]
    kept = sorted((r.doc_id or 0, r.text) for r in keep_first_of_group(docs(spark, rows)).collect())
    assert [x for x in kept if x[1] == a] == [(0, a), (5, a)] and [x for x in kept if x[1] == b] == [(1, b)]
    assert len([x for x in kept if x[1].startswith(c)]) in (1, 2) and (5, b) not in kept
    assert [x for x in kept if x[1] == c] in ([], [(7, c)])


def test_equal_rows_with_unlike_other_columns(spark):
    rows = docs(spark, [(1, "some words"), (1, "some words"), (2, "other words here")]).withColumnRenamed("lang", "_simhash_n")
    kept = keep_first_of_group(rows)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
