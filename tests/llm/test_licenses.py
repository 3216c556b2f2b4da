import duckdb

from helpers import docs, folder
from postline.llm.licenses import KNOWN, ORACLE, op6_license_scan

MIT = KNOWN[-1][1]


def test_equals_the_sql_twin(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "Released under the MIT licence!"), (3, "Copyright 2020 X\n" + MIT.upper().replace("LICENSE", "LICENCE")),
            (3, "Copyright 2020 X\n" + MIT.upper().replace("LICENSE", "LICENCE")), (4, "foo\nLicensed under CC BY-NC 4.0.\n licensed UNDER cc by nc 4.0\nbar"),
            (5, "foo Licensed under\nCC BY-NC 4.0."), (6, "Licensed under\nCC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0."), (7, "é MIT é"),
            (8, "copyright (c) x\nAll rights reserved."), (9, MIT[:-1] + "\n\n (C) Copyright me"), (10, MIT + " and more"), (11, "words " * 50_000)]
    frame = docs(spark, rows).withColumnRenamed("lang", "lines").withColumnRenamed("source", "digest")
    path = folder(tmp_path, documents=frame)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    got = op6_license_scan(spark, path).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(ORACLE).fetchall()))
    whole = {r.doc_id: r.text_license for r in got}
    assert (whole[3], whole[6], whole[9], whole[10], whole[2], whole[8]) == ("MIT", "CC-BY-NC-4.0", "MIT", None, None, None)
    assert next(r for r in got if r.doc_id == 4).n_license_lines == 2


def test_empty_table(spark, tmp_path):
    assert op6_license_scan(spark, folder(tmp_path, documents=docs(spark, []))).collect() == []
