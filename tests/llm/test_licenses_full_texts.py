from pathlib import Path

import duckdb

from helpers import docs, folder
from postline.llm import licenses
from postline.llm.licenses import BSD_END, BSD_NAMES, BSD_START, KNOWN, ORACLE, op6_license_scan

MIT = KNOWN[-1][1].split("\n", 1)[1]


def test_full_texts_titles_and_unicode_signs(spark, tmp_path):
    texts = {f.stem: f.read_text() for f in sorted(Path(licenses.__file__).with_name("license_texts").glob("*.txt"))}
    cases = [(name, text) for name, text in texts.items()]
    cases += [("Apache-2.0", texts["Apache-2.0"].split("END OF TERMS")[0]), (None, texts["Apache-2.0"] + "\nand more"),
              ("MIT", MIT), ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Name\n" + MIT),
              ("MIT", "MIT License\n© 2020 Name\n" + MIT.replace('"Software"', "“Software”").replace(", ", ", ")),
              ("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2020, Name\nAll rights reserved.\n\n" + BSD_START + BSD_END),
              ("BSD-3-Clause", BSD_START + BSD_NAMES + BSD_END.replace('"', "”")), (None, BSD_START + BSD_NAMES)]
    frame = docs(spark, [(i, text) for i, (_, text) in enumerate(cases)])
    path = folder(tmp_path, documents=frame)
    got = op6_license_scan(spark, path).collect()
    assert {r.doc_id: r.text_license for r in got} == {i: name for i, (name, _) in enumerate(cases)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(ORACLE).fetchall()))
