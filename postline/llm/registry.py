"""The registered queries of this subpackage: name -> (Spark callable, DuckDB twin or None)."""

from __future__ import annotations

from postline.llm import (
    collocations, decontaminate, graph_search, html_extract, licenses, line_dedup, merkle, pii, sentence_pieces, simhash,
    token_codes, toxicity, url_filter,
)

REGISTRY = {
    "op1_toxicity": (toxicity.op1_toxicity, None),
    "op2_pii_spans": (pii.op2_pii_spans, None),
    "op3_token_codes": (token_codes.op3_token_codes, None),
    "op4_nearest": (graph_search.op4_nearest, None),
    "op5_simhash": (simhash.op5_simhash, None),
    "op6_license_scan": (licenses.op6_license_scan, licenses.ORACLE),
    "op7_decontaminate": (decontaminate.op7_decontaminate, None),
    "op8_url_filter": (url_filter.op8_url_filter, url_filter.ORACLE),
    "op9_line_dedup": (line_dedup.op9_line_dedup, None),
    "op10_sentencepiece": (sentence_pieces.op10_sentencepiece, None),
    "op11_merkle_manifest": (merkle.op11_merkle_manifest, merkle.ORACLE),
    "op12_html_extract": (html_extract.op12_html_extract, None),
    "op13_collocations": (collocations.op13_collocations, collocations.ORACLE),
}
