"""Value-level behaviour of the cleaning expressions."""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from shared import one_col
from postline.functions import columns as C


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_text_is_stripped_and_blank_is_null(spark):
    df = one_col(spark, ["  Data Engineer  ", "   ", None, "　x ", "None", "NaN", " null "])
    assert values(df, C.clean_text("v")) == ["Data Engineer", None, None, "x", None, None, None]


def test_text_matches_python_strip_for_all_whitespace(spark):
    ws = C.WHITESPACE
    assert len(ws) == 29
    samples = [ws + "a b" + ws[::-1], "\x85q\x1c", "\xa0​z\xa0"]
    df = one_col(spark, samples)
    assert values(df, C.strip("v")) == [s.strip() for s in samples]


def test_reader_na_tokens_only_untrimmed(spark):
    df = one_col(spark, ["NA", "  NA ", "N/A", "#N/A", "<NA>"])
    assert values(df, C.clean_text("v")) == [None, "NA", None, None, None]


def test_bool_variants(spark):
    df = one_col(spark, ["True", "0", "unknown", " yes ", "N", "t", "", None])
    assert values(df, C.clean_bool("v")) == [True, False, None, True, False, True, None, None]


def test_decimal_variants(spark):
    df = one_col(spark, ["1234.50", "", "12,5 k", " 1_000 ", "2.675", "-12.345", "1e3", "12345678901.00"])
    got = values(df, C.clean_decimal("v", 12, 2))
    assert got == [Decimal("1234.50"), None, None, Decimal("1000.00"), Decimal("2.68"), Decimal("-12.35"),
                   Decimal("1000.00"), None]


def test_canon_and_hash_key(spark):
    df = one_col(spark, [" Acme ", "", None])
    assert values(df, C.canon("v")) == ["acme", None, None]
    got = values(df, C.hash_key(C.canon("v")))
    assert got == [hashlib.md5(b"acme").hexdigest(), None, None]


def test_business_key_treats_null_as_empty(spark):
    df = spark.createDataFrame([(" A ", None, True), ("a", "", True)], "t string, u string, b boolean")
    key = C.business_key(["t", "u"], ["b"], ["t", "u", "b"])
    a, b = values(df, key)
    assert a == b  # NULL and '' are the same key part; text is lowered and trimmed


def test_sql_text_and_column_forms_agree(spark):
    vals = ["  x ", "NULL", "yes", "0", " 12.5 ", "nan", "", None]
    df = one_col(spark, vals)
    pairs = [(C.clean_text("v"), C.clean_text_sql("v")), (C.clean_bool("v"), C.clean_bool_sql("v")),
             (C.clean_decimal("v", 8, 2), C.clean_decimal_sql("v", 8, 2))]
    for col_form, sql_form in pairs:
        assert values(df, col_form) == values(df, F.expr(sql_form))
