"""Column expressions for cleaning, canonical names and hash keys.

Every function returns a ``Column`` made of built-in Spark expressions, so all
of them stay inside whole-stage codegen and can be used in any ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (they decide results and must stay as they are).
#
# Words that mean "no value" after stripping and lower-casing.
NULL_WORDS = ["", "null", "none", "nan"]
# NA tokens of the pandas CSV reader (its public defaults), matched on the
# untrimmed cell; a source read that way turns them into NULL before cleaning.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]
# Separator of the parts of a business key or an assignment key.
KEY_SEPARATOR = "||"
# ---------------------------------------------------------------------------

# Every code point Python's str.strip() removes (29 of them), built by rule.
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


# --- SQL text of the same expressions --------------------------------------
# Building a long expression through the Column API costs one driver→JVM call
# per node; the SQL text of a whole column is parsed in one call.  Both give
# the same Catalyst expression.

def sql_literal(text: str) -> str:
    """A Spark SQL string literal for any text (unicode escapes for non-ASCII)."""
    out = []
    for ch in text:
        if ch in ("\\", "'"):
            out.append("\\" + ch)
        elif 32 <= ord(ch) < 127:
            out.append(ch)
        else:
            out.append("\\u%04x" % ord(ch) if ord(ch) < 0x10000 else ch)
    return "'" + "".join(out) + "'"


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


WS_SQL = sql_literal(WHITESPACE)


def sql_in(values) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


def strip_sql(x: str) -> str:
    return f"trim(BOTH {WS_SQL} FROM {x})"


def null_like_sql(x: str, s: str | None = None) -> str:
    s = s or strip_sql(x)
    return f"({x} IS NULL OR {x} IN {sql_in(PANDAS_NA_TOKENS)} OR lower({s}) IN {sql_in(NULL_WORDS)})"


def clean_text_sql(x: str, s: str | None = None) -> str:
    s = s or strip_sql(x)
    return f"CASE WHEN {null_like_sql(x, s)} THEN NULL ELSE {s} END"


def clean_bool_sql(x: str, s: str | None = None) -> str:
    s = s or strip_sql(x)
    return (f"CASE WHEN {null_like_sql(x, s)} THEN CAST(NULL AS BOOLEAN) "
            f"WHEN lower({s}) IN {sql_in(TRUE_WORDS)} THEN true "
            f"WHEN lower({s}) IN {sql_in(FALSE_WORDS)} THEN false END")


def clean_decimal_sql(x: str, precision: int, scale: int = 2, s: str | None = None) -> str:
    s = s or strip_sql(x)
    text = f"CASE WHEN instr({s}, '_') > 0 THEN regexp_replace({s}, '(?<=[0-9])_(?=[0-9])', '') ELSE {s} END"
    return f"CASE WHEN {null_like_sql(x, s)} THEN NULL ELSE try_cast({text} AS DECIMAL({precision},{scale})) END"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading/trailing Unicode whitespace like Python's ``str.strip``.

    Plain ``trim`` drops only spaces; ``trim(BOTH set FROM x)`` with the
    whitespace set is a character scan, no regex.
    """
    return F.trim(_col(c), F.lit(WHITESPACE))


def is_pandas_na(c: str | Column) -> Column:
    """True when a CSV reader with pandas defaults would read the cell as NA."""
    return _col(c).isin(PANDAS_NA_TOKENS)


def _stripped(c: str | Column, stripped: Column | None) -> Column:
    return stripped if stripped is not None else strip(c)


def is_null_like(c: str | Column, stripped: Column | None = None) -> Column:
    """NULL, an NA token, or a blank/null word after strip+lower.

    ``stripped`` may pass an already stripped copy of the column.
    """
    x = _col(c)
    return x.isNull() | is_pandas_na(x) | F.lower(_stripped(x, stripped)).isin(NULL_WORDS)


def clean_text(c: str | Column, stripped: Column | None = None) -> Column:
    """Stripped text, NULL when null-like or blank."""
    s = _stripped(c, stripped)
    return F.when(~is_null_like(c, s), s)


def clean_bool(c: str | Column, stripped: Column | None = None) -> Column:
    """Tri-state boolean from the usual spellings; anything else is NULL."""
    s = _stripped(c, stripped)
    word = F.lower(s)
    return (
        F.when(is_null_like(c, s), F.lit(None).cast("boolean"))
        .when(word.isin(TRUE_WORDS), F.lit(True))
        .when(word.isin(FALSE_WORDS), F.lit(False))
    )


def clean_decimal(c: str | Column, precision: int, scale: int = 2, stripped: Column | None = None) -> Column:
    """P5: decimal(precision, scale); unparsable or out-of-range text is NULL.

    Underscores between digits are accepted (``1_000``) as Python's Decimal
    does; the cast rounds half away from zero like a NUMERIC column.
    """
    s = _stripped(c, stripped)
    text = F.when(s.contains("_"), F.regexp_replace(s, r"(?<=[0-9])_(?=[0-9])", "")).otherwise(s)
    return F.when(~is_null_like(c, s), text.try_cast(f"decimal({precision},{scale})"))


def canon(c: str | Column) -> Column:
    """Canonical name ``nullif(lower(trim(x)), '')``."""
    return F.nullif(F.lower(F.trim(_col(c))), F.lit(""))


def hash_key(c: str | Column) -> Column:
    """md5 surrogate key; NULL in, NULL out."""
    return F.md5(_col(c))


def key_part_text(c: str | Column) -> Column:
    """Business-key part of a text column: ``coalesce(lower(trim(x)), '')``."""
    return F.coalesce(F.lower(F.trim(_col(c))), F.lit(""))


def key_part_value(c: str | Column) -> Column:
    """Business-key part of a typed column: ``coalesce(cast(x as string), '')``."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def business_key(text_cols: Sequence[str], value_cols: Sequence[str],
                 order: Sequence[str]) -> Column:
    """md5 over the normalised key columns joined by ``||``.

    ``order`` lists every key column in key order; text columns are lowered
    and trimmed, typed ones cast to text.  NULL contributes ''.
    """
    text = set(text_cols)
    value = set(value_cols)
    parts = []
    for name in order:
        if name in text:
            parts.append(key_part_text(name))
        elif name in value:
            parts.append(key_part_value(name))
        else:
            raise ValueError(f"key column {name!r} is neither text nor value")
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def assignment_id(*parts: str | Column) -> Column:
    """P10: md5 of the parts cast to text and joined by ``||``."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_col(p).cast("string") for p in parts]))


def non_blank(c: str | Column) -> Column:
    """P12 predicate: not NULL and not '' after trimming."""
    x = _col(c)
    return x.isNotNull() & (F.trim(x) != F.lit(""))


def sorted_text(arr: str | Column, sep: str = "|") -> Column:
    """Flatten an array to sorted text (for reports and comparisons)."""
    return F.array_join(F.array_sort(_col(arr)), sep)


def map_text(m: str | Column) -> Column:
    """Flatten ``map<string, array<string>>`` to ``k:a,b;k2:c`` with sorted keys."""
    entries = F.array_sort(F.map_entries(_col(m)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ","))),
        ";",
    )
