"""Python-literal list/dict cells → typed nested columns.

Source cells hold Python literals such as ``['python', 'sql']`` or
``{'cloud': ['aws']}``.  The plain, common shape is recognised by a guard
regex and parsed by ``from_json`` (JVM, codegen).  Only cells outside the
guard (unquoted ``None``, numbers, trailing commas, scalar dict values,
escapes…) go to a vectorised pandas UDF that reads the literal and hands back
JSON; all cleaning afterwards is the same higher-order-function code for both
paths.
"""

from __future__ import annotations

import ast
import json
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline.functions.columns import NULL_WORDS, is_null_like, null_like_sql, sql_in, sql_literal, strip, strip_sql

LIST_TYPE = T.ArrayType(T.StringType())
MAP_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# Guard: quoted items without backslashes/control characters, spaces only
# between tokens, whole cell.  On such text from_json(allowSingleQuotes)
# reads exactly what the Python literal reader reads.  All repeats are
# possessive: nothing is given back, so the matcher needs no stack per item.
_TOK = r"""(?:'[^'"\\\x00-\x1f]*+'|"[^"\\\x00-\x1f]*+")"""
_ITEMS = rf"\[ *+(?:{_TOK} *+(?:, *+{_TOK} *+)*+)?+\]"
LIST_GUARD = rf"\A *+{_ITEMS} *+\z"
DICT_GUARD = rf"\A *+\{{ *+(?:{_TOK} *+: *+{_ITEMS} *+(?:, *+{_TOK} *+: *+{_ITEMS} *+)*+)?+\}} *+\z"

# The guarded cells that cleaning leaves as they are: items and keys begin and end with a printable
# ASCII character that is no space and are no null word, and a dict has no empty list.
_EDGE = r"""[!#-&(-\[\]-~]"""
_WORD = rf"""(?![Nn](?:[Uu][Ll][Ll]|[Oo][Nn][Ee]|[Aa][Nn])['"]){_EDGE}"""
_CLEAN_TOK = rf"""(?:'{_WORD}[^'"\\\x00-\x1f]*+(?<={_EDGE})'|"{_WORD}[^"\\\x00-\x1f]*+(?<={_EDGE})")"""
_CLEAN_ITEMS = rf"\[ *+{_CLEAN_TOK} *+(?:, *+{_CLEAN_TOK} *+)*+\]"
CLEAN_LIST = rf"\A *+{_CLEAN_ITEMS} *+\z"
CLEAN_DICT = rf"\A *+\{{ *+{_CLEAN_TOK} *+: *+{_CLEAN_ITEMS} *+(?:, *+{_CLEAN_TOK} *+: *+{_CLEAN_ITEMS} *+)*+\}} *+\z"

_JSON_OPTS = {"allowSingleQuotes": "true"}


def _as_text(v):
    """Item → text the way the reference's text cleaner sees it (None stays None)."""
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v if isinstance(v, str) else str(v)


def _literal_to_json(text: str, want: str) -> str | None:
    """Read one literal; give JSON of the shape ``want`` or None when invalid.

    list → ``[item, ...]``; dict → ``[{"key": k, "value": [item, ...]}, ...]``
    (an entry list keeps order and keys that are not strings).  Items are
    text or null; a scalar dict value becomes a one-item list.
    """
    try:
        value = ast.literal_eval(text.strip())
    except Exception:  # syntax errors, unhashable keys, deep nesting…
        return None
    if want == "list":
        if not isinstance(value, list):
            return None
        return json.dumps([_as_text(v) for v in value])
    if not isinstance(value, dict):
        return None
    return json.dumps([
        {"key": _as_text(k), "value": [_as_text(x) for x in (v if isinstance(v, list) else [v])]}
        for k, v in value.items()
    ])


@F.pandas_udf(T.StringType())
def _list_fallback(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else _literal_to_json(t, "list"))


@F.pandas_udf(T.StringType())
def _dict_fallback(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else _literal_to_json(t, "dict"))


_ENTRY_LIST = T.ArrayType(
    T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.ArrayType(T.StringType())),
    ])
)


def clean_item(x: Column) -> Column:
    """Text of one list item or dict key: stripped; NULL for None and null words.

    (The reader's NA tokens apply to whole cells, not to items inside a literal.)
    """
    s = strip(x)
    return F.when(~F.lower(s).isin(NULL_WORDS), s)


def _clean_items(arr: Column) -> Column:
    return F.filter(F.transform(arr, strip), lambda x: x.isNotNull() & ~F.lower(x).isin(NULL_WORDS))


def parse_list(c: str | Column) -> Column:
    """Cleaned ``array<string>``; NULL when missing, invalid or empty."""
    raw = F.col(c) if isinstance(c, str) else c
    missing = is_null_like(raw)
    guarded = raw.rlike(LIST_GUARD)
    fast = F.from_json(raw, LIST_TYPE, _JSON_OPTS)
    # only unguarded cells carry text into Python; the rest pass as NULL
    slow = F.from_json(_list_fallback(F.when(~missing & ~guarded, raw)), LIST_TYPE)
    parsed = F.when(missing, F.lit(None).cast(LIST_TYPE)).when(guarded, fast).otherwise(slow)
    cleaned = _clean_items(parsed)
    return F.when(F.size(cleaned) > 0, cleaned)


def parse_map(c: str | Column) -> Column:
    """Cleaned ``map<string, array<string>>``.

    Keys and items are stripped; blank keys and empty lists are dropped; a
    scalar value counts as a one-item list; of keys equal after stripping the
    last one wins (session policy LAST_WIN) and keeps the first one's place.
    NULL when missing, invalid or empty.
    """
    raw = F.col(c) if isinstance(c, str) else c
    missing = is_null_like(raw)
    guarded = raw.rlike(DICT_GUARD)
    fast = F.map_entries(F.from_json(raw, MAP_TYPE, _JSON_OPTS))
    slow = F.from_json(_dict_fallback(F.when(~missing & ~guarded, raw)), _ENTRY_LIST)
    entries = F.when(missing, F.lit(None).cast(_ENTRY_LIST)).when(guarded, fast).otherwise(slow)
    cleaned = F.filter(
        F.transform(entries, lambda e: F.struct(clean_item(e["key"]).alias("key"),
                                                _clean_items(e["value"]).alias("value"))),
        lambda e: e["key"].isNotNull() & (F.size(e["value"]) > 0),
    )
    return F.when(F.size(cleaned) > 0, F.map_from_entries(cleaned))


def missing_flag(c: str | Column) -> Column:
    """The cell holds no value at all."""
    return is_null_like(F.col(c) if isinstance(c, str) else c)


def invalid_flag(c: str | Column, parsed: Column) -> Column:
    """The cell has a value but it parsed to nothing usable."""
    return ~missing_flag(c) & parsed.isNull()


# --- SQL text of the same parse (one parse call per column) -----------------

LIST_UDF = "postline_list_literal"
DICT_UDF = "postline_dict_literal"
_ENTRY_LIST_SQL = "array<struct<key:string,value:array<string>>>"


def register_udfs(spark) -> None:
    """Make the fallback literal readers callable from SQL text."""
    spark.udf.register(LIST_UDF, _list_fallback)
    spark.udf.register(DICT_UDF, _dict_fallback)


def _item_sql(v: str) -> str:
    return f"CASE WHEN NOT lower({strip_sql(v)}) IN {sql_in(NULL_WORDS)} THEN {strip_sql(v)} END"


def _items_sql(arr: str) -> str:
    return (f"filter(transform({arr}, v -> {strip_sql('v')}), "
            f"v -> v IS NOT NULL AND NOT lower(v) IN {sql_in(NULL_WORDS)})")


def _read_sql(x: str, guard: str, fast: str, udf: str, brackets: str, shape: str) -> str:
    """A guarded cell by ``fast``, any other one by the literal reader (NULL if missing/invalid).

    No missing cell is guarded, so only the others are looked at for it.  A literal holds both of its
    brackets, so a cell without them is invalid without being read.
    """
    guarded = f"{x} RLIKE {sql_literal(guard)}"
    held = " AND ".join(f"contains({x}, '{b}')" for b in brackets)
    return (f"CASE WHEN {guarded} THEN {fast} ELSE from_json({udf}("
            f"CASE WHEN {guarded} THEN NULL WHEN {held} AND NOT {null_like_sql(x)} THEN {x} END), '{shape}') END")


def parsed_list_sql(x: str) -> str:
    """Read step of E1: the literal as ``array<string>`` before cleaning (NULL if missing/invalid)."""
    return _read_sql(x, LIST_GUARD, f"from_json({x}, 'array<string>', map('allowSingleQuotes', 'true'))", LIST_UDF, "[]", "array<string>")


def parsed_map_sql(x: str) -> str:
    """Read step of E2: the literal as an entry list before cleaning."""
    return _read_sql(x, DICT_GUARD, f"map_entries(from_json({x}, 'map<string,array<string>>', map('allowSingleQuotes', 'true')))",
                     DICT_UDF, "{}", _ENTRY_LIST_SQL)


def clean_list_cell_sql(x: str) -> str:
    """Whether a cell is a list that cleaning leaves as it is."""
    return f"coalesce({x} RLIKE {sql_literal(CLEAN_LIST)}, false)"


def clean_dict_cell_sql(x: str) -> str:
    """Whether a cell is a dict that cleaning leaves as it is."""
    return f"coalesce({x} RLIKE {sql_literal(CLEAN_DICT)}, false)"


def cleaned_list_sql(parsed: str, clean: str = "false") -> str:
    """Cleaned items; rows for which ``clean`` holds are known to need no cleaning."""
    return f"CASE WHEN {clean} THEN {parsed} ELSE {_items_sql(parsed)} END"


def cleaned_entries_sql(parsed: str, clean: str = "false") -> str:
    return (f"CASE WHEN {clean} THEN {parsed} ELSE "
            f"filter(transform({parsed}, e -> named_struct('key', {_item_sql('e.key')}, "
            f"'value', {_items_sql('e.value')})), e -> e.key IS NOT NULL AND size(e.value) > 0) END")
