"""Literal list/dict cells (E1–E3): stated results per case, invariants over generated items."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shared import one_col
from postline.functions.literals import invalid_flag, missing_flag, parse_list, parse_map

LISTS = {
    "['rust', 'go', 'sql']": ["rust", "go", "sql"],
    "[ 'rust' ,'go' ]": ["rust", "go"],
    "[broken": None,
    "plain words": None,
    "[]": None,
    "['   ', '']": None,
    "['x', None, 'NULL', ' \\t', 'nan']": ["x"],
    "['N/A', ' y ']": ["N/A", "y"],
    "[\"o'clock\", 'z']": ["o'clock", "z"],
    "['trailing',]": ["trailing"],
    "['one', 2, 3.5, True]": ["one", "2", "3.5", "True"],
    "('a', 'b')": None,
    "{'a': ['b']}": None,
    "  ": None,
}

MAPS = {
    "{'db': ['sql', 'redis'], 'lang': ['go']}": {"db": ["sql", "redis"], "lang": ["go"]},
    "{'db': ['sql', ' '], ' ': ['x'], 'none': []}": {"db": ["sql"]},
    "{}": None,
    "{no dict": None,
    "{'db': 'sql'}": {"db": ["sql"]},
    "{' k': ['old'], 'k ': ['new']}": {"k": ["new"]},
    "{'k': ['kept'], ' k': []}": {"k": ["kept"]},
    "{7: ['x'], 'b': [None, 'y']}": {"7": ["x"], "b": ["y"]},
    "{['k']: ['x']}": None,
    "['a']": None,
}


def run_list(spark, cells):
    return [r.p for r in one_col(spark, cells).select(parse_list("v").alias("p")).collect()]


def run_map(spark, cells):
    rows = one_col(spark, cells).select(parse_map("v").alias("p")).collect()
    return [None if r.p is None else dict(r.p) for r in rows]


def test_list_cases(spark):
    assert dict(zip(LISTS, run_list(spark, list(LISTS)))) == LISTS
    assert run_list(spark, [None]) == [None]


def test_map_cases(spark):
    assert dict(zip(MAPS, run_map(spark, list(MAPS)))) == MAPS
    assert run_map(spark, [None]) == [None]


def test_missing_versus_invalid(spark):
    df = one_col(spark, ["", None, "N/A", "[]", "{}", "bad", "['x']"])
    parsed = parse_list("v")
    rows = df.select(missing_flag("v").alias("m"), invalid_flag("v", parsed).alias("i")).collect()
    assert [(r.m, r.i) for r in rows] == [(True, False), (True, False), (True, False), (False, True),
                                          (False, True), (False, True), (False, False)]


def test_cells_with_very_many_items(spark):
    n = 100_000
    items = [f"s{k}" for k in range(n)]
    cell = "[" + ", ".join(f"'{s}'" for s in items) + "]"
    assert run_list(spark, [cell, cell[:-1]]) == [items, None]
    keyed = "{" + ", ".join(f"'k{k}': ['{s}', 'x']" for k, s in enumerate(items)) + "}"
    one_key = "{'k': " + cell + "}"
    got = one_col(spark, [keyed, one_key]).select(parse_map("v").alias("p")).selectExpr(
        "size(p) AS n", "size(map_values(p)[0]) AS m").collect()
    assert [tuple(r) for r in got] == [(n, 2), (1, n)]


# Words that are values whatever stands around them, and things that never are.
_word = st.text(alphabet=st.characters(categories=("L", "N", "P", "S")), min_size=1, max_size=8).filter(
    lambda s: s.lower() not in {"null", "none", "nan"})
_pad = st.sampled_from(["", " ", "  "])
_nothing = st.sampled_from([None, "", "   ", "null", " None", "NaN ", "NONE"])
_slot = st.one_of(st.tuples(_pad, _word, _pad), _nothing)


def _cell_item(slot):
    return "".join(slot) if isinstance(slot, tuple) else slot


def _values(slots):
    return [slot[1] for slot in slots if isinstance(slot, tuple)]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_slot, max_size=6), min_size=1, max_size=8), st.booleans())
def test_property_lists_keep_their_words(spark, rows, spaced):
    sep = " , " if spaced else ","
    cells = ["[" + sep.join(repr(_cell_item(s)) for s in slots) + "]" for slots in rows]
    assert run_list(spark, cells) == [_values(slots) or None for slots in rows]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(_word, st.lists(_slot, max_size=4), max_size=4), min_size=1, max_size=6), _pad)
def test_property_maps_keep_their_words(spark, rows, pad):
    cells = [repr({pad + k: [_cell_item(s) for s in slots] for k, slots in row.items()}) for row in rows]
    want = [{k: _values(slots) for k, slots in row.items() if _values(slots)} or None for row in rows]
    assert run_map(spark, cells) == want


def test_clean_cells_skip_cleaning_and_give_the_same(spark):
    """Cells that are known to need no cleaning: what they give is what the cleaned path gives, and no other cell is among them."""
    from postline.functions import literals as lit
    clean = ["['a']", " [ 'a b' , \"it's\", 'x' ] ", "['nullable', 'nones', 'a-é-z']"]
    odd = ["[]", "['']", "[' a']", "['a ']", "['Null']", "['NONE', 'a']", "['nan']", "['\u00a0a']", "['a', ]", "['a'", "[broken, list", "('a',)",
           "['a'] # ]", "(['a'])", "", None, "N/A", "[1, 'a']", "['a\\'b']"]
    df = one_col(spark, clean + odd)
    rows = df.select("v", F.expr(lit.clean_list_cell_sql("v")).alias("k"), parse_list("v").alias("want"))
    assert [r.k for r in rows.collect()] == [True] * len(clean) + [False] * len(odd)
    lit.register_udfs(spark)
    read = df.selectExpr("v", lit.parsed_list_sql("v") + " AS p", lit.clean_list_cell_sql("v") + " AS k")
    got = read.selectExpr("v", lit.cleaned_list_sql("p", "k") + " AS got").selectExpr("v", "CASE WHEN size(got) > 0 THEN got END AS got")
    assert [r.got for r in got.collect()] == [r.want for r in rows.collect()]
    wrap = lambda c: None if c is None else "{'k': " + c + ", \"j\": ['b']}"
    maps = one_col(spark, [wrap(c) for c in clean + odd] + ["{' k': ['a']}", "{'None': ['a']}", "{'k': ['a'], 'k': ['b']}", "{'k': 'a'}", "{no dict", "{}"])
    read = maps.selectExpr("v", lit.parsed_map_sql("v") + " AS p", lit.clean_dict_cell_sql("v") + " AS k")
    assert [r.k for r in read.limit(len(clean)).collect()] == [True] * len(clean)
    got = read.selectExpr(lit.cleaned_entries_sql("p", "k") + " AS e").selectExpr("CASE WHEN size(e) > 0 THEN map_from_entries(e) END AS got")
    assert [r.got for r in got.collect()] == [r.want for r in maps.select(parse_map("v").alias("want")).collect()]
