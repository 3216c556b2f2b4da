"""HTML extraction by wrappers: union-free regular expressions inferred per host.

1. Each page becomes an expression over its block tags and text slots: end tags are
   supplied, inline tags are part of the text, and repeats are folded (``p p p`` is
   ``p+``, ``h2 p h2 p`` is ``(h2 p)+``).  Pages of one host with equal expressions are one row.
2. The expressions of a host are aligned one after another, level by level.  Where the
   token streams differ, a repeated stretch becomes a repeated group, any other one is
   optional; texts are slots.  Groups of at most ``GROUP`` expressions are aligned in a task and
   their results aligned again, until each host has one wrapper, so a host with a third
   of all pages is many tasks.
3. All pages are read through their wrapper once more: slots whose text is the same on at least
   ``SAME_PAGES`` pages of unlike text are template; the element that holds most of the host's
   unlinked text is where the main text of pages without an article element lies.
4. The text of a page is that of its slots in its main part, without the elements whose
   name, role or class names them as something else.

Wrappers have a bounded size each.  They are broadcast while their sum is at most
``BROADCAST_BYTES``, beyond that pages meet them in a join with each host dealt over several keys.

Defined results: null html is empty and has no text; a null url, or one without
``://``, belongs to the host ''; text outside all tags is a block; tags that are not
closed, or closed twice, are mended as a browser would; a page of any length is read
whole; repeated rows are each extracted; an empty table gives an empty result; other
columns than those named are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import Recent, bounded_batches, cut, named, read_table

GROUP = 64
MAX_LEVEL = 32    # a longer level becomes one repeated group of its kinds of items
MAX_DEPTH = 40    # what lies deeper counts as the text of its ancestor
MAX_ITEMS = 2000  # a larger wrapper loses its deepest levels
SAME_PAGES = 5
BROADCAST_BYTES = 32 << 20
SALTS = 32

# Names of HTML elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr br""".split())
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd tr td th tbody thead tfoot""".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead", "tfoot"},
             "tfoot": {"tr", "td", "th", "tbody", "thead", "tfoot"}}
LISTS = frozenset("ul ol dl table select html body menu".split())
_P, _P_WALLS = {"p"}, LISTS | frozenset("li td th div article section blockquote".split())
# Elements, roles and class words of what isn't the main text.
ASIDE = frozenset("""nav footer aside form script style noscript template svg iframe object canvas button select textarea dialog menu
    head title xmp noembed noframes audio video map applet datalist math-field""".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
ASIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promotions nav navbar
    navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead banner banners cookie cookies consent gdpr
    notice notices alert alerts comment comments disqus respond reply replies share sharing social related recommended recommendations
    newsletter subscribe subscription popup modal overlay pagination pager toolbar widget widgets copyright login signup signin search
    searchbox form hidden skip teaser teasers""".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?""")
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    """An element: its children are nodes and texts."""

    __slots__ = ("name", "attributes", "children", "inline")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.children = name, []
        self.inline = name in INLINE  # and no block in it: part of a text
        self.attributes = {}
        if len(attributes) > 1:
            for key, value in _ATTRIBUTE.findall(attributes.rstrip(">").rstrip("/")):
                self.attributes.setdefault(key.lower(), unescape(value.strip("\"'")))

    def words(self) -> list[str]:
        return _WORD.findall((self.attributes.get("class", "") + " " + self.attributes.get("id", "")).lower())

    def sign(self) -> str:
        """The token that stands for the tag: its name and the class words without digits."""
        if not self.attributes:
            return self.name
        return ".".join([self.name, *(w for w in self.words() if w.isalpha())][:4])


def parse(html: str) -> Node:
    """The tree of a page; end tags that are missing are supplied, those without a start are left out."""
    root = Node("")
    stack, opened, at = [root], {}, 0

    def close_down_to(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop().name] -= 1

    def close(names: set[str], walls: frozenset[str]) -> None:
        """Close the outermost element of these names that is open inside the next wall."""
        if not any(opened.get(n) for n in names):
            return
        outermost = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                outermost = i
            elif stack[i].name in walls:
                break
        if outermost is not None:
            close_down_to(outermost)

    for found in iter(lambda: _TOKEN.search(html, at), None):
        if found.start() > at:
            stack[-1].children.append(unescape(html[at:found.start()]))
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            if opened.get(name):
                while stack[-1].name != name:
                    close_down_to(len(stack) - 1)
                close_down_to(len(stack) - 1)
            continue
        if name in ENDS_P:
            close(_P, _P_WALLS)
        if name in CLOSED_BY:
            close(CLOSED_BY[name], LISTS)
        node = Node(name, found[3])
        stack[-1].children.append(node)
        if not node.inline:
            for above in reversed(stack):
                if not above.inline:
                    break
                above.inline = False
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not found[3].endswith("/>"):
            stack.append(node)
            opened[name] = opened.get(name, 0) + 1
    if at < len(html):
        stack[-1].children.append(unescape(html[at:]))
    return root


# --- expressions --------------------------------------------------------------
# An item is [sign, optional, repeated, items]; the sign of a text slot is "#", that of a group
# begins with "(".

def _merge(a: list, b: list) -> list:
    return [a[0], a[1] | b[1], a[2] | b[2], align(a[3], b[3])]


def _bag(items: list) -> list:
    """One repeated group of the kinds of items that there are, each optional."""
    kinds: dict[str, list] = {}
    todo = list(items)
    for item in todo:
        if item[0].startswith("("):
            todo += item[3]
        else:
            one = [item[0], 1, item[2], item[3]]
            kinds[item[0]] = _merge(kinds[item[0]], one) if item[0] in kinds else one
    return ["(*)", 0, 1, list(kinds.values())]


def fold(items: list) -> list:
    """Repeats as repeated items: equal neighbours first, then groups of 2 to 4 items."""
    out: list = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = _merge(out[-1], item)
            out[-1][2] = 1
        else:
            out.append(item)
    for period in (2, 3, 4):
        signs, folded, i = [x[0] for x in out], [], 0
        while i < len(out):
            times = 1
            while signs[i:i + period] == signs[i + times * period:i + (times + 1) * period] and len(signs) >= i + period:
                times += 1
            if times == 1:
                folded.append(out[i])
                i += 1
                continue
            group = out[i:i + period]
            for k in range(1, times):
                group = [_merge(a, b) for a, b in zip(group, out[i + k * period:i + (k + 1) * period])]
            folded.append([f"({' '.join(signs[i:i + period])})", 0, 1, group])
            i += times * period
        out = folded
    if len(out) > MAX_LEVEL or (len(out) > 1 and any(x[0] == "(*)" for x in out)):
        return [_bag(out)]
    return out


def _wrap(items: list, groups: list) -> list:
    """Stretches that are an occurrence of a group of the other side, as that group."""
    for group in groups:
        kinds = {x[0] for x in group[3]}
        out, i = [], 0
        while i < len(items):
            j = i
            while j < len(items) and items[j][0] in kinds:
                j += 1
            if j == i:
                out.append(items[i])
                i += 1
                continue
            own: dict[str, list] = {}
            for item in items[i:j]:
                own[item[0]] = _merge(own[item[0]], item) if item[0] in own else item
            out.append([group[0], 0, int(len(own) < j - i), [own[x[0]] for x in group[3] if x[0] in own]])
            i = j
        items = out
    return items


def align(a: list, b: list) -> list:
    """The expression of both: items in common order are merged, the others are optional, repeats are folded."""
    if a == b:
        return a
    if any(x[0] == "(*)" for x in a + b):
        return [_bag(a + b)]
    grouped = lambda items: [x for x in items if x[0].startswith("(")]
    a, b = _wrap(a, grouped(b)), _wrap(b, grouped(a))
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], 1, a[i][2], a[i][3]])
            i += 1
        else:
            out.append([b[j][0], 1, b[j][2], b[j][3]])
            j += 1
    return fold(out)


def _size(items: list) -> int:
    return sum(1 + _size(x[3]) for x in items)


def _prune(items: list, depth: int) -> list:
    return [[s, o, r, _prune(c, depth - 1) if depth > 0 or not c else [["#", 1, 1, []]]] for s, o, r, c in items]


def bounded(items: list) -> list:
    """The expression, without its deepest levels where it has over ``MAX_ITEMS`` items."""
    depth = MAX_DEPTH
    while _size(items) > MAX_ITEMS and depth > 0:
        items = _prune(items, depth := depth - 1)
    return items


def expression(node: Node) -> list:
    """The folded items of an element's children; inline elements and texts are slots."""
    done: dict[int, list] = {}
    todo = [(node, 0, False)]
    while todo:  # children before their parents, without recursion over the page
        here, depth, ready = todo.pop()
        blocks = [c for c in here.children if isinstance(c, Node) and not c.inline]
        if depth >= MAX_DEPTH:
            done[id(here)] = [["#", 0, 0, []]]
        elif not ready:
            todo.append((here, depth, True))
            todo += [(c, depth + 1, False) for c in blocks]
        else:
            items: list = []
            for child in here.children:
                if isinstance(child, Node) and not child.inline:
                    items.append([child.sign(), 0, 0, done.pop(id(child))])
                elif (not items or items[-1][0] != "#") and (isinstance(child, Node) or child.strip()):
                    items.append(["#", 0, 0, []])
            done[id(here)] = fold(items)
    return done[id(node)]


# --- reading a page through its wrapper ---------------------------------------

class Level:
    """Where the items of a wrapper's level are, by sign and in order."""

    def __init__(self, items: list, at: str = ""):
        self.at, self.places, self.below, n = at, {}, [], 0
        todo = [(f"{at}/{i}", x) for i, x in enumerate(items)]
        while n < len(todo):
            place, item = todo[n]
            if item[0].startswith("("):
                todo[n:n + 1] = [(f"{place}/{i}", x) for i, x in enumerate(item[3])]
                continue
            self.places.setdefault(item[0], []).append(n)
            self.below.append((place, item[3], None))
            n += 1

    def find(self, sign: str, near: int) -> tuple[int, Level | None]:
        """The place of the next item with this sign, from ``near`` on or else before, and its level."""
        found = self.places.get(sign)
        if not found:
            return near, None
        n = next((k for k in found if k >= near), found[0])
        place, items, level = self.below[n]
        if level is None:
            level = Level(items, place)
            self.below[n] = (place, items, level)
        return n, level


def _aside(node: Node, in_main: bool, holds_main: bool) -> bool:
    """Whether an element is something other than main text by its name, role or class words."""
    name, attributes = node.name, node.attributes
    if name in ASIDE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body", "main", "article") or holds_main:
        return False
    return (attributes.get("role", "").lower() in ASIDE_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
            or not ASIDE_WORDS.isdisjoint(node.words()) or (not in_main and "header" in node.words()))


def _mains(root: Node) -> tuple[set[int], set[int]]:
    """(the outermost article or else main elements, all their ancestors), of those that lie in nothing aside by its name."""
    found: dict[str, tuple[set[int], set[int]]] = {"article": (set(), set()), "main": (set(), set())}
    path: list[int] = []
    todo: list[tuple[Node, int, tuple[str, ...]]] = [(root, 0, ())]
    while todo:
        node, depth, inside = todo.pop()
        del path[depth:]
        kind = "main" if node.attributes.get("role", "").lower() == "main" else node.name
        if kind in found and kind not in inside:
            own, above = found[kind]
            own.add(id(node))
            for i in reversed(path):  # ancestors that are known have all theirs known
                if i in above:
                    break
                above.add(i)
            inside = (*inside, kind)
        path.append(id(node))
        if len(inside) < 2:
            todo += [(c, depth + 1, inside) for c in node.children
                     if not isinstance(c, str) and not c.inline and c.children and c.name not in ASIDE]
    return found["article"] if found["article"][0] else found["main"]


def blocks(html: str, level: Level) -> Iterator[tuple[str, str, int, bool, bool]]:
    """(slot, text, characters of it in links, whether it is in an article, whether it is a title) of each block that isn't aside."""
    root = parse(html)
    mains, above_mains = _mains(root)
    parts: list[str] = []
    linked = 0

    def done(slot: str, in_main: bool, title: bool) -> Iterator[tuple[str, str, int, bool, bool]]:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            yield slot, text, linked, in_main, title
        parts, linked = [], 0

    # (children, next child, level or None, slot, near, in main, in a link, inline, title)
    todo = [[root.children, 0, level, "", 0, id(root) in mains, False, False, False]]
    while todo:
        top = todo[-1]
        children, n, here, slot, near, in_main, link, inline, title = top
        if n == len(children):
            todo.pop()
            if not inline:
                yield from done(slot + "/#", in_main, title)
            continue
        top[1] += 1
        child = children[n]
        if isinstance(child, str):
            parts.append(child)
            if link:
                linked += len(child.strip())
            continue
        if child.name in ("br", "wbr", "img"):
            parts.append(" " if child.name == "br" else "")
            continue
        is_main = in_main or id(child) in mains
        if _aside(child, is_main, id(child) in above_mains):
            continue
        link = link or child.name == "a"
        if child.inline:
            todo.append([child.children, 0, here, slot, near, in_main, link, True, title])
            continue
        yield from done(slot + "/#", in_main, title)
        top[4], below = here.find(child.sign(), near) if here else (near, None)
        todo.append([child.children, 0, below, below.at if below else slot + "/?", 0, is_main, link, False,
                     title or child.name == "h1"])


def main_text(html: str, plan: dict) -> str:
    """The blocks of a page's main part, two line breaks between them."""
    found = list(blocks(html, plan["level"]))
    template, main = plan["template"], plan["main"]
    if any(in_main for _, _, _, in_main, _ in found):
        kept = [text for slot, text, _, in_main, _ in found if in_main and slot not in template]
    else:
        menus = plan["menus"]
        kept = [text for slot, text, _, _, title in found
                if slot not in template and slot not in menus and (title or slot.startswith(main + "/"))]
    return "\n\n".join(kept)


def decide(wrapper: str, slots: list) -> str:
    """The plan of a host: its wrapper, the slots that are template or menus, the element of the main text.

    ``slots``: (slot, pages of unlike text, least text digest, greatest one, characters, those in links).
    """
    template = [s.slot for s in slots if s.pages >= SAME_PAGES and s.low == s.high]
    menus = [s.slot for s in slots if 2 * s.linked > s.chars]
    mass = {s.slot: s.chars - s.linked for s in slots if s.slot not in {*template, *menus}}
    main, total = "", sum(mass.values())
    while total:
        below: dict[str, int] = {}
        for slot, chars in mass.items():
            rest = slot[len(main) + 1:].split("/")
            if slot.startswith(main + "/") and len(rest) > 2:  # an element with elements in it
                below[rest[0]] = below.get(rest[0], 0) + chars
        if not below:
            break
        step = max(sorted(below), key=below.get)
        if below[step] * 10 < total * 7:
            break
        main = f"{main}/{step}"
    return json.dumps({"wrapper": json.loads(wrapper), "template": template, "menus": menus, "main": main})


# --- Spark --------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url.cast("string"), "(?s)^.*?://([^/?#]*)", 1), F.lit("")), F.lit("")))


def _pages(pages: DataFrame, keep: list[str], url_col: str, html_col: str) -> DataFrame:
    return pages.select(*map(named, keep), host_of(named(url_col)).alias("_host"),
                        F.coalesce(named(html_col).cast("string"), F.lit("")).alias("_html"))


def expressions(pages: DataFrame) -> DataFrame:
    """(host, wrapper, n): the expressions of the pages (_host, _html) and how many pages have each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], int] = {}

        def flush() -> pa.RecordBatch:
            keys = list(seen)
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], names=["host", "wrapper", "n"])
            seen.clear()
            return out

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                key = host, json.dumps(bounded(expression(parse(html.as_py()))))
                seen[key] = seen.get(key, 0) + 1
                if len(seen) >= 2000:
                    yield flush()
        yield flush()

    return (pages.select("_host", "_html").mapInArrow(run, "host string, wrapper string, n long")
            .groupBy("host", "wrapper").agg(F.sum("n").alias("n")))


def _aligned(_key, frame: pd.DataFrame) -> pd.DataFrame:
    """One wrapper of a group of expressions, the most frequent ones first."""
    rows = sorted(zip((-frame["n"]).tolist(), frame["wrapper"].tolist()))
    whole = json.loads(rows[0][1])
    for _, text in rows[1:]:
        whole = bounded(align(whole, json.loads(text)))
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "wrapper": [json.dumps(whole)], "n": [int(frame["n"].sum())]})


def wrappers(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(host, wrapper): one expression for each host, from all its pages."""
    level = cut(expressions(pages), "page-expressions")
    while True:
        sizes = level.groupBy("host").agg(F.count("*").alias("rows"))
        most = sizes.agg(F.max("rows")).first()[0] or 0
        if most <= 1:
            return level.select("host", "wrapper")
        parts = F.ceil(F.col("rows") / group).cast("int")
        dealt = level.join(sizes, "host").withColumn("part", F.pmod(F.xxhash64("wrapper"), parts)).drop("rows")
        level = cut(dealt.groupBy("host", "part").applyInPandas(_aligned, "host string, wrapper string, n long"), "page-wrappers")


def _with(pages: DataFrame, per_host: DataFrame, name: str, broadcast_bytes: int) -> DataFrame:
    """``pages`` with a column of ``per_host`` (host, ``name``), a row of which every page has."""
    size = per_host.agg(F.sum(F.octet_length("host") + F.octet_length(name))).first()[0] or 0
    per_host = per_host.select(F.col("host").alias("_host"), F.col(name).alias(f"_{name}"))
    if size <= broadcast_bytes:
        return pages.join(F.broadcast(per_host), "_host")
    spread = per_host.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return pages.withColumn("_salt", F.pmod(F.xxhash64("_html"), F.lit(SALTS))).join(spread, ["_host", "_salt"]).drop("_salt")


def _digest(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 31 | zlib.adler32(data) >> 1


def slot_texts(pages: DataFrame) -> DataFrame:
    """(host, slots): what each slot of the wrapper holds over all pages (_host, _html, _wrapper)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Recent(lambda text: Level(json.loads(text)), 200, 1 << 30)
        kinds = (pa.string(), pa.string(), *[pa.int64()] * 5)
        for batch in batches:
            rows = []
            for host, html, wrapper in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                own: dict[str, list[int]] = {}
                whole = 0
                for slot, text, linked, _, _ in blocks(html.as_py(), levels[wrapper]):
                    mark = _digest(text)
                    whole = zlib.crc32(mark.to_bytes(8, "little"), whole)
                    x = own.setdefault(slot, [mark, mark, 0, 0])
                    x[:] = min(x[0], mark), max(x[1], mark), x[2] + len(text), x[3] + linked
                rows += [(host, slot, whole, *x) for slot, x in own.items()]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["host", "slot", "page", "low", "high", "chars", "linked"])

    marks = pages.select("_host", "_html", "_wrapper").mapInArrow(
        run, "host string, slot string, page long, low long, high long, chars long, linked long")
    totals = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")]
    by_slot = (marks.groupBy("host", "slot", "page").agg(*totals)
               .groupBy("host", "slot").agg(F.count("*").alias("pages"), *totals))
    # a wrapper has a bounded number of slots, so has the list
    return by_slot.groupBy("host").agg(F.sort_array(F.collect_list(
        F.struct("slot", "pages", "low", "high", "chars", "linked"))).alias("slots"))


def plans(pages: DataFrame, group: int = GROUP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(host, plan): how the pages (_host, _html) of each host are read."""
    inferred = wrappers(pages, group)
    held = slot_texts(_with(pages, inferred, "wrapper", broadcast_bytes))
    judge = F.udf(lambda wrapper, slots: decide(wrapper, slots or []), "string")  # a row per host
    return cut(inferred.join(held, "host", "left").select("host", judge("wrapper", "slots").alias("plan")), "page-plans")


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url_col: str = "url", html_col: str = "html",
            group: int = GROUP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The ``keep`` columns with ``text`` (the main text) and ``n_chars``, a row for each row of ``pages``."""
    bounded_batches(pages.sparkSession)
    source = _pages(pages, list(keep), url_col, html_col)
    planned = _with(source, plans(source, group, broadcast_bytes), "plan", broadcast_bytes)
    columns = list(keep)
    types = planned.select(*map(named, columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(text: str) -> dict:
            plan = json.loads(text)
            return {"level": Level(plan["wrapper"]), "template": frozenset(plan["template"]), "menus": frozenset(plan["menus"]),
                    "main": plan["main"]}

        known = Recent(read, 200, 1 << 30)
        for batch in batches:
            n = len(columns)
            texts = [main_text(html.as_py(), known[plan]) for html, plan in zip(batch.column(n), batch.column(n + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*columns, "text", "n_chars"])

    schema = types.schema.add("text", "string").add("n_chars", "long")
    return planned.select(*map(named, columns), "_html", "_plan").mapInArrow(run, schema)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
