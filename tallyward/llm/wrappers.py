"""Main text of web pages by wrappers inferred from the pages of a host.

A wrapper is a regular expression without unions over token streams: elements, text slots, optional parts and repeated parts. It is
inferred by aligning one page after the other with what is known of the host: where tokens differ, the text becomes a
slot, an element that only one side has becomes optional, and neighbours of the same kind become a repeated part, whose contents are
aligned in turn. Alignments can be joined in any order, so every task first aligns the pages it reads, and only one partial
wrapper for each host and task is shuffled.

The wrapper says which parts of the host's pages are read: the articles, without menus, headers, footers, sidebars, notices, adverts,
forms and reader comments, known by their elements and by the words in their classes and ids. On pages without an article, the
parts outside those are read but for the host's template: texts that at least half of its pages, and no less than two, show, all of them the same.
What fewer pages show is read whatever it is. If those texts together are longer than the texts of the slots, the pages are copies of one another
but for a date or counter, and they are read too, as with a single page.

Character references are decoded, white space inside a block becomes one space, and blocks are joined by a line break. NULL
and empty pages have an empty text. URLs without a host share one wrapper. Markup that is cut off or not closed
is read as far as it goes, and elements nested more than ``DEEPEST`` deep are part of the one around them. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import json
import re
from html import unescape
from operator import add

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.staging import stage

# Fixed values of the markup language: elements without content, with content that is not text, inside a line, and those that hold others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript title textarea select option svg math iframe object head button".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br".split())
HOLDERS = frozenset("html body article main section div nav header footer aside form fieldset ul ol dl table details dialog".split())
# Elements and words in classes and ids of parts that are not the main text.
APART = frozenset("nav footer aside form dialog menu".split())
APART_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies disclaimer footer menu nav "
                        "navbar navigation newsletter notice notices pagination popup promo related respond share sharing sidebar social sponsor sponsored "
                        "subscribe widget".split())
MAIN = frozenset("article main".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>|</?[A-Za-z](?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+>|</?[A-Za-z][^<>]*>|[^<]+|<", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_KIND = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
SLOT = "#"
#: Elements nested deeper belong to the one around them.
DEEPEST = 200
#: Partial wrappers that a task holds before it sends them on.
HELD = 1_000


def tokens(html: str):
    """(kind, name, words) for tags and ("text", text, None), without comments and hidden contents."""
    hidden = None
    for found in _TOKEN.finditer(html):
        token = found[0]
        if token[0] != "<" or token == "<":
            if hidden is None:
                yield "text", token, None
            continue
        if token.startswith("<!") or token.startswith("<?"):
            continue
        name = _NAME.match(token)[1].lower()
        closing = token[1] == "/"
        if hidden is not None:
            # A head that was never closed ends with the body.
            if closing and name == hidden or hidden == "head" and name == "body":
                hidden = None
                if name != "body":
                    continue
            else:
                continue
        if closing:
            yield "close", name, None
        elif name in HIDDEN:
            if not token.endswith("/>"):
                hidden = name
        else:
            words = [w for m in _KIND.finditer(token) for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
            yield "open", name, words


def walk(html: str):
    """(path, marks, block, text) for every text: the elements that hold it, their numbers, and the number of its block."""
    path: list[str] = []
    marks: list[int] = []
    deeper: dict[str, int] = {}
    block = 0
    for kind, value, words in tokens(html):
        if kind == "text":
            yield path, marks, block, value
            continue
        if value == "br":
            yield path, marks, block, " "
        if value in INLINE:
            continue
        block += 1
        if value not in HOLDERS:
            continue
        if kind == "open" and len(path) == DEEPEST:
            deeper[value] = deeper.get(value, 0) + 1
        elif kind == "close" and deeper.get(value):
            deeper[value] -= 1
        elif kind == "open":
            path, marks = [*path, ".".join([value, *sorted({*words})])], [*marks, block]
        else:
            at = next((i for i in range(len(path) - 1, -1, -1) if path[i].split(".")[0] == value), None)
            if at is not None:
                path, marks = path[:at], marks[:at]


# A node of a wrapper: [label, optional, repeated, digest of its text or None for a slot, children, pages that show it, characters of its longest text].


def page_wrapper(html: str) -> list:
    """The wrapper of one page."""
    root = ["", False, False, None, [], 1, 0]
    open_nodes: list[list] = [root]
    last: list[int] = []
    texts: list[str] = []

    def flush():
        text = " ".join("".join(texts).split())
        texts.clear()
        if text:
            open_nodes[-1][4].append([SLOT, False, False, xxhash.xxh64_hexdigest(text), [], 1, len(text)])

    for path, marks, _, text in walk(html):
        if marks != last:
            flush()
            same = 0
            while same < min(len(marks), len(last)) and marks[same] == last[same]:
                same += 1
            del open_nodes[same + 1 :]
            for label in path[same:]:
                node = [label, False, False, None, [], 1, 0]
                open_nodes[-1][4].append(node)
                open_nodes.append(node)
            last = marks
        texts.append(text)
    flush()
    return _folded(root)


def _folded(node: list) -> list:
    """Neighbours of one kind become one repeated part."""
    children: list[list] = []
    for child in map(_folded, node[4]):
        if children and children[-1][0] == child[0]:
            children[-1] = _joined(children[-1], child, max)
            children[-1][2] = True
        else:
            children.append(child)
    node[4] = children
    return node


def _joined(a: list, b: list, pages=add) -> list:
    """The node of both: of different pages, or (``pages`` is ``max``) of the same ones, which show it no less often than either."""
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] if a[3] == b[3] else None, _aligned(a[4], b[4], pages), pages(a[5], b[5]), max(a[6], b[6])]


def align(a: list, b: list) -> list:
    """The wrapper of both."""
    return _folded(_joined(a, b))


def _aligned(a: list, b: list, pages=add) -> list:
    """Both sequences along a longest common one; what only one has is optional."""
    if [n[0] for n in a] == [n[0] for n in b]:
        return [_joined(x, y, pages) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    made, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            made.append(_joined(a[i], b[j], pages))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            made.append([a[i][0], True, *a[i][2:]])
            i += 1
        else:
            made.append([b[j][0], True, *b[j][2:]])
            j += 1
    return made


def expression(node: list) -> str:
    """The wrapper as a regular expression: ``(...)?`` optional, ``(...)+`` repeated, ``#`` a text slot, ``=`` a fixed text."""
    label, optional, repeated, digest, children, _, _ = node
    inner = "".join(map(expression, children))
    body = ("=" if digest else SLOT) if label == SLOT else f"<{label}>{inner}</>" if label else inner
    return f"({body})" + "+" * repeated + "?" * optional if optional or repeated else body


def is_apart(path: list[str]) -> bool:
    """Whether a part lies in a menu, header, footer, sidebar, notice, advert, form or comment."""
    in_main = False
    for label in path:
        name, *words = label.split(".")
        if name in APART or name == "header" and not in_main:
            return True
        if name not in ("html", "body") and name not in MAIN and APART_WORDS.intersection(words):
            return True
        in_main = in_main or name in MAIN
    return False


def read_parts(wrapper: list) -> tuple[list[str], list[str]]:
    """Paths of parts of articles to read, and of parts to read where there is no article."""
    main, slots, fixed, seldom = [], [], [], []

    def visit(node, path):
        for child in node[4]:
            if child[0] != SLOT:
                visit(child, [*path, child[0]])
            elif not is_apart(path):
                if any(p.split(".")[0] in MAIN for p in path):
                    main.append("/".join(path))
                else:
                    kind = slots if child[3] is None else fixed if child[5] >= max(2, wrapper[5] / 2) else seldom
                    kind.append(("/".join(path), child[6]))

    visit(wrapper, [])
    copies = sum(n for _, n in fixed) > sum(n for _, n in slots)
    return sorted({*main}), sorted({path for path, _ in slots + seldom + fixed * copies})


def main_text(html: str, main: set[str], other: set[str]) -> str:
    """The page's text by its host's wrapper."""
    found: dict[int, list[str]] = {}
    rest: dict[int, list[str]] = {}
    place, known = None, ""
    for path, _, block, text in walk(html):
        if path is not place:
            place, known = path, "/".join(path)
        if known in main:
            found.setdefault(block, []).append(text)
        elif known in other:
            rest.setdefault(block, []).append(text)
    blocks = (" ".join(unescape("".join(parts)).split()) for parts in (found or rest).values())
    return "\n".join(b for b in blocks if b)


def _infer(batches):
    held: dict[str, list] = {}
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = page_wrapper(html or "")
            held[host] = align(held[host], page) if host in held else page
            if len(held) > HELD:
                yield _wrappers(held)
                held = {}
    yield _wrappers(held)


def _join_partial(batches):
    host, wrapper = None, None
    for batch in batches:
        done: dict[str, list] = {}
        for name, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            part = json.loads(text)
            if name == host:
                wrapper = align(wrapper, part)
            else:
                if host is not None:
                    done[host] = wrapper
                host, wrapper = name, part
        yield _wrappers(done)
    yield _wrappers({} if host is None else {host: wrapper})


def _wrappers(held: dict[str, list]):
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
                                      ["host", "wrapper"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(``host``, ``wrapper``) from rows of (``host``, ``html``); one row a host."""
    kind = "host string, wrapper string"
    partial = pages.select("host", "html").mapInArrow(_infer, kind)
    return partial.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_join_partial, kind)


def _extract(names: list[str]):
    def run(batches):
        known: dict[str, tuple[set[str], set[str]]] = {}
        for batch in batches:
            texts = []
            for wrapper, html in zip(batch.column("wrapper").to_pylist(), batch.column("html").to_pylist()):
                if wrapper not in known:
                    if len(known) > HELD:
                        known.clear()
                    main, other = read_parts(json.loads(wrapper))
                    known[wrapper] = {*main}, {*other}
                texts.append(main_text(html or "", *known[wrapper]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], [*names, "text"])

    return run


def host_of(url):
    """Lower-case host of a URL, empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page. The wrappers are written to the shared folder."""
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = stage(infer_wrappers(rows), "wrappers")
    joined = rows.join(wrappers, "host")
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    texts = joined.select("page_id", "url", "html", "wrapper").mapInArrow(_extract(["page_id", "url"]), f"{kinds}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
