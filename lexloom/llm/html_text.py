"""Main text of HTML pages by equivalence-class template deduction (operator 2).

1. Tokens: a page's elements, told apart by the path of block elements they lie in (name, id, classes;
   kept as one hash), an opening and a closing token each, and its text runs, told apart by path and text.
2. Occurrence vectors: how often a token occurs in each page of its host. A vector is kept as two sums of
   hashes of page and count beside the number of pages, so equal vectors are found by grouping, and a host of
   any size is combined before the shuffle. Pages without html and further copies of a page do not count.
3. Classes: tokens of one vector that lie in one slot of one class above them; those that lie elsewhere are
   another class. So the classes of a host form a tree, from that of the page itself downwards. Tokens on less
   than SUPPORT of a host's pages (or LEAST_PAGES) are data. So a host's template has no more tokens than its
   pages have on average, divided by SUPPORT, however many pages there are.
4. Slots: a run lies in the slot of the nearest element of the template around it that comes once a page;
   repeated elements and those of running text (TEXTUAL) hand their runs on. A slot's weight is its text outside
   links in all pages of the host. Names are evidence: text in parts called menus, adverts and so on weighs
   DOUBTED as much, text in article or main elements PREFERRED as much.
5. Main text: the heaviest slot of the template that a page has, with all that lies inside it but for parts that
   by name are no article, and for template text: runs with the vector of an element around them, unless
   the slot would lose half of its text by that (then the pages are copies of one another).

Pages of hosts with fewer than LEAST_PAGES different pages, and those in which no slot of the template has text,
are judged by steps 4 and 5 alone, as a host of one page.
"""

from __future__ import annotations

import html as html_lib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir
from .url_filter import host

LEAST_PAGES, SUPPORT, ONCE = 4, 0.1, 1.2
DOUBTED, PREFERRED, SPLIT = 0.125, 4.0, 0.5
WRAPPED = 0.8
#: Elements that stand in a line of text (fixed list); all others bound blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without content, and those that the next of their kind ends (fixed lists).
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
#: Elements of running text, which are never a slot of their own (fixed list).
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr caption figure figcaption address hr".split())
#: Elements whose content is never text of the page (fixed list).
SKIPPED = frozenset("script style noscript template svg math iframe textarea select title object canvas video audio".split())
#: Elements and names of parts that are not the article (fixed lists).
PARTS = frozenset("nav footer aside form button dialog fieldset label menu header".split())
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer "
    "footer form gdpr login menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted promotion recommended "
    "related search share sharing sidebar sidebars social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Names of what readers add (fixed list).
READERS = frozenset("comment comments disqus feedback replies reply respond".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: Elements and names that tell a head of the page, but inside an article that of the article (fixed list).
HEADS = frozenset("header masthead topbar".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"=\s*([\"'])|>")
_ATTRIBUTE = re.compile(r"([a-z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """An open block element: its path (a hash), what is said of it by names, and what is found in it.

    doubt: 0, 1 (a part by its name) or 2 (a part whatever it holds). main: it lies in an article or main element.
    wraps: a form, or one with a readers' name, which on some sites stands around the whole page.
    """

    __slots__ = ("name", "path", "above", "doubt", "doubted", "main", "own", "weight", "chars", "wraps")

    def __init__(self, name: str, attributes: str, above: Element | None):
        self.name, self.above, self.own, self.weight, self.chars = name, above, 0, 0.0, 0
        if above is None:
            self.path, self.doubt, self.doubted, self.main, self.wraps = 0, 0, False, False, False
            return
        label, role, words = name, "", frozenset()
        if attributes and not attributes.isspace() and attributes != "/":
            found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
            own, classes, role = found.get("id", ""), found.get("class", ""), found.get("role", "").lower()
            label = name + "".join(f"#{x}" for x in own.split()[:1] if not x[-1:].isdigit()) + "".join(f".{x}" for x in sorted(classes.split()))
            words = {w.lower() for w in _NAME.findall(f"{own} {classes}")}
            hidden = "hidden" in found
        else:
            hidden = False
        self.path = _number(label, above.path)
        if words & READERS or hidden:
            self.doubt = 2
        elif name in PARTS or role in ROLES:
            self.doubt = 0 if name in HEADS and above.main else 2
        else:
            self.doubt = int(bool(words & NAMES) or (not above.main and bool(words & HEADS)))
        self.wraps = self.doubt == 2 and not hidden and (name == "form" or bool(words & READERS))
        self.doubted = above.doubted or self.doubt > 0
        self.main = above.main or name in ("article", "main") or role in ("main", "article")


class Run:
    """One block's text, and how much of it is in links."""

    __slots__ = ("at", "text", "linked")

    def __init__(self, at: Element, text: str, linked: int):
        self.at, self.text, self.linked = at, text, linked


def _number(text: str, seed: int = 0) -> int:
    x = xxhash.xxh64_intdigest(text, seed & 0xFFFFFFFFFFFFFFFF)
    return x - (1 << 64) if x >> 63 else x


def _tag_end(page: str, at: int, last: dict[str, int]) -> tuple[int, int]:
    """End of the attributes and of the tag whose name ends at ``at``; > in quotes after = does not end it.

    A quote that is never closed is a character like any other; a tag that never ends takes the rest of the page.
    """
    while m := _STOP.search(page, at):
        if m[1] is None:
            return m.start(), m.end()
        at = m.end()
        if at <= last[m[1]]:
            at = page.index(m[1], at) + 1
    return len(page), len(page)


def parse(page: str | None) -> tuple[list[Run], list[Element]]:
    """Text runs of a page in order, and its block elements in order (each after the one around it).

    One pass without going back: the time is in proportion to the page, whatever is left open in it.
    """
    page = page or ""
    root = Element("", "", None)
    stack, elements, out = [root], [root], []
    depth_of: Counter = Counter()
    parts: list[str] = []
    linked, links = 0, 0
    last = {q: page.rfind(q) for q in "\"'"}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append(Run(stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop() -> None:
        depth_of[stack.pop().name] -= 1

    at, end = 0, len(page)
    while at < end:
        k = page.find("<", at)
        if k < 0:
            k = end
        if k > at:
            parts.append(page[at:k])
            if links:
                linked += k - at
        if k == end:
            break
        m = _TAG.match(page, k)
        if not m:
            if page.startswith("<!--", k):
                e = page.find("-->", k + 4)
                at = end if e < 0 else e + 3
            elif page[k + 1 : k + 2] in ("!", "?"):
                e = page.find(">", k + 2)
                at = end if e < 0 else e + 1
            else:
                parts.append("<")
                at = k + 1
            continue
        closing, name = m[1], m[2].lower()
        stop, at = _tag_end(page, m.end(), last)
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if not closing and name in SKIPPED:
            found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = _tag_end(page, found.end(), last)[1] if found else end
            continue
        flush()
        if closing:
            if depth_of[name]:
                while stack[-1].name != name:
                    pop()
                pop()
                links = 0
        elif name not in EMPTY:
            ends = ENDS.get(name, {"p"})
            while stack[-1].name in ends:
                pop()
            stack.append(Element(name, page[m.end() : stop], stack[-1]))
            depth_of[name] += 1
            elements.append(stack[-1])
    flush()
    for r in out:
        plain = len(r.text) - r.linked
        r.at.weight += plain * (DOUBTED if r.at.doubted else 1.0) * (PREFERRED if r.at.main else 1.0)
        r.at.chars += plain
    for x in reversed(elements[1:]):  # those inside come later, so they are complete
        x.above.weight += x.weight
        x.above.chars += x.chars
    return out, elements


class Node:
    """A path of a page or of a host: the path around it, whether it can hold a slot, and the weight of all inside it."""

    __slots__ = ("above", "slot", "weight")

    def __init__(self, above: int, slot: bool, weight: float):
        self.above, self.slot, self.weight = above, slot, weight


def _kind(x: Element) -> int:
    """2: article and main elements; 1: elements that can be a slot if they come once; 0: running text."""
    return 2 if x.name in ("article", "main") else int(x.name not in TEXTUAL)


def weigh(nodes: dict[int, Node]) -> dict[int, float]:
    """Weights of slots: what lies inside each and in no slot inside it.

    nodes: by path, each after the one around it; 0 is the page. A slot of which several slots inside hold much of
    the text (the second at least SPLIT of the first) takes the weight of these too: it is a text in parts.
    """
    holder, own, inside = {0: 0}, {}, {}
    for path, x in nodes.items():
        if path:
            holder[path] = path if x.slot else holder[x.above]
    for path, x in nodes.items():
        if holder[path] == path:
            own[path] = x.weight
    for path in list(own):
        if path:
            around = holder[nodes[path].above]
            own[around] -= nodes[path].weight
            inside.setdefault(around, []).append(nodes[path].weight)
    for path, weights in inside.items():
        first, second = sorted([*weights, 0.0], reverse=True)[:2]
        if second >= SPLIT * first > 0:
            own[path] += sum(w for w in weights if w >= SPLIT * first)
    return {p: w for p, w in own.items() if w > 1e-9}


def page_nodes(elements: list[Element]) -> dict[int, Node]:
    """The nodes of one page alone."""
    times = Counter(x.path for x in elements)
    out: dict[int, Node] = {}
    for x in elements:
        if x.path in out:
            out[x.path].weight += x.weight
        else:
            out[x.path] = Node(x.above.path if x.above else 0, _kind(x) == 2 or (_kind(x) == 1 and times[x.path] == 1), x.weight)
    return out


def _tokens(page: str) -> Iterator[tuple[int, int, int, int, float]]:
    """Distinct tokens of a page: number, path around it, kind (of elements; 3 of text), how often, and weight."""
    found, elements = parse(page)
    nodes, times = page_nodes(elements), Counter(x.path for x in elements)
    kinds = {x.path: _kind(x) for x in elements}
    for path, x in nodes.items():
        yield path, x.above, kinds[path], times[path], x.weight
    texts: dict[int, list] = {}
    for r in found:
        t = texts.setdefault(_number(r.text, r.at.path), [r.at, 0, 0.0])
        t[1] += 1
        t[2] += (len(r.text) - r.linked) * (DOUBTED if r.at.doubted else 1.0) * (PREFERRED if r.at.main else 1.0)
    for number, (at, n, weight) in texts.items():
        yield number, at.path, 3, n, weight


def deduce(tokens: list[tuple]) -> tuple[dict[int, float], list[int]]:
    """The template of one host: weights of its slots by path, and the numbers of its template text.

    tokens: (number, path around it, kind, vector, pages, how often, weight) of all that have enough pages, vectors
    being anything comparable. An element's ancestors are on all its pages, so they are among the tokens.
    """
    tags = {t[0]: t for t in tokens if t[2] < 3}
    if 0 not in tags:
        return {}, []
    inside: dict[int, list[int]] = {}
    for number, t in tags.items():
        if number:
            inside.setdefault(t[1], []).append(number)
    nodes, classes, order = {}, {}, [0]
    for number in order:  # grows as it goes: each after the one around it
        _, above, kind, vector, pages, times, weight = tags[number]
        # One class: one vector in one slot of the class above. An element opens and closes, so a class has two tokens at least.
        classes[number] = (vector, None) if not number else classes[above] if classes[above][0] == vector else (vector, classes[above][0])
        nodes[number] = Node(above, kind == 2 or (kind == 1 and times <= ONCE * pages), weight)
        order += sorted(inside.get(number, ()))
    weights = weigh(nodes)
    texts, lost = [], Counter()
    for number, at, kind, vector, pages, _, weight in tokens:
        if kind < 3 or at not in nodes or 2 * pages < tags[at][4]:
            continue
        around, slot = at, at
        while around and classes[around][0] != vector:
            around = nodes[around].above
        if classes[around][0] == vector:
            while slot and slot not in weights:
                slot = nodes[slot].above
            texts.append((number, slot))
            lost[slot] += weight
    return weights, sorted(n for n, slot in texts if 2 * lost[slot] < weights.get(slot, 0.0) or slot != max(weights, key=lambda p: (weights[p], p), default=0))


def templates(pages: DataFrame) -> DataFrame:
    """The template of every host of pages (host, html) that has one: host, paths and weights (of slots), texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "token", "above", "kind", "times", "v", "u", "weight"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        for whole in batches:
            for b in (whole.slice(k, 64) for k in range(0, whole.num_rows, 64)):
                rows = []
                for where, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    key = xxhash.xxh64_intdigest(page)
                    for number, above, kind, n, weight in _tokens(page):
                        v = xxhash.xxh64_intdigest(str(n), key)
                        rows.append((where, number, above, kind, n, v & 0x7FFFFFFF, v >> 32, weight))
                columns = list(zip(*rows)) or [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    some = pages.where("length(html) > 0").select("host", "html")
    rows = some.mapInArrow(each, "host string, token long, above long, kind int, times long, v long, u long, weight double")
    # Copies of a page have the same v and u: they count once.
    rows = rows.groupBy("host", "token", "v", "u").agg(*(F.any_value(c).alias(c) for c in ("above", "kind", "times", "weight")))
    tokens = rows.groupBy("host", "token").agg(
        F.any_value("above").alias("above"), F.any_value("kind").alias("kind"), F.count("*").alias("n"), F.sum("times").alias("times"), F.sum("v").alias("v"), F.sum("u").alias("u"), F.sum("weight").alias("weight")
    ).where(F.col("n") >= LEAST_PAGES)
    counts = tokens.where("token = 0").select("host", F.col("n").alias("pages"))
    often = tokens.join(counts, "host").where(F.col("n") >= SUPPORT * F.col("pages"))
    gathered = often.groupBy("host").agg(F.collect_list(F.struct("token", "above", "kind", "v", "u", "n", "times", "weight")).alias("tokens"))

    def host_template(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, 64) for k in range(0, whole.num_rows, 64)):
                found = [deduce([(t["token"], t["above"], t["kind"], (t["n"], t["v"], t["u"]), t["n"], t["times"], t["weight"]) for t in ts]) for ts in b.column(1).to_pylist()]
                columns = [b.column(0), pa.array([list(w) for w, _ in found], pa.list_(pa.int64())), pa.array([list(w.values()) for w, _ in found], pa.list_(pa.float64())), pa.array([t for _, t in found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "paths", "weights", "texts"])

    return gathered.mapInArrow(host_template, "host string, paths array<long>, weights array<double>, texts array<long>")


def extract(page: str | None, weights: dict[int, float] | None = None, texts: frozenset[int] = frozenset()) -> str:
    """The main text of one page under its host's template (weights of slots, template text); empty if there is none."""
    found, elements = parse(page)
    left = [r for r in found if not (texts and _number(r.text, r.at.path) in texts)]
    if not left:
        return ""
    for slots in (weights, None):
        if slots is None:
            slots, left = weigh(page_nodes(elements)), found
        slots = {x.path: slots[x.path] for x in elements if x.chars and x.path in slots}
        if slots:
            main = max(slots, key=lambda p: (slots[p], -p))
            break
    else:
        main = 0  # all text is in links
    # Inside: from the slot downwards, but for parts that are no article; a part called so that holds most of the slot is none.
    total = sum(x.chars for x in elements if x.path == main)
    # A form or readers' part is the page's wrapper if it holds WRAPPED of the slot and all its articles.
    marked = [x for x in elements if x.main and not x.above.main and x.chars]
    around = lambda x: x.wraps and x.chars >= WRAPPED * total > 0 and all(_under(m, x) for m in marked)
    inside: dict[int, bool] = {}
    article = False
    for x in elements:
        if x.path == main and not (x.above and inside[id(x.above)]):
            inside[id(x)], article = True, article or x.main
        else:
            inside[id(x)] = bool(x.above) and inside[id(x.above)] and (not x.doubt or (x.doubt == 1 and 2 * x.chars >= total > 0) or around(x))
    kept = [r for r in left if inside[id(r.at)] and (article or 2 * r.linked < len(r.text) or not total)]
    return " ".join(r.text for r in kept)


def _under(x: Element | None, top: Element) -> bool:
    while x is not None and x is not top:
        x = x.above
    return x is top


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html; other columns are ignored).

    Null html counts as empty, and empty html has an empty text. The templates are written to the shared folder and
    read again, so that their real size decides whether the join with the pages is a broadcast or a shuffle that
    adaptive execution can split. Each worker builds a host's template once for each batch of rows.
    """
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    folder = f"{shared_dir(spark)}/templates-{uuid.uuid4().hex}"
    templates(pages).write.parquet(folder)
    known = spark.read.parquet(folder)
    joined = pages.join(known, "host", "left").select("page_id", "url", "html", "host", "paths", "weights", "texts")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, 64) for k in range(0, whole.num_rows, 64)):
                built: dict[str, tuple] = {}
                got = []
                for k, (page, where) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                    if where not in built:
                        paths = b.column(4)[k].as_py()
                        built[where] = (None, frozenset()) if paths is None else (dict(zip(paths, b.column(5)[k].as_py())), frozenset(b.column(6)[k].as_py()))
                    got.append(extract(page, *built[where]))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(each, "page_id long, url string, text string, n_chars long")
