"""Main text of web pages by wrappers inferred from the pages of a host.

A page is a stream of tokens: tags of block elements, and text slots between them (inline
markup is part of a slot). Streams of a host are aligned one after another, as in
RoadRunner (Crescenzi et al., 2001), element by element: where the next tokens of wrapper
and page differ, the nearer place at which one side's token comes later on the other is
sought, and what lies before it becomes optional. A tag that follows itself becomes
repeated; tags that recur in another order become one repeated group; text becomes a slot
that keeps whether its strings differ between pages. The result has no unions, only these
groups: a union-free regular expression, in which every element has one child for each
kind (tag, classes and id, digits left out). ``expression`` writes it out, and it accepts
every page that it was made from. What decides about text are counts for each slot,
which don't depend on how pages are dealt to tasks.

Spark folds pages in the tasks that read them, deals what they give by host and part of
its hash over PARTS tasks, and folds those; a host with a third of all pages costs its
last task PARTS rows. Each host's wrapper becomes the paths of its main slots, and those
are joined to pages.

Main slots. Text that is the same on all of a slot's pages (three or more) is the
template's. Menus, headers, footers, sidebars, notices, adverts, forms and comments, told
by element, role or words of class and id, are out with all that is in them, as adverts
and comments differ from page to page like the article does; where nothing else is left,
there is no main text. The main part is the lowest element that holds all other text that
differs, links aside. What is in it stays, but for parts that have only the template's
text and are neither headings nor lines (such as paragraphs) among those that differ. Names
decide only where that leaves a choice: if article (else main) elements in that part hold
half of its text, they are the main part. A page that has no text in its host's main
slots, being unlike the others, is read by its own wrapper.

Cases: null and empty pages and pages without text give the empty text; null and
malformed addresses share the host ''; damaged markup is read as browsers do, roughly:
what isn't closed ends with its parent, and elements nested deeper than DEEP have no slots of
their own: their text is the deepest's, unless they are out; further columns are left out; repeated rows give repeated results; all work on a page is linear in
its length, but for a factor of DEEP at most.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common

#: Tasks over which one host's partly folded wrappers are dealt.
PARTS = 64
#: Characters of pages that a task folds into wrappers, which are no larger, before it passes them on.
HELD = 32_000_000
#: Share of the text that differs which named elements must hold to be the main part.
SHARE = 0.5
#: Pages with equal text that make it the template's.
SAME = 3
#: Levels of nested elements that a wrapper has.
DEEP = 512

_NAME_OF_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")
# Fixed values of HTML.
#: What these hold isn't text; the first ones go on to the end of the page if they aren't closed.
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_SKIPPED = frozenset("noscript template svg math select".split())
_CLOSING = {name: re.compile(rf"</{name}(?![^\s/>])[^>]*>?", re.I | re.A) for name in _RAW | _SKIPPED}
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr label".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag ends, if they are open below the named borders.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_ENDS |= {x: ({"td", "th", "tr", "thead", "tbody", "tfoot"}, {"table"}) for x in ("thead", "tbody", "tfoot")}
_P_BORDERS = frozenset("td th li div section article main body blockquote button".split())
# What is never main text: elements, roles, and words of class and id.
_OUT_TAGS = frozenset("nav header footer aside form button menu dialog head input object audio video canvas".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar"
    " comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login share sharing social"
    " related recommended pagination pager popup modal overlay toolbar widget widgets skip copyright".split()
)
_KEPT_TAGS = frozenset(("html", "body", "article", "main"))
#: Elements that hold lines of text rather than parts of a page, and those that title what follows.
_LINES = frozenset("p li dd pre blockquote td tr tbody thead h1 h2 h3 h4 h5 h6 dt th caption figcaption legend summary".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption figcaption legend summary".split())
SLOT = "#"


class Node:
    """A wrapper's element or, under the key SLOT, its text slot."""

    __slots__ = ("children", "inside", "items", "key", "looped", "seen", "slot", "texts")

    def __init__(self, key: str):
        self.key = key
        self.seen = 0  # instances
        self.inside = 0  # instances of the parent that have one
        self.looped = False  # follows itself
        self.children: dict[str, Node] = {}
        self.items: list[tuple[str, ...]] = []  # kinds of children in order; several are a repeated group
        self.texts: list[tuple[int, str, int]] = []  # of a page: order, text, characters in links
        self.slot = [0, 0, 0, 0, 0]  # pages with text here, characters, in links, least and greatest hash of a page's text


def key_of(tag: str, attributes: str) -> str:
    """tag|classes|id|role; digits and order don't count."""
    if not attributes.strip():
        return tag
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), re.sub(r"\d+", "0", (a or b or c).lower()))
    if "hidden" in found or found.get("aria-hidden") == "true":
        return f"{tag}|||dialog"
    classes = " ".join(sorted(set(found.get("class", "").split())))
    role = found.get("role", "") or ("main" if found.get("itemprop") == "articlebody" else "")
    return f"{tag}|{classes}|{found.get('id', '')}|{role}".rstrip("|")


key_of = functools.lru_cache(maxsize=100_000)(key_of)


def is_out(key: str) -> bool:
    tag, classes, name, role = (*key.split("|"), "", "", "")[:4]
    if tag in _OUT_TAGS or role in _OUT_ROLES:
        return True
    return tag not in _KEPT_TAGS and role != "main" and any(x in _OUT_WORDS for x in _NAME.findall(f"{classes} {name}"))


is_out = functools.lru_cache(maxsize=100_000)(is_out)


# token streams


def grouped(items: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Items in which each kind comes once: from the first to the last place of a kind that recurs, all become one repeated group."""
    last = {k: i for i, item in enumerate(items) for k in item}
    out, at = [], 0
    while at < len(items):
        stop = at
        members: dict[str, None] = {}
        i = at
        while i <= stop:
            for k in items[i]:
                members[k] = None
                stop = max(stop, last[k])
            i += 1
        out.append(tuple(members))
        at = stop + 1
    return out


def aligned(a: list[tuple[str, ...]], b: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The items that take both streams' children, with the fewest of them passed over at each mismatch."""
    if a == b:
        return a
    in_a, in_b = ({k: i for i, item in enumerate(x) for k in item} for x in (a, b))
    out, i, j = [], 0, 0
    far = len(a) + len(b)
    while i < len(a) and j < len(b):
        if set(a[i]) & set(b[j]):
            out.append(a[i] + tuple(k for k in b[j] if k not in a[i]))
            i, j = i + 1, j + 1
            continue
        later_b = min((in_b[k] - j for k in a[i] if in_b.get(k, -1) > j), default=far)
        later_a = min((in_a[k] - i for k in b[j] if in_a.get(k, -1) > i), default=far)
        if later_b < far and later_b <= later_a:  # what the page has before it is optional
            out.append(b[j])
            j += 1
        elif later_a < far:  # what the wrapper has before it is optional
            out.append(a[i])
            i += 1
        else:
            out += [a[i], b[j]]
            i, j = i + 1, j + 1
    return grouped(out + a[i:] + b[j:])


def _instance(node: Node, sequence: list[str]) -> None:
    """One more instance of ``node``, with these children."""
    run = [k for i, k in enumerate(sequence) if not i or sequence[i - 1] != k]
    if len(run) < len(sequence):
        for i in range(1, len(sequence)):
            if sequence[i] == sequence[i - 1]:
                node.children[sequence[i]].looped = True
    for k in dict.fromkeys(run):
        node.children[k].inside += 1
    items = grouped([(k,) for k in run])
    node.items = aligned(node.items, items) if node.seen else items
    node.seen += 1


def tree(page: str) -> Node:
    """The wrapper of one page, whose slots hold the page's texts by their order. Inline markup dissolves into the text around it."""
    root = Node("")
    stack: list[tuple[str, Node, list[str]]] = [("", root, [])]
    open_: Counter = Counter()
    over: Counter = Counter()  # elements below DEEP
    below: list[tuple[str, bool]] = []  # in their order, and whether they are out
    muted = 0  # those that are
    text: list[str] = []
    linked = order = links = 0

    def flush() -> None:
        nonlocal linked, order
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                _, node, sequence = stack[-1]
                slot = node.children.get(SLOT)
                if slot is None:
                    slot = node.children[SLOT] = Node(SLOT)
                slot.seen += 1
                slot.texts.append((order, joined, linked))
                order += 1
                sequence.append(SLOT)
            linked = 0

    def pop() -> None:
        flush()
        tag, node, sequence = stack.pop()
        open_[tag] -= 1
        _instance(node, sequence)

    def close(tags, borders) -> None:
        if not any(open_[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in borders:
                return

    def put(raw: str) -> None:
        nonlocal linked
        if muted:
            return
        if raw.isspace():
            text.append(" ")
        elif raw:
            raw = html.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                linked += len(raw.strip())

    at, end, quoted = 0, len(page), True
    unpaired: set[str] = set()  # quotes that don't come again
    unclosed: set[str] = set()  # raw elements that aren't closed any more
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            put(page[at:])
            break
        if lt > at:
            put(page[at:lt])
        after = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        found = _NAME_OF_TAG.match(page, lt)
        if found is None and after not in ("!", "?", "/"):
            put("<")
            at = lt + 1
            continue
        start = found.end() if found else lt + 1
        gt = page.find(">", start)
        if gt < 0:  # no tag ends any more
            put(page[lt:])
            break
        if found is None:
            at = gt + 1
            continue
        if quoted and ('"' in (inner := page[start:gt]) or "'" in inner):
            p = start
            while True:
                hit = _STOP.search(page, p)
                if hit is None:  # quotes don't pair: they say nothing from here on
                    quoted = False
                    break
                q, p = hit[0], hit.end()
                if q == ">":
                    gt = p - 1
                    break
                k = p - 2
                while k > start and page[k].isspace():
                    k -= 1
                if page[k] != "=" or q in unpaired:
                    continue
                stop = page.find(q, p)
                if stop < 0:
                    unpaired.add(q)
                else:
                    p = stop + 1
        tag, ends, attributes = found[1].lower(), after == "/", page[start:gt]
        at = gt + 1
        if not ends and (tag in _RAW or tag in _SKIPPED):
            closing = None if tag in unclosed else _CLOSING[tag].search(page, at)
            if closing is None:
                unclosed.add(tag)
            if closing is not None or tag in _RAW:
                at = end if closing is None else closing.end()
            text.append(" ")
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if ends else 1
            continue
        if ends:
            links = 0
            if tag in _VOID or tag in _RAW or tag in _SKIPPED:
                text.append(" ")
            elif over[tag]:
                flush()
                while True:
                    name, mute = below.pop()
                    over[name] -= 1
                    muted -= mute
                    if name == tag:
                        break
            else:
                close((tag,), () if tag in _KEPT_TAGS else ("td", "th", "table") if tag not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot") else ("table",) if tag != "table" else ())
                flush()
            continue
        if tag in _VOID:
            text.append(" ")
            continue
        links = 0
        if tag in ("html", "body") and open_[tag]:
            continue
        if tag in _ENDS:
            close(*_ENDS[tag])
        elif tag == "body":
            close(("head",), ())
        close(("p",), _P_BORDERS)
        flush()
        if len(stack) >= DEEP:
            over[tag] += 1
            below.append((tag, is_out(key_of(tag, attributes))))
            muted += below[-1][1]
            continue
        key = key_of(tag, attributes)
        _, above, sequence = stack[-1]
        sequence.append(key)
        node = above.children.get(key)
        if node is None:
            node = above.children[key] = Node(key)
        stack.append((tag, node, []))
        open_[tag] += 1
        if attributes.endswith("/") and tag not in _KEPT_TAGS:
            pop()
    while stack:
        pop()
    return root


def align(one: Node, other: Node) -> None:
    """Align ``other`` with ``one``, which becomes the wrapper of both. No recursion."""
    work = [(one, other)]
    while work:
        a, b = work.pop()
        for key, child in b.children.items():
            mine = a.children.get(key)
            if mine is None:
                a.children[key] = child
            else:
                work.append((mine, child))
        a.items = aligned(a.items, b.items)
        a.seen += b.seen
        a.inside += b.inside
        a.looped |= b.looped
        a.texts += b.texts
        if a.key == SLOT:
            a.slot = _slot_sum(a.slot, b.slot)


def _slot_sum(a: list[int], b: list[int]) -> list[int]:
    if not a[0] or not b[0]:
        return list(a if a[0] else b)
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])]


def walk(node: Node) -> Iterator[tuple[Node, tuple[str, ...]]]:
    """All slots and the paths of their elements."""
    work = [(node, ())]
    while work:
        here, path = work.pop()
        for key, child in here.children.items():
            if key == SLOT:
                yield child, path
            else:
                work.append((child, (*path, key)))


def sealed(node: Node) -> Node:
    """Texts give way to what the host's wrapper needs of them."""
    for slot, _ in walk(node):
        whole = " ".join(x for _, x, _ in slot.texts)
        h = xxhash.xxh32_intdigest(whole.encode("utf-8", "surrogatepass"))
        slot.slot, slot.texts = [1, len(whole), sum(n for _, _, n in slot.texts), h, h], []
    return node


def dump(node: Node) -> str:
    """A wrapper as JSON: a list of elements, each with its parent's number."""
    rows, work = [], [(node, -1)]
    while work:
        here, parent = work.pop()
        rows.append([parent, here.key, here.seen, here.inside, int(here.looped), here.slot if here.key == SLOT else here.items])
        number = len(rows) - 1
        work += [(child, number) for child in here.children.values()]
    return json.dumps(rows, ensure_ascii=False, separators=(",", ":"))


def load(text: str) -> Node:
    nodes: list[Node] = []
    for parent, key, seen, inside, looped, more in json.loads(text):
        node = Node(key)
        node.seen, node.inside, node.looped = seen, inside, bool(looped)
        if key == SLOT:
            node.slot = more
        else:
            node.items = [tuple(x) for x in more]
        nodes.append(node)
        if parent >= 0:
            nodes[parent].children[key] = node
    return nodes[0]


def expression(node: Node, of=lambda key: f"<{'.'.join(key.replace('|', ' ').split())}>", end=lambda key: f"</{key.partition('|')[0]}>", text: str = "#text") -> str:
    """The wrapper as a union-free regular expression over tags and text slots; an element is ``( <tag> .. </tag> )`` with + and ?."""
    out: list[str] = []
    work: list[str | tuple[Node, str]] = [(node, "")]
    while work:
        step = work.pop()
        if isinstance(step, str):
            out.append(step)
            continue
        here, mark = step
        if here.key == SLOT:
            out.append(f"({text}){mark}")
            continue
        inner: list[str | tuple[Node, str]] = []
        for item in here.items:
            if len(item) > 1:
                # as many of each as there are, in any order
                inner += ["(", *[(here.children[k], "?") for k in item], ")" + ("+" if any(here.children[k].inside == here.seen for k in item) else "*")]
            else:
                child = here.children[item[0]]
                optional = child.inside < here.seen
                inner.append((child, "*" if child.looped and optional else "+" if child.looped else "?" if optional else ""))
        if here.key:
            inner = ["(" + of(here.key), *inner, end(here.key) + ")" + mark]
        work += reversed(inner)
    return " ".join(out)


# the main part


def _kind(key: str) -> str:
    tag, _, _, role = (*key.split("|"), "", "", "")[:4]
    if is_out(key):
        return ""
    return "article" if tag == "article" or role == "article" else "main" if tag == "main" or role == "main" else ""


def _tag(key: str) -> str:
    return key.partition("|")[0]


def main_slots(wrapper: Node, names: bool = True) -> frozenset[tuple[str, ...]]:
    """Paths of the elements whose slots hold main text; ``names`` lets article and main elements decide."""
    nodes, parent, work = [], [], [(wrapper, -1)]
    while work:  # in the page's order, parents before their children
        node, above = work.pop()
        nodes.append(node)
        parent.append(above)
        listed = [k for item in node.items for k in item if k != SLOT]
        work += [(node.children[key], len(nodes) - 1) for key in reversed(listed)]
    every = range(len(nodes))
    tags, kinds = [_tag(n.key) for n in nodes], [_kind(n.key) for n in nodes]
    stats = [n.children[SLOT].slot if SLOT in n.children and n.children[SLOT].slot[1] else None for n in nodes]
    holds = [False] * len(nodes)  # a name such as "with-sidebar" on what holds the article says nothing
    for i in reversed(every[1:]):
        holds[parent[i]] |= bool(kinds[i]) or holds[i]
    out = [False] * len(nodes)
    for i in every[1:]:
        out[i] = out[parent[i]] or is_out(nodes[i].key) and (tags[i] in _OUT_TAGS or not holds[i])
    slots = [i for i in every if stats[i]]
    template = {i for i in slots if stats[i][0] >= SAME and stats[i][3] == stats[i][4]}
    if len(template) == len(slots):
        template = set()  # copies of one page
    good = [i for i in slots if not out[i]]
    mass = {i: stats[i][1] - stats[i][2] for i in good if i not in template and 2 * stats[i][2] < stats[i][1]}
    mass = mass or {i: stats[i][1] for i in good if i not in template} or {i: stats[i][1] for i in good}
    if not mass:
        return frozenset()
    below = [mass.get(i, 0) for i in every]
    for i in reversed(every[1:]):
        below[parent[i]] += below[i]
    root = max(i for i in every if below[i] == below[0])  # the lowest that has all
    while root and tags[root] in _LINES:
        root = parent[root]
    inside, heading = [False] * len(nodes), [False] * len(nodes)
    inside[root] = True
    for i in every[root + 1 :]:
        inside[i] = inside[parent[i]]
        heading[i] = inside[i] and (heading[parent[i]] or tags[i] in _HEADINGS)
    first, last = min(mass), max(mass)
    kept = [i for i in good if inside[i] and (i not in template or below[i] or i == root or heading[i] or (first < i < last and tags[i] in _LINES))]
    for kind in ("article", "main") if names else ():
        named = [k == kind for k in kinds]
        for i in every[1:]:
            named[i] |= named[parent[i]]
        chosen = [i for i in good if inside[i] and named[i]]
        if sum(mass.get(i, 0) for i in chosen) >= SHARE * below[0]:
            kept = chosen
            break

    def path(i: int) -> tuple[str, ...]:
        keys = []
        while i:
            keys.append(nodes[i].key)
            i = parent[i]
        return tuple(reversed(keys))

    return frozenset(map(path, kept))


def plan_of(wrapper: str) -> str:
    """A wrapper's main slots as JSON."""
    return json.dumps(sorted(main_slots(load(wrapper))), ensure_ascii=False)


@functools.lru_cache(maxsize=2000)
def _paths(plan: str) -> frozenset[tuple[str, ...]]:
    return frozenset(map(tuple, json.loads(plan)))


def extract(page: str | None, plan: str | None = None) -> str:
    """Main text of a page, by its host's plan, or by the page's own wrapper."""
    own = tree(page or "")
    slots = [(path, slot) for slot, path in walk(own)]
    found = []
    if plan is not None:
        paths = _paths(plan)
        found = [x for path, slot in slots if path in paths for x in slot.texts]
    if not found:
        texts = [(path, list(slot.texts)) for path, slot in slots]
        paths = main_slots(sealed(own))
        found = [x for path, items in texts if path in paths for x in items]
    return " ".join(x for _, x, _ in sorted(found))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html", parts: int = PARTS) -> DataFrame:
    """(host, pages, wrapper) of every host."""

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Node] = {}
        counts: dict[str, int] = {}
        size = 0

        def out() -> pd.DataFrame:
            rows = [(host, counts[host], dump(node)) for host, node in held.items()]
            return pd.DataFrame(rows, columns=["host", "pages", "wrapper"])

        for frame in frames:
            for host, page in zip(frame["host"], frame["page"], strict=True):
                node = sealed(tree(page or ""))
                counts[host] = counts.get(host, 0) + 1
                size += len(page or "")
                if host in held:
                    align(held[host], node)
                else:
                    held[host] = node
                if size > HELD:
                    yield out()
                    held.clear()
                    counts.clear()
                    size = 0
        yield out()

    def folded(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("wrapper")
        node = None
        for text in rows["wrapper"]:
            other = load(text)
            if node is None:
                node = other
            else:
                align(node, other)
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "pages": [np.int64(frame["pages"].sum())], "wrapper": [dump(node)]})

    schema = "host string, pages long, wrapper string"
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("page"))
    partly = source.mapInPandas(local, schema)
    part = F.pmod(F.xxhash64("wrapper"), F.lit(parts)).alias("part")
    return partly.groupBy("host", part).applyInPandas(folded, schema).groupBy("host").applyInPandas(folded, schema)


def plans(wrappers: DataFrame) -> DataFrame:
    """(host, plan) of ``infer``'s rows."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"host": frame["host"], "plan": [plan_of(x) for x in frame["wrapper"]]})

    return wrappers.select("host", "wrapper").mapInPandas(made, "host string, plan string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", wrappers: DataFrame | None = None) -> DataFrame:
    """(id, url, text, n_chars) of every page; ``wrappers`` as given by ``infer``, else inferred from these pages."""
    if wrappers is None:
        wrappers = infer(pages, url_col, html_col)
    made = common.stored(plans(wrappers), "plans")
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [extract(page, plan) for page, plan in zip(frame["page"], frame["plan"], strict=True)]
            yield pd.DataFrame({"id": frame["id"].array, "url": frame["url"].array, "text": texts, "n_chars": np.array([len(x) for x in texts], np.int64)})

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("page"))
    joined = rows.join(made, "host", "left").select("id", "url", "page", "plan")
    out = joined.mapInPandas(read, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
