"""Main text of web pages by union-free regular expressions (wrappers) inferred from pages of the same host.

A page is a stream of tokens: block tags and runs of text, with the characters of it that are links.  Inline tags vanish (a line break is white
space; a formula's texts stay), comments, scripts, styles, drawings, what browsers show only in place of a medium, and optional end tags leave
no token; tags nested deeper than DEEP end a block but leave no token either.  A wrapper is a tree of units without unions: an element, a text,
an optional unit, or a repeated group of units (which are optional if there are several).  In a list of siblings no two units begin alike (name,
chrome words, and what the element begins with), so a wrapper is bounded by the kinds of elements of a host and matching needs no backtracking.
A wrapper starts as one page and is aligned with each further page that it does not match: what one side lacks becomes optional, what recurs, or
comes in another order, becomes a repeated group, and a text unit keeps the strings that it was equal to until there are over STRINGS, when it is a slot.
Units count what they matched: occurrences, characters, characters in links.

Every page takes part.  Tasks infer a wrapper of each host's pages among their rows and emit those, not pages; they are aligned with each other in
two rounds, which adds up their counts, so a hot host is never gathered.

The wrapper decides what is main text (`label`).  Content is text outside links that is no recurring string.  From the root down, the elements that carry at least
half of their parent's content on a page are followed; beside them what is mostly links, recurring strings, or short against the page (SHORT) is no main
text.  Where nothing carries the content alone, the article is reached, and all in it is main text.  Names (nav, footer, class words such as `sidebar` or
`comments`, or article and main) decide only where structure leaves it open: beside the carriers, inside the article, and between several carriers.
A page's text is what its match puts in the wrapper's main slots.  A page that is alone on its host, that its host's wrapper does not match, or whose main
slots hold under a quarter of its text (a rare layout) is labelled by a wrapper of its own.

Edge cases: null or empty html gives an empty text; a page without url or host belongs to the host ''; truncated tags and entities at the end are
dropped or kept as text as browsers do; an attribute's quote that is never closed reaches to the end; unclosed elements end with their container; within the
article nothing is dropped for being repeated or short.
"""

from __future__ import annotations

import hashlib
import html as entities
import itertools
import json
import re
import sys

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, text_or_empty, tune

DEEP = 512  # levels of elements, as HTML parsers have a limit of
HOSTS = 1000  # hosts whose wrappers a task holds before it emits them
STRINGS = 8  # strings that a text unit keeps
SHORT, BODY = 0.2, 200  # beside the carriers, what has under this share of a page's content is dropped where that is this many characters
RARE = 4  # pages with its strings before a text can count as recurring
SALTS = 64  # groups in which a host's wrappers are aligned before the last round
BROADCAST = 16 << 20  # bytes of wrappers that are sent to all executors; beyond it they are joined by a shuffle

# fixed values: element names of the HTML standard, and class words of page chrome
BLOCK = frozenset("html head title body article main section div header footer nav aside h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary hr menu dialog search template noscript iframe button select textarea option svg canvas video audio object legend label".split())
VOID = frozenset("hr".split())
RAW = frozenset("script style noscript template iframe svg textarea select canvas video audio object".split())
IMPLIED = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
HARD = frozenset("head title form fieldset button menu dialog search noscript template iframe select textarea option svg canvas video audio object legend label".split())  # never text of an article
SOFT = frozenset("nav footer aside header".split())
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption hr".split())  # text itself, not a place for it
WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply share sharing sidebar signup social sponsor sponsored subscribe widget".split())
NOT = frozenset("has with no without".split())  # what a class names after these is beside the element or absent: `has-sidebar`
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

SCOPES = frozenset("ul ol dl table td th blockquote".split())

# Attributes as browsers read them: a quote opens a value only after `=`, and one that is never closed reaches to the end.  No part gives back
# what it took, and whatever begins like a tag matches, so a page is read in one pass.
_VALUE = r"(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s\"'>][^\s>]*+)"
_ATTRIBUTES = rf"(?:[^\s>/=][^\s>/=]*+(?:\s*+=\s*+{_VALUE}?+)?+|[\s=]++|/(?!>))*+"
_CLOSED = rf"<(?:svg|math)(?=[\s/>]){_ATTRIBUTES}/>"  # a slash at the end of an unquoted value belongs to the value
_RAW = "script|style|noscript|template|iframe|svg|textarea|select|canvas|video|audio|object|annotation-xml|annotation"
_SCAN = re.compile(rf"{_CLOSED}|<!--(?:-?>|.*?(?:--!?>|\Z))|<({_RAW})(?=[\s/>]){_ATTRIBUTES}/?(?:>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})/?(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_HUGE = re.compile(r"&#(?:0*[0-9]{8,}|[xX]0*[0-9a-fA-F]{7,});?")  # no character has such a number
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def marks(attributes: str) -> tuple[str, ...]:
    """The chrome words of class and id, and the role, sorted."""
    if "=" not in attributes:
        return ()
    found = set()
    for m in _MARK.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            found |= {"role:" + w for w in value.lower().split()}
        else:
            for name in value.split():
                words = (w.lower() for w in _WORD.findall(name))
                found |= WORDS.intersection(itertools.takewhile(lambda w: w not in NOT, words))
    return tuple(sorted(found))


def tokens(page: str) -> list[tuple]:
    """(`<`, name, marks, what it begins with), (`>`, name) and (`t`, text with white space folded, its characters in links).  Tags are balanced."""
    out, stack, text, at = [], [], [], 0
    opened: dict[str, int] = {}
    linked, link_depth = 0, -1  # characters of the open text in links; depth of the open link's parent

    def flush():
        nonlocal linked
        if text:
            own = " ".join(entities.unescape(_HUGE.sub("\ufffd", "".join(text))).split())
            text.clear()
            if own:
                out.append(("t", own, min(linked, len(own))))
        linked = 0

    def put(part):
        nonlocal linked
        text.append(part)
        if link_depth >= 0:
            linked += len(part) if len(part) < 4 or part[0] > " " < part[-1] else len(part.strip())

    def close(k):
        nonlocal link_depth
        while len(stack) > k:
            own = stack.pop()
            opened[own] -= 1
            if len(stack) < DEEP:
                out.append((">", own))
        if link_depth > k:
            link_depth = -1

    def innermost(name, stops=()):
        """Place of the innermost open element of that name; -1 if none is open or a stop comes first."""
        k = len(stack) - 1 if opened.get(name) else -1
        while k >= 0 and stack[k] != name:
            k = -1 if stack[k] in stops else k - 1
        return k

    for m in _SCAN.finditer(page):
        if m.start() > at:
            put(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if m[1] or not name:
            continue
        if name == "br":
            text.append(" ")
        elif name == "a":
            link_depth = -1 if m[2] else len(stack)
        if name not in BLOCK or name in RAW or not m[0].endswith(">"):
            continue
        flush()
        if m[2]:
            if (k := innermost(name)) >= 0:
                close(k)
            continue
        if name in IMPLIED and opened.get(name):
            if (k := innermost(name, SCOPES)) >= 0:
                close(k)
        elif stack and stack[-1] == "p" and name not in IMPLIED:
            close(len(stack) - 1)  # a block element ends an open paragraph
        if len(stack) < DEEP:
            out.append(("<", name, marks(m[4] or "")))
        if name not in VOID:
            stack.append(name)
            opened[name] = opened.get(name, 0) + 1
        elif len(stack) < DEEP:
            out.append((">", name))
    if at < len(page):
        put(page[at:])
    flush()
    close(0)
    for k, token in enumerate(out):
        if token[0] == "<":
            after = out[k + 1]
            out[k] = (*token, after[1] if after[0] == "<" else TEXT if after[0] == TEXT else "")
    return out


# Units of a wrapper, lists that count what they matched: ["t", main, occurrences, characters, of these in links, {string: pages that hold it} or None],
# ["e", key, siblings, occurrences]; and ("?", unit), ("+", {key: unit}).  A key is what a unit begins with: "t", or (name, marks, first child).
TEXT = "t"


def keys(unit) -> list:
    if unit[0] == "e":
        return [unit[1]]
    if unit[0] == "+":
        return list(unit[1])
    return keys(unit[1]) if unit[0] == "?" else [TEXT]


def kinds(unit) -> dict:
    """The elements and texts of a unit by their keys."""
    if unit[0] == "?":
        return kinds(unit[1])
    return unit[1] if unit[0] == "+" else {keys(unit)[0]: unit}


def short_form(text: str) -> str:
    return text if len(text) <= 64 else f"{text[:40]}{hashlib.md5(text.encode('utf-8', 'surrogatepass')).hexdigest()}"


def strings_of(a: dict | None, b: dict | None) -> dict | None:
    """Strings of two text units: a slot (None) if there are too many different ones."""
    if a is None or b is None:
        return None
    both = dict(a)
    for x, n in b.items():
        both[x] = both.get(x, 0) + n
    return both if len(both) <= STRINGS else None


def both_of(a, b):
    """One unit of two with the same key."""
    if a[0] == TEXT:
        return [TEXT, False, a[2] + b[2], a[3] + b[3], a[4] + b[4], strings_of(a[5], b[5])]
    return ["e", a[1], generalise(a[2], b[2]), a[3] + b[3]]


def merged(units) -> dict:
    """Kinds of all units; those with equal keys become one."""
    out: dict = {}
    for unit in units:
        for k, own in kinds(unit).items():
            out[k] = both_of(out[k], own) if k in out else own
    return out


def collapse(units: list) -> list:
    """Siblings with each key in one unit: a stretch between units of one key becomes a repeated group."""
    last = {k: i for i, unit in enumerate(units) for k in keys(unit)}
    out, i = [], 0
    while i < len(units):
        start, end = i, i
        while i <= end:
            for k in keys(units[i]):
                end = max(end, last[k])
            i += 1
        if end == start:
            out.append(units[start])
        else:
            group = ("+", merged(units[start:i]))
            out.append(("?", group) if all(u[0] == "?" for u in units[start:i]) else group)
    return out


def generalise(a: list, b: list) -> list:
    """The wrapper of what either of two lists of siblings matches."""
    in_a = {k: i for i, unit in enumerate(a) for k in keys(unit)}
    in_b = {k: j for j, unit in enumerate(b) for k in keys(unit)}
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        ahead_b = min([in_b[k] - j for k in keys(a[i]) if in_b.get(k, -1) >= j], default=None)
        ahead_a = min([in_a[k] - i for k in keys(b[j]) if in_a.get(k, -1) >= i], default=None)
        if ahead_b == 0:
            both = merged([a[i], b[j]])
            unit = ("+", both) if len(both) > 1 or "+" in (bare(a[i])[0], bare(b[j])[0]) else next(iter(both.values()))
            out.append(("?", unit) if "?" in (a[i][0], b[j][0]) else unit)
            i, j = i + 1, j + 1
        elif ahead_b is not None and (ahead_a is None or ahead_b <= ahead_a):
            out.append(optional(b[j]))
            j += 1
        else:
            out.append(optional(a[i]))
            i += 1
    return collapse(out + [optional(u) for u in a[i:]] + [optional(u) for u in b[j:]])


def bare(unit):
    return unit[1] if unit[0] == "?" else unit


def optional(unit):
    return unit if unit[0] == "?" else ("?", unit)


def fold(page: list) -> list:
    """A page's stream as a wrapper that has counted it."""
    levels: list[list] = [[]]
    names = []
    for token in page:
        kind, value = token[:2]
        if kind == "<":
            names.append(token[1:])
            levels.append([])
        elif kind == ">":
            inner = collapse(levels.pop())
            levels[-1].append(["e", names.pop(), inner, 1])
        else:
            levels[-1].append([TEXT, False, 1, len(value), token[2], {short_form(value): 1}])
    made = collapse(levels[0])
    count_once(made)
    return made


def count_once(siblings: list) -> None:
    """A string that a page repeats counts once."""
    for unit in siblings:
        for own in kinds(unit).values():
            if own[0] != TEXT:
                count_once(own[2])
            elif own[5] is not None:
                own[5] = dict.fromkeys(own[5], 1)


def parse(siblings: list, page: list, at: int, met: list) -> int | None:
    """Match siblings against page[at:]: the position after them, or None.  `met` gets (unit, page index) of elements and texts."""
    for unit in siblings:
        must = unit[0] != "?"
        own = bare(unit)
        if own[0] == "+":
            group, times, most = own[1], 0, len(page)
            must = must and len(group) == 1
        else:
            group, times, most = None, 0, 1
        while times < most and at < len(page) and page[at][0] != ">":
            found = TEXT if page[at][0] == TEXT else page[at][1:]
            one = group.get(found) if group is not None else (own if found == (TEXT if own[0] == TEXT else own[1]) else None)
            if one is None:
                break
            met.append((one, at))
            if one[0] == TEXT:
                at += 1
            else:
                at = parse(one[2], page, at + 1, met)
                if at is None or at >= len(page) or page[at][0] != ">":
                    return None
                at += 1
            times += 1
        if must and not times:
            return None
    return at


def add_page(known: list | None, page: list) -> list:
    """The wrapper of what `known` matches and of a page, whose texts its units count."""
    if known is None:
        return fold(page)
    met: list = []
    if parse(known, page, 0, met) != len(page):
        return generalise(known, fold(page))
    seen = set()
    for unit, at in met:
        if unit[0] == TEXT:
            _, text, link = page[at]
            unit[2] += 1
            unit[3] += len(text)
            unit[4] += link
            if unit[5] is not None and (own := (id(unit), short_form(text))) not in seen:
                seen.add(own)
                unit[5] = strings_of(unit[5], {own[1]: 1})
        else:
            unit[3] += 1
    return known


def recurring(text) -> bool:
    """Whether a text unit is a template's: of few strings, each of which came on several pages."""
    return text[5] is not None and (times := sum(text[5].values())) >= RARE and times >= 2 * len(text[5])


class Sums:
    """Characters, characters in links, and content (characters outside links and recurring strings) below each unit; `free`: no string counts as recurring."""

    def __init__(self, siblings: list, free: bool):
        self.free, self.of = free, {}
        self.chars, self.links, self.content = self.add(siblings)

    def add(self, siblings: list) -> tuple[int, int, int]:
        total = [0, 0, 0]
        for unit in siblings:
            for own in kinds(unit).values():
                if own[0] == TEXT:
                    got = own[3], own[4], max(0, own[3] - 2 * own[4]) if self.free or not recurring(own) else 0
                else:
                    got = self.add(own[2]) if own[1][0] not in HARD else (0, 0, 0)
                self.of[id(own)] = got
                total = [x + y for x, y in zip(total, got, strict=True)]
        return tuple(total)


def label(siblings: list, pages: int) -> list:
    """The wrapper with its main slots marked, in place: what the counts of its units say, and names where they leave it open."""
    sums = Sums(siblings, False)
    if not sums.content:  # nothing but recurring strings: pages that are copies of each other
        sums = Sums(siblings, True)

    def keep(units):  # all texts but those of chrome inside an article
        for unit in units:
            for own in kinds(unit).values():
                if own[0] == TEXT:
                    own[1] = True
                elif own[1][0] not in HARD and (not named_chrome(own, True) or carries(own, units)):
                    keep(own[2])

    def carries(own, units):
        whole = sum(sums.of[id(x)][2] for u in units for x in kinds(u).values())
        chars, links, content = sums.of[id(own)]
        return own[1][0] not in SOFT and 2 * content > whole and 2 * links <= chars

    def heading(units):
        return any(own[0] != TEXT and (own[1][0] in ("h1", "h2", "h3") or heading(own[2])) for u in units for own in kinds(u).values())

    def descend(units, times, separated):
        own = [x for u in units for x in kinds(u).values()]
        elements = [x for x in own if x[0] != TEXT and x[1][0] not in HARD]
        usual = sum(sums.of[id(x)][2] for x in own) / times  # content here, a page
        carriers = [x for x in elements if x[1][0] in PLACES or (x[1][0] not in FLOW and sums.of[id(x)][2] and 2 * sums.of[id(x)][2] >= usual * x[3])]
        if any(not named_chrome(x, False) for x in carriers):
            carriers = [x for x in carriers if not named_chrome(x, False)]
        following, place = {id(x) for x in carriers}, any(x[1][0] in PLACES for x in carriers)
        dropped = set()
        for x in own:
            chars, links, content = sums.of[id(x)]
            if id(x) in following or (x[0] != TEXT and x[1][0] in HARD):
                continue
            poor = 2 * links > chars or not content  # links, or recurring strings
            slight = usual >= BODY and not separated and content < SHORT * usual * (x[2] if x[0] == TEXT else x[3])
            if x[0] == TEXT or x[1][0] in FLOW:
                out = poor and chars and not separated and sums.content > 0
            else:
                out = named_chrome(x, separated) or (chars and poor and not separated) or (carriers and (place or (slight and not heading(x[2]))))
            if out:
                dropped.add(id(x))
        if not carriers and separated:
            return keep(units)
        for x in own:
            if id(x) in following and (x[1][0] == "article"):
                keep(x[2])
            elif id(x) in following:
                descend(x[2], x[3], separated or place or bool(dropped))
            elif id(x) not in dropped:
                if x[0] == TEXT:
                    x[1] = True
                elif x[1][0] not in HARD:
                    keep(x[2])

    descend(siblings, max(1, pages), False)
    return siblings


def dump(pages: int, siblings: list) -> str:
    out: list = [pages]

    def put(units):
        for unit in units:
            if unit[0] == "?":
                out.append("?")
            own = bare(unit)
            if own[0] == TEXT:
                out.append([TEXT, *own[2:]])
            elif own[0] == "+":
                out.append("+")
                put(own[1].values())
                out.append(")")
            else:
                name, own_marks, first = own[1]
                out.append(["e", name, own_marks, first, own[3]])
                put(own[2])
                out.append(")")

    put(siblings)
    return json.dumps(out, ensure_ascii=True, separators=(",", ":"))


def load(written: str) -> tuple[int, list]:
    """(pages, wrapper without main slots)."""
    items = iter(json.loads(written))
    pages = next(items)

    def get():
        units, maybe = [], False
        for x in items:
            if x == ")":
                break
            if x == "?":
                maybe = True
                continue
            if x == "+":
                unit = ("+", {keys(u)[0]: u for u in get()})
            elif x[0] == TEXT:
                unit = [TEXT, False, *x[1:]]
            else:
                unit = ["e", (x[1], tuple(x[2]), x[3]), get(), x[4]]
            units.append(("?", unit) if maybe else unit)
            maybe = False
        return units

    return pages, get()


def infer(pages: list[str]) -> list:
    """Labelled wrapper of pages of one host."""
    deep()
    nodes, n = None, 0
    for page in pages:
        if stream := tokens(page):
            nodes, n = add_page(nodes, stream), n + 1
    return label(nodes or [], n)


def deep() -> None:
    """Room for the recursion over DEEP levels."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 16 * DEEP))


PLACES = ("article", "main")


def named_chrome(unit, inside: bool) -> bool:
    """Whether an element's name, role or class words are chrome's."""
    name, own, _ = unit[1]
    return chrome_by_name(name, own, inside or name in PLACES)


def chrome_by_name(name: str, own: tuple, inside: bool) -> bool:
    if name in ("html", "body", *PLACES):
        return False
    if inside:  # an article's own header holds its headline
        own = tuple(x for x in own if x not in ("header", "masthead"))
    return name in HARD or (name in SOFT and not (inside and name == "header")) or bool(own and (set(own) & WORDS or any(x[5:] in ROLES for x in own if x.startswith("role:"))))


def plain_size(page: list) -> int:
    """Characters outside links and outside what its name says is chrome."""
    total, path, bad, inside = 0, [], 0, 0
    for token in page:
        if token[0] == "<":
            path.append(token[1])
            inside += inside > 0 or token[1] in PLACES
            bad += bad > 0 or chrome_by_name(token[1], token[2], inside > 0)
        elif token[0] == ">":
            path.pop()
            bad -= bad > 0
            inside -= inside > 0
        elif not bad:
            total += len(token[1]) - token[2]
    return total


def main_slots(nodes: list, page: list) -> list[int] | None:
    """Indices of the texts in main slots, None if the wrapper does not match."""
    met: list = []
    if parse(nodes, page, 0, met) != len(page):
        return None
    return [at for unit, at in met if unit[0] == TEXT and unit[1]]


def extract(page: str, nodes: list | None) -> tuple[str, bool]:
    """(text, whether the host's wrapper matched the whole page); `nodes` None: the page is alone on its host."""
    stream = tokens(page)
    if not stream:
        return "", False
    main = main_slots(nodes, stream) if nodes is not None else None
    matched = main is not None
    if not matched or 4 * sum(len(stream[k][1]) for k in main) < plain_size(stream):  # alone, or of another layout than the host's other pages
        own = main_slots(label(fold(stream), 1), stream)
        main = own if own or not matched else main
        matched = matched or nodes is None
    return "\n".join(stream[k][1] for k in main), matched


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


FOUND = "host string, wrapper string"


def _wrappers(rows):
    return pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows], pa.string()), pa.array([w for _, w in rows], pa.string())], names=["host", "wrapper"])


def _infer(batches):
    """A task's wrappers by host."""
    deep()
    shapes: dict[str, list] = {}
    pages: dict[str, int] = {}

    def emit():
        made = _wrappers([(h, dump(pages[h], w)) for h, w in shapes.items()])
        shapes.clear()
        pages.clear()
        return made

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if stream := tokens(page):
                shapes[host] = add_page(shapes.get(host), stream)
                pages[host] = pages.get(host, 0) + 1
                if len(shapes) > HOSTS:
                    yield emit()
    yield emit()


def _align(batches):
    """Wrappers with equal (host, salt) become one; rows come sorted."""
    deep()
    made = []
    rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in ("host", "salt", "wrapper")), strict=True))
    for key, own in itertools.groupby(rows, lambda r: r[:2]):
        pages, nodes = 0, None
        for r in own:
            n, one = load(r[2])
            pages, nodes = pages + n, one if nodes is None else generalise(nodes, one)
        made.append((key[0], dump(pages, nodes)))
        if len(made) >= HOSTS:
            yield _wrappers(made)
            made = []
    yield _wrappers(made)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as `dump` writes it, pages) from all pages."""
    rows = pages.select(host_of("url").alias("host"), text_or_empty("html").alias("html"))
    shapes = cut(rows.mapInArrow(_infer, FOUND))
    for salts in (SALTS, 1):
        salted = shapes.select("host", F.pmod(F.xxhash64("wrapper"), F.lit(salts)).alias("salt"), "wrapper")
        shapes = salted.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(_align, FOUND)
    return cut(shapes.withColumn("pages", F.regexp_extract("wrapper", r"^\[(\d+)", 1).cast("long")))


def with_wrappers(rows: DataFrame, known: DataFrame) -> DataFrame:
    """`rows` (host, ...) with their host's wrapper; null for a host of one page, whose wrapper would be the page's own.

    Wrappers are broadcast up to BROADCAST bytes, measured.  Beyond it, those of the hosts with most pages are, again up to that many bytes; the others are
    joined by host, and pages of the broadcast hosts spread evenly in that shuffle.
    """
    known = known.where("pages > 1").withColumn("bytes", F.octet_length("wrapper") + F.octet_length("host") + 64)
    if (known.agg(F.sum("bytes")).first()[0] or 0) <= BROADCAST:
        return rows.join(F.broadcast(known.select("host", "wrapper")), "host", "left")
    level = F.floor(F.log2("pages")).cast("int")
    sizes = sorted(((r[0], r[1]) for r in known.groupBy(level.alias("level")).agg(F.sum("bytes")).collect()), reverse=True)  # at most 64 levels
    least, total = 64, 0
    for of, size in sizes:
        if total + size > BROADCAST:
            break
        least, total = of, total + size
    hot = F.broadcast(known.where(level >= least).select(F.col("host").alias("hot_host"), F.col("wrapper").alias("hot_wrapper")))
    rest = known.where(level < least).select(F.col("host").alias("rest_host"), F.lit(0).cast("long").alias("rest_spread"), F.col("wrapper").alias("rest_wrapper"))
    placed = rows.join(hot, F.col("host") == F.col("hot_host"), "left")
    placed = placed.withColumn("spread", F.when(F.col("hot_host").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("html").bitwiseOR(F.lit(1).cast("long"))))
    found = placed.join(rest, (F.col("host") == F.col("rest_host")) & (F.col("spread") == F.col("rest_spread")), "left")
    return found.withColumn("wrapper", F.coalesce("hot_wrapper", "rest_wrapper"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, wrapper_matched for every row."""
    tune(pages.sparkSession)
    loaded: dict[str, list] = {}

    def wrapper_of(source):
        if source is None:
            return None
        if source not in loaded:
            if len(loaded) > 500:
                loaded.clear()
            n, nodes = load(source)
            loaded[source] = label(nodes, n)
        return loaded[source]

    def texts(html: pd.Series, wrapper: pd.Series) -> pd.DataFrame:
        deep()
        return pd.DataFrame([extract(h, wrapper_of(w)) for h, w in zip(html, wrapper, strict=True)], columns=["text", "wrapper_matched"])

    udf = F.pandas_udf(texts, "text string, wrapper_matched boolean")
    rows = with_wrappers(pages.select("page_id", "url", text_or_empty("html").alias("html"), host_of("url").alias("host")), wrappers(pages))
    made = rows.select("page_id", "url", udf("html", "wrapper").alias("t"))
    return made.select("page_id", "url", "t.text", F.length("t.text").cast("long").alias("n_chars"), "t.wrapper_matched")
