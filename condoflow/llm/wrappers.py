"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page becomes a stream of block tags and text slots.  Repeats inside a page fold into ``+`` groups, which leaves few different
streams per host.  These are counted by Spark and then aligned one after the other: equal parts stay, a part that only one side
has becomes an optional group, and a part that differs only in how often it repeats becomes a repeated group.  The result is the
host's wrapper.  Its slots say which blocks of the host's pages are main text, and nothing outside them is taken: whether there are
slots in articles decides where the text stands, and its groups tell the replies to an article from its parts.  An article inside
another that stands in a repeated group is a reply, a reader's comment or a teaser, if the outer one has text of its own; also on
pages that have a single one, or whose others differ.  Outside articles
Spark counts for each slot on how many different pages the same text stands in it: text that stays the same on most of them is
part of the host's wrapper, not of the page, and falls.  Elements and class names that tell menus, notices and the like apart say
the rest.

Defined results: null html is empty and has no text; a url without a host, or a null one, belongs to the host ''; unclosed tags
end with their parent; a tag that never ends is text; pages without an article element use their body; where repeated text is more
than half of a page, the page is a copy of others and keeps it; equal rows count once for repeated text and give equal rows; extra
columns are ignored; an empty table gives none.  The work on a page grows with its length alone, up to the alignment of its
folded stream; articles are told apart by where the outermost one inside another stands.
"""

from __future__ import annotations

import difflib
import hashlib
import html
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condoflow.llm.common import staged

BRANCHES = (1024, 32, 1)  # parts of a host that are aligned apart, round by round
FIXED_PAGES = 4  # different pages that a slot needs before its text can be judged by repetition
FIXED_SHARE = 0.75  # share of them that have the same text in the slot
LONGEST_UNIT = 8  # tokens of a repeat that is folded
# Names of HTML elements by what they hold.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title svg iframe object select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
ASIDE = set("nav header footer aside form head menu button".split()) | RAW
ARTICLE = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
UNNAMED = ARTICLE | {"html", "body"}  # elements whose class does not tell what they are
ENDS_AT = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
           "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
HOLDERS = set("ul ol dl table select".split())
ASIDE_NAME = re.compile(
    r"(?:^|[-_ ])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|side-?bar|menu|nav\w*|breadcrumbs?|cookies?|consent|notice|popup|modal|"
    r"comments?|replies|respond|footer|header|masthead|share|sharing|social|related|recommend\w*|subscri\w*|newsletter|login|widget)"
    r"(?:$|[-_ ])", re.I)
NAME = re.compile(r"/?([a-zA-Z][\w:-]*)")
TAG_MARK = re.compile(r"[>\"']")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def tokens(page: str):
    """Pairs of kind and value: ``text``, ``start`` (name, name with its aside mark), ``end``; one pass over the page."""
    at, last_end, quoted = 0, page.rfind(">"), True

    def tag_end(start: int) -> int:
        """Place of the ``>`` that ends a tag, outside of quotes; once quotes do not close, they are characters like others."""
        nonlocal quoted
        here = start
        while quoted:
            mark = TAG_MARK.search(page, here)
            if mark and mark[0] == ">":
                return mark.start()
            here = page.find(mark[0], mark.end()) + 1 if mark else 0
            quoted = here > 0
        return page.find(">", start)

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0 or lt > last_end:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        closed = "-->" if page.startswith("<!--", lt) else "]]>" if page.startswith("<![CDATA[", lt) else ">" if page[lt + 1] in "!?" else ""
        if closed:
            stop = page.find(closed, lt + 2)
            at = stop + len(closed) if stop >= 0 else len(page)
            continue
        name = NAME.match(page, lt + 1)
        if not name:
            yield "text", "<"
            at = lt + 1
            continue
        stop = tag_end(name.end())
        at, name, rest = stop + 1, name[1].lower(), page[name.end() : stop]
        if page[lt + 1] == "/":
            yield "end", name
            continue
        names = " ".join("".join(x) for x in NAMED.findall(rest)) if "=" in rest and name not in UNNAMED else ""
        yield "start", (name, f"{name}!" if ASIDE_NAME.search(names) else name)
        if name in RAW and not rest.rstrip().endswith("/"):
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.start() if stop else len(page)


SLOT = "#"  # token of a text slot; those not aside also say in what they stand


class Place:
    """An open element: its label, a key of all labels down to it, whether it lies in an article or in something aside, and the
    token of its text slots: ``#`` aside, ``#:p`` outside articles, ``#a:p`` in one, ``#<key>:p`` in an article inside another."""

    __slots__ = ("label", "key", "article", "aside", "inner", "nested", "slot")

    def __init__(self, label: str = "", above: Place | None = None):
        self.label, self.inner = label, {}
        self.key = digest(f"{above.key}<{label}") if above else 0
        self.article = bool(above) and (above.article or label in ARTICLE)
        self.aside = bool(above) and (above.aside or label.endswith("!") or label in ASIDE)
        # the outermost article inside an article, if any: its key, and -1 below a single article
        self.nested = above.nested if above else 0
        if label == "article":
            self.nested = {0: -1, -1: self.key}.get(self.nested, self.nested)
        self.slot = SLOT if self.aside else f"{SLOT}{f'{self.nested}' if self.nested not in (0, -1) else 'a' if self.article else ''}:{label}"

    def below(self, label: str) -> Place:
        if label not in self.inner:
            self.inner[label] = Place(label, self)
        return self.inner[label]


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def is_block(label: str) -> bool:
    return label not in INLINE


def walk(stream):
    """Steps (event, place, value): ``slot`` with its text, ``break``, and ``open``/``close`` of blocks with their label."""
    path = [Place()]
    count: dict[str, int] = {}  # open elements by name

    def close():
        label = path.pop().label
        count[label.rstrip("!")] -= 1
        return "close", path[-1], label

    for kind, value in stream:
        if kind == "text":
            yield "slot", path[-1], value
        elif kind == "start":
            name, label = value
            if name == "br" or name == "hr":
                yield "break", path[-1], name
            # an inline element is a block of its own where its name says what it is, and inside such an element of its kind
            if name in VOID or not (is_block(label) or count.get(name)):
                continue
            ends = ENDS_AT.get(name, {"p"} if name not in INLINE else set())
            while path[-1].label.rstrip("!") in ends:
                yield close()
            path.append(path[-1].below(label))
            count[name] = count.get(name, 0) + 1
            yield "open", path[-1], label
        elif count.get(value):
            while path[-1].label.rstrip("!") != value:
                yield close()
            yield close()


def skeleton(page: str) -> list:
    """Block tags and text slots of a page, repeats folded."""
    out: list = []
    for event, where, value in walk(tokens(page)):
        if event == "slot":
            if value.strip() and (not out or out[-1] != where.slot):
                out.append(where.slot)
        elif event == "open":
            out.append(f"<{value}>")
        elif event == "close":
            out.append(f"</{value}>")
    return fold(out)


def fold(items: list) -> list:
    """Neighbouring repeats of up to LONGEST_UNIT items become one ``+`` group."""
    for size in range(1, LONGEST_UNIT + 1):
        out, k = [], 0
        while k < len(items):
            unit = items[k : k + size]
            n = 1
            while len(unit) == size and items[k + n * size : k + (n + 1) * size] == unit:
                n += 1
            if n > 1:
                out.append(unit[0] if size == 1 and is_group(unit[0], "+") else ["+", unit])
                k += n * size
            else:
                out.append(items[k])
                k += 1
        items = out
    # a unit beside a group of itself belongs to it
    out = []
    for item in items:
        out.append(item)
        for group, rest in ((out[-1], out[:-1]),):
            if is_group(group, "+") and rest[-len(group[1]) :] == group[1]:
                out = rest[: -len(group[1])] + [group]
        for size in range(1, LONGEST_UNIT + 1):
            if len(out) > size and is_group(out[-size - 1], "+") and out[-size - 1][1] == out[-size:]:
                out = out[:-size]
                break
    return out


def is_group(item, kind: str) -> bool:
    return isinstance(item, list) and item[0] == kind


def bare(items: list) -> list:
    """The items without their quantifiers."""
    return [x for item in items for x in (bare(item[1]) if isinstance(item, list) else [item])]


def align(left: list, right: list) -> list:
    """A wrapper that covers both sides."""
    keys = [[json.dumps(bare([x])) for x in side] for side in (left, right)]
    out = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        one, two = left[a:b], right[c:d]
        if op == "equal":
            for x, y in zip(one, two):
                out.append(x if x == y else y if not isinstance(x, list) else x if not isinstance(y, list) else widest(x, y))
        elif bare(one) == bare(two):
            out += one if any(is_group(x, "+") for x in one) else two
        else:
            out += [x if is_group(x, "?") else ["?", [x]] for x in one] if len(one) == 1 else [["?", one]] if one else []
            out += [x if is_group(x, "?") else ["?", [x]] for x in two] if len(two) == 1 else [["?", two]] if two else []
    return fold(out)


def widest(x: list, y: list) -> list:
    """Of two groups of the same content, the one that allows more."""
    if x[0] == y[0]:
        return [x[0], align(x[1], y[1])] if x[1] != y[1] else x
    return ["?", [x if x[0] == "+" else y]]


def merge_wrappers(column: str, branch: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        wrapper: list | None = None
        for text in sorted(set(frame[column]), key=lambda t: (len(t), t)):
            other = json.loads(text)
            wrapper = other if wrapper is None else wrapper if wrapper == other else align(wrapper, other)
        return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(wrapper or [])], "branch": [int(key[1]) % branch]})

    return run


def has_article(slots) -> bool:
    """Whether some of the slots lies in an article and in nothing aside."""
    return any(not slot.startswith(f"{SLOT}:") for slot in slots)


def replies(wrapper: list) -> set[str]:
    """Keys of the articles inside others that a repeated group holds whole."""
    found: set[str] = set()

    def search(items: list) -> None:
        for item in items:
            if is_group(item, "+"):
                depth = 0
                for token in bare(item[1]):
                    depth = depth + 1 if token == "<article>" else max(0, depth - 1) if token == "</article>" else depth
                    if depth and token[0] == SLOT and token[1:2] not in ("", ":", "a"):
                        found.add(token.split(":")[0][1:])
            if isinstance(item, list):
                search(item[1])

    search(wrapper)
    return found


def main_slots(wrapper: list) -> frozenset[str]:
    """The slots of a host's wrapper whose text is not aside: all but those of replies, where the article has text beside them."""
    slots = {token for token in bare(wrapper) if token[0] == SLOT and token != SLOT}
    if any(slot.startswith(f"{SLOT}a:") and slot[3:] not in HEADINGS for slot in slots):
        dropped = replies(wrapper)
        slots = {slot for slot in slots if slot.split(":")[0][1:] not in dropped}
    return frozenset(slots)


def text_blocks(page: str) -> tuple[list, bool]:
    """Blocks of text (place, text) that are in nothing aside, and whether the page has an article."""
    found, parts = [], []
    place, article = None, False

    def finish():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((place, text))

    for event, where, value in walk(tokens(page)):
        if event == "slot":
            if not where.aside:
                place = where if not parts else place
                parts.append(value)
        elif event == "break" or value.rstrip("!") not in INLINE:
            finish()
            article = article or where.article and not where.aside
    finish()
    return found, article


def main_text(page: str, in_articles: bool, fixed, slots=None) -> str:
    """Blocks of a page's articles if the wrapper has slots in articles, else all but those whose text is ``fixed`` for their slot.

    With ``slots`` only blocks in these slots of the wrapper count.
    """
    found, article = text_blocks(page)
    if slots is not None:
        found = [(place, text) for place, text in found if place.slot in slots]
    if in_articles and article:
        return "\n".join(text for place, text in found if place.article)
    own = [text for place, text in found if place.article or digest(f"{place.key}#{text}") not in fixed]
    everything = [text for _, text in found]
    return "\n".join(own if 2 * sum(map(len, own)) >= sum(map(len, everything)) else everything)


def skeletons():
    def run(batches):
        for b in batches:
            found = [json.dumps(skeleton(page or "")) for page in b.column("html").to_pylist()]
            yield pa.record_batch([b.column("host"), pa.array(found, pa.string())], names=["host", "wrapper"])

    return run


def slot_texts():
    """Task: slots outside articles and the texts in them, once a page; ``content`` is null in one row of each slot."""

    def run(batches):
        for b in batches:
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                seen = {(p.key, content) for p, text in text_blocks(page or "")[0] if not p.article for content in (None, digest(f"{p.key}#{text}"))}
                if seen:
                    slot, content = zip(*seen)
                    yield pa.record_batch(
                        [pa.array([host] * len(seen)), pa.array([digest(page)] * len(seen)), pa.array(slot), pa.array(content, pa.int64())],
                        names=["host", "page", "slot", "content"])

    return run


def extract():
    def run(batches):
        plans: dict[str, tuple] = {}
        for b in batches:
            out = []
            for k, (host, page) in enumerate(zip(b.column("host").to_pylist(), b.column("html").to_pylist())):
                if host not in plans:
                    if len(plans) > 1000:
                        plans.clear()
                    slots = main_slots(json.loads(b.column("wrapper")[k].as_py()))
                    plans[host] = has_article(slots), frozenset(b.column("fixed")[k].as_py() or ()), slots
                out.append(main_text(page or "", *plans[host]))
            rest = [c for c in b.schema.names if c not in ("html", "wrapper", "host", "fixed")]
            yield pa.record_batch([*(b.column(c) for c in rest), pa.array(out, pa.string())], names=[*rest, "text"])

    return run


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON: tokens, ``["?", items]``, ``["+", items]``) of pages with ``host`` and ``html``."""
    seen = pages.select("host", "html").mapInArrow(skeletons(), "host string, wrapper string").distinct()
    seen = seen.withColumn("branch", F.pmod(F.xxhash64("wrapper"), F.lit(BRANCHES[0])).cast("int"))
    for following in (*BRANCHES[1:], 1):
        seen = seen.groupBy("host", "branch").applyInPandas(merge_wrappers("wrapper", following), "host string, wrapper string, branch int")
    return seen.select("host", "wrapper")


def fixed_texts(pages: DataFrame) -> DataFrame:
    """``host`` and ``fixed``: keys of the texts that most of the host's different pages have in the same slot.

    A slot can have no more such texts than 1 / FIXED_SHARE of those of one page.
    """
    on = pages.select("host", "html").mapInArrow(slot_texts(), "host string, page long, slot long, content long").distinct()
    on = staged(on.groupBy("host", "slot", "content").agg(F.count("*").alias("n")).where(F.col("n") >= FIXED_SHARE * FIXED_PAGES))
    of_slot = on.where("content is null").select("host", "slot", F.col("n").alias("pages"))
    often = on.where("content is not null").join(of_slot, ["host", "slot"])
    often = often.where((F.col("pages") >= FIXED_PAGES) & (F.col("n") >= FIXED_SHARE * F.col("pages")))
    return often.groupBy("host").agg(F.collect_set("content").alias("fixed"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page`` (id), ``url`` and ``text`` (main text, one block a line) of each page."""
    url = F.col(f"`{url_col}`")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(f"`{id_col}`").alias("page"), url.alias("url"), host.alias("host"), F.col(f"`{html_col}`").alias("html"))
    wrappers = staged(infer_wrappers(rows).join(fixed_texts(rows), "host", "left"))
    kind = f"page {rows.schema['page'].dataType.simpleString()}, url string, text string"
    return rows.join(wrappers, "host").select("page", "url", "host", "html", "wrapper", "fixed").mapInArrow(extract(), kind)


def op3_html_extraction(pages: DataFrame) -> DataFrame:
    """Main text of each page."""
    return extract_text(pages).select(F.col("page").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
