"""Main text of web pages by two passes of rules over their blocks.

The first pass decides blocks by where they stand, link density, length and density of stop words.
Short blocks and those of middling density stay open; the second pass gives each the label of the
nearest decided block of its region (an article, a main part, or the page outside of these).

A listed name rejects an element as a whole token of its class, id or role, or in a few fixed
compounds; never an article or main part, nor an element that holds one, except a list of comments
or related articles behind an article. Lack of stop words rejects only on pages of the four languages.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from fareflow.llm.columns import only

SHORT, LONG = 70, 200  # characters
MAX_LINKS = 0.33       # share of characters in links
STOP_LOW, STOP_HIGH = 0.10, 0.20

# Frequent function words of four languages.
STOP_WORDS = frozenset("""
the of and to in a is that it for was on are as with be by at from this or an not have you but which his they he she we all were
der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei
le la les de des et en un une du est que qui dans pour par sur au pas plus se avec ce il elle sont ou son aux
el los las del y que en un una es por con para no se su al lo como más o pero sus le ha
""".split())

# Elements and names of what is no article.
_DROPPED = frozenset("head nav footer aside dialog menu button fieldset label".split())
_BAD_NAMES = frozenset("""
ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion
nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc
header masthead footer copyright sidebar aside widget widgets related recommended recommendations
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
comment comments disqus replies reply respond share sharing social search contentinfo complementary dialog
""".split())
# Compounds of a listed name; others, as has-sidebar or comment-open, say how an element looks.
_BAD_COMPOUND = re.compile(r"(?:ads?|advert|advertisement|cookies?|gdpr)-.*|(?:site|main|page|global|primary|secondary|top|bottom)-(?:nav|navbar|navigation|menu|footer)")
_AFTER_ARTICLE = frozenset("comment comments disqus replies reply respond related recommended recommendations".split())
# Names, and the element form, that may stand for the article's own container where a page has no other text.
_MAY_HOLD = frozenset("form widget widgets notice notices alert banner header masthead overlay promo promotion".split())
_REGIONS = frozenset(("article", "main"))
_LANGUAGES = frozenset(("en", "de", "fr", "es"))
_INLINE = frozenset("""
a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q ruby rt s samp small span strike strong sub sup time tt u var wbr
""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_STACK = _INLINE | _VOID | {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
_ENDED_BY_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(r"""
    <!--.*?(?:-->|\Z)
  | <(script|style|noscript|template|textarea|select|svg|iframe|object|title|math|canvas|video|audio)(?=[\s/>])[^>]*+>
  | <(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>
  | <(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>
  | <[!?/][^>]*+>
""", re.S | re.I | re.X)
# What ends an element of no text that has no end tag; scripts and styles then go to the page's end.
_BLOCK_TAG = re.compile(r"""</?(?:address|article|aside|blockquote|body|center|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header
  |hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(?=[\s/>])""", re.I | re.X)
_CODE = frozenset(("script", "style"))
# Elements that hold no other of their kind before a block: a second start tag there shows that the first has no end.
_NOT_NESTED = frozenset(("title", "select", "svg", "math"))
_DECLARED = re.compile(r"""<html\s[^>]{0,1000}?(?<![\w:-])(?:xml:)?lang\s*=\s*["']?\s*([a-z]+)""", re.I)
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)


def _is_bad(tag: str, attributes: str) -> bool:
    if tag in _DROPPED:
        return True
    return bool(attributes) and tag not in ("html", "body") and _is_hidden(attributes)


def _is_hidden(attributes: str) -> bool:
    """By an attribute ``hidden``, ``aria-hidden=true`` or a style; the word in other values says nothing."""
    lower = attributes.lower()
    if "hidden" not in lower and "display" not in lower:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


def _bad_names(tag: str, attributes: str) -> set[str]:
    """The names for which the element is no article, unless it holds one; a form is one by its tag."""
    if tag == "form":
        return {"form"}
    if not attributes or tag in ("html", "body") or tag in _REGIONS:
        return set()
    names = {n for m in _NAMED.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().replace("_", "-").split()}
    return {n for n in names if n in _BAD_NAMES or _BAD_COMPOUND.fullmatch(n)}


class _Raw:
    """Ends of a page's elements of no text; each kind of tag is looked up once in the page."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.places: dict[str, list[tuple[int, int]]] = {}

    def _next(self, name: str, pattern: str | re.Pattern, at: int) -> tuple[int, int] | None:
        if name not in self.places:
            self.places[name] = [m.span() for m in re.compile(pattern, re.I if isinstance(pattern, str) else 0).finditer(self.page)]
        found = self.places[name]
        i = bisect_left(found, (at, 0))
        return found[i] if i < len(found) else None

    def end(self, tag: str, at: int) -> int:
        """Where the element ends whose start tag ends at ``at``."""
        if self.page[at - 2] == "/":
            return at
        close = self._next("/" + tag, rf"</{tag}\s*>", at)
        if tag in _CODE:
            return close[1] if close else len(self.page)
        if close and tag not in _NOT_NESTED:
            return close[1]
        block = self._next("", _BLOCK_TAG, at)
        if close:
            again = self._next(tag, rf"<{tag}(?=[\s/>])", at)
            if not (block and again and block[0] < again[0] < close[0]):
                return close[1]
        return block[0] if block else len(self.page)


@dataclass
class Named:
    """An element rejected by name, until an article or main part is found in it."""
    spares: bool
    may_hold: bool = False  # whether it is spared too where the page has nothing else
    bad: bool = True


@dataclass
class Block:
    region: int
    bad: bool
    named: tuple[Named, ...] = ()
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None

    def rejected(self) -> bool:
        return self.bad or any(n.bad for n in self.named)


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order, with markup removed and references decoded."""
    stack: list[tuple[str, bool, int, tuple[Named, ...]]] = []  # element, whether it is no article, region, elements rejected by name
    regions, link, at, article = 0, 0, 0, False
    page_top = ("", False, 0, ())
    out = [Block(0, False)]

    def add(raw: str) -> None:
        if raw:
            out[-1].parts.append(raw)
            if link:
                out[-1].linked += len(raw.strip())

    def fresh(bad: bool = False) -> None:
        top = stack[-1] if stack else page_top
        if out[-1].parts:
            out.append(Block(top[2], top[1] or bad, top[3]))
        else:
            out[-1] = Block(top[2], top[1] or bad, top[3])

    raw = _Raw(page)
    while token := _TOKEN.search(page, at):
        add(page[at:token.start()])
        at = token.end()
        if token[1]:
            at = raw.end(token[1].lower(), at)
            continue
        tag, close, attributes = (token[3] or token[6] or "").lower(), token[2] or token[5], token[4] or token[7] or ""
        if not tag:
            continue
        if tag == "a":
            link = 0 if close else 1
            continue
        if tag in _INLINE:
            continue
        if tag == "br":
            add(" ")
            continue
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            link = 0
            fresh()
            continue
        if tag == "body":
            stack = [s for s in stack if s[0] != "head"]
        while stack and stack[-1][0] in _ENDED_BY_NEXT.get(tag, ()):
            stack.pop()
        top = stack[-1] if stack else page_top
        in_region = top[2] != 0
        bad = _is_bad(tag, attributes) or (tag == "header" and not in_region)
        names = _bad_names(tag, attributes)
        link = 0
        if tag in _NO_STACK:
            fresh(bad or bool(names))
            continue
        region, named = top[2], top[3]
        if names:
            named += (Named(not article or _AFTER_ARTICLE.isdisjoint(names), names <= _MAY_HOLD),)
        if tag in _REGIONS and not (top[1] or bad) and all(n.spares for n in named):
            for n in named:
                n.bad = False
            regions += 1
            region = regions
            article = article or tag == "article"
        if not attributes.rstrip().endswith("/"):
            stack.append((tag, top[1] or bad, region, named))
        fresh()
    add(page[at:])
    kept = []
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        if b.text:
            kept.append(b)
    return kept


def decide(found: list[Block], declared: str = "") -> list[Block]:
    """Label all blocks: first by their own numbers, then open ones by the nearest decided block.

    ``declared`` is the page's language, if it names one. Where that is none of the four, or stop
    words are few all over the page, they decide nothing: blocks that are not short are good.
    Regions leave out what is outside of them, unless only there a block is good by its own numbers.
    """
    stops, size, dense = [], 0, 0.0
    bad = [b.rejected() for b in found]
    for b, no in zip(found, bad):
        words = b.text.lower().split()
        stops.append(sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words))
        if not no and b.linked <= MAX_LINKS * len(b.text):
            size, dense = size + len(b.text), dense + stops[-1] * len(b.text)
    known = (not declared or declared in _LANGUAGES) and dense >= STOP_HIGH * size
    alone = [not no and b.linked <= MAX_LINKS * len(b.text) and (bool(b.region) or "©" not in b.text)
             and (len(b.text) >= LONG and stop >= STOP_LOW or len(b.text) >= SHORT and (stop >= STOP_HIGH or not known))
             for b, no, stop in zip(found, bad, stops)]
    has_region = any(b.region and not no for b, no in zip(found, bad))
    empty_regions = has_region and any(alone) and not any(ok and b.region for b, ok in zip(found, alone))
    for b, no, stop, ok in zip(found, bad, stops, alone):
        links = b.linked / len(b.text)
        if no or links > MAX_LINKS or (has_region and bool(b.region) == empty_regions):
            b.good = False
        elif not b.region and ("©" in b.text or (len(b.text) < SHORT and links > 0)):
            b.good = False
        elif ok:
            b.good = True
        elif len(b.text) >= LONG and not b.region:
            b.good = False
    decided = [(i, b.region, b.good) for i, b in enumerate(found) if b.good is not None and not b.rejected()]
    for region in {b.region for b in found if b.good is None}:
        near = [(i, good) for i, r, good in decided if r == region]
        at = 0
        for i, b in enumerate(found):
            if b.region != region or b.good is not None:
                continue
            while at < len(near) and near[at][0] < i:
                at += 1
            sides = [(abs(near[k][0] - i), near[k][1]) for k in (at - 1, at) if 0 <= k < len(near)]
            least = min((d for d, _ in sides), default=0)
            labels = {good for d, good in sides if d == least}
            # A tie, or a region without any decided block: the article's in a region, not outside.
            b.good = labels.pop() if len(labels) == 1 else bool(region)
    return found


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order, joined by a space. Null or empty pages have none."""
    declared = _DECLARED.search(page or "")
    language, found = declared[1].lower() if declared else "", blocks(page or "")
    if not any(b.good for b in decide(found, language)):
        # Nothing is left: what was rejected by name alone, and holds a long text, was the article's container.
        for b in found:
            if len(b.text) >= LONG and b.linked <= MAX_LINKS * len(b.text) and not b.bad and all(n.may_hold for n in b.named if n.bad):
                for n in b.named:
                    n.bad = False
        for b in found:
            b.good = None
        decide(found, language)
    return " ".join(b.text for b in found if b.good)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py()) for p in batch.column("html")]
        rest = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                         [*rest, "text", "n_chars"])


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (its code points) of every row of ``pages``.

    Each row is handled by itself, repeated rows too; other columns, whatever their names, take no part. An empty table gives
    an empty result. A heading in front of an article element is not part of it.
    """
    rows = only(pages, "page_id", "url", "html")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
