"""Main text of web pages by two-pass block rules.

Pass one cuts a page into blocks and judges each by its length, its share of stop words and its
share of link text; standing inside an article or main element is further evidence. Pass two gives
blocks too short to judge the label of their nearest decided neighbours. Only against a block tags
and names decide alone: menus, forms, notices, adverts, comments and hidden elements are left out.
Forms and named boxes that hold most of the page's text are taken for what they wrap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import map_batches

# Common words of the languages the rules know.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can do for from had has have he her his i if in into is it its no not
    of on or our she so that the their them there they this to was we were what when which who will with you
    aber als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer es für hat
    ich im ist man mit nach nicht noch nur oder sein sich sie sind so über um und von war wie wir zu zum zur
    au aux avec ce cette ces dans de des du elle en est et être il ils je la le les leur lui mais même ne nous
    ou par pas plus pour qu que qui sa se ses si son sont sur un une vous y
    al como con cuando del desde donde el ella ellos entre era es esta este fue ha hay las lo los más me mi muy
    nos o para pero por porque qué se sin sobre su sus también te tiene todo una uno ya yo
    """.split()
)
# Link text over this share makes a block a menu; shorter and longer blocks; shares of stop words.
# Under the last share a text is in none of the languages, and the share tells nothing.
MAX_LINKS, SHORT, LONG, FEW_STOPS, MANY_STOPS, NO_STOPS = 0.33, 70, 200, 0.12, 0.2, 0.02

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|iframe|template|svg|math|object|select|xmp)\b"
    r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b(?!\s*=)""", re.I)
_EDGES = ".,;:!?\"'()[]{}<>*#%$&/|_-–—«»‹›„“”‚‘’…¿¡"
_PARTS = re.compile(r"[^a-z0-9]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PLACES_OUT = frozenset("nav footer aside button dialog menu head audio video canvas".split())
_FORMS = frozenset(("form", "fieldset"))
_REGIONS = frozenset(("article", "main"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
_NAMES_OUT = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs sidebar aside widget footer masthead topbar comment comments commentlist disqus reply replies "
    "respond share sharing social related recommended recommendations pagination pager login search form hidden "
    "disclaimer copyright toolbar".split()
)
_ROLES_OUT = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_COMMENTS = frozenset(("comment", "comments", "commentlist", "reply", "replies", "respond", "disqus"))
# A form or a named box that holds more than this share of the page's text is none; less, where the
# name is only the first or last word of a longer one, such as site-sidebar or has-sidebar.
BOX_SHARE, PART_SHARE = 0.5, 0.25
# Long text without known stop words is read as prose if it has a sentence mark per so many characters.
SENTENCE = 300
_SENTENCE_MARKS = re.compile(r"[.!?…。！？؟।։]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    region: int  # number of the innermost article or main element around it, 0 for none
    article: bool  # inside an article
    out: bool  # inside a menu, form, notice, advert, comment or the like
    heading: int  # level of the heading it is, 0 for none


def _hints(attributes: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """Whole names in class and id, first and last words of longer ones, and whether role or style put it out."""
    names: set[str] = set()
    ends: set[str] = set()
    out = False
    for name, value, bare in _ATTRIBUTE.findall(attributes):
        if bare:
            out = True
            continue
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            for token in value.split():
                names.add(token)
                words = [w for w in _PARTS.split(token) if w]
                if len(words) > 1 or words and words[0] != token:
                    ends.update((words[0], words[-1]))
        elif name == "role":
            out |= value in _ROLES_OUT
        elif name == "style":
            out |= _HIDDEN.search(value) is not None
        else:
            out |= value == "true"
    return frozenset(names), frozenset(ends - names), out


def _box(tag: str, names: frozenset[str], ends: frozenset[str]) -> float | None:
    """The share of the page's text up to which the element is a form or box to leave out; None if it is none."""
    if names & _COMMENTS:
        return 1.0
    if tag in _FORMS or names & _NAMES_OUT or ends & _COMMENTS:
        return BOX_SHARE
    return PART_SHARE if ends & _NAMES_OUT else None


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page in order, each with where it stands."""
    found: list[Block] = []
    parts: list[str] = []
    linked = links = 0
    # Open elements: tag, and the state to go back to at its end: region, article, out, header, heading, boxes.
    stack: list[tuple[str, tuple[int, bool, bool, bool, int, tuple[int, ...]]]] = []
    region = regions = heading = 0
    article = out = header = False
    # Forms and named boxes around the place, the limit of each, and the boxes around each block.
    boxes: tuple[int, ...] = ()
    limits: list[float] = []
    around: list[tuple[int, ...]] = []
    forms: set[int] = set()

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            # Of a header inside an article its headings belong to the article.
            found.append(Block(text, linked, region, article, out or (header and not (region and heading)), heading))
            around.append(boxes)
        parts.clear()
        linked = 0

    def leave(index: int) -> None:
        nonlocal region, article, out, header, heading, boxes, links
        region, article, out, header, heading, boxes = stack[index][1]
        links -= sum(tag == "a" for tag, _ in stack[index:])
        del stack[index:]

    def add(text: str) -> None:
        nonlocal linked
        text = unescape(text) if "&" in text else text
        parts.append(text)
        if links:
            linked += len("".join(text.split()))

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br" or tag == "wbr":
                parts.append(" " if tag == "br" else "")
                continue
        else:
            close()
        if token["end"]:
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            # An inline end tag doesn't close the block around it.
            if open_at is not None and not (tag in _INLINE and any(t not in _INLINE for t, _ in stack[open_at:])):
                leave(open_at)
            continue
        attributes = token["attributes"]
        if tag in _VOID or attributes.endswith("/") and tag not in _PLACES_OUT | _REGIONS:
            continue
        if tag in _ENDS_PARAGRAPH or tag == "li":
            ended = ("p",) if tag != "li" else ("p", "li")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    leave(i)
                    break
                if stack[i][0] not in _INLINE:
                    break
        stack.append((tag, (region, article, out, header, heading, boxes)))
        if tag == "a":
            links += 1
        plain = not attributes or attributes.isspace()
        names, ends, hidden = (frozenset(), frozenset(), False) if plain else _hints(attributes)
        if tag in _REGIONS and not names & _COMMENTS and not hidden:
            regions += 1
            region, article, header = regions, article or tag == "article", False
            out = out and any(t in _PLACES_OUT for t, _ in stack)
            # Names around a region say nothing about it; forms are judged by what they hold.
            boxes = tuple(b for b in boxes if limits[b] == 1.0 or b in forms)
        elif tag not in ("html", "body"):
            out = out or hidden or tag in _PLACES_OUT
            header = header or tag == "header" or "header" in names | ends and tag not in _INLINE
            limit = _box(tag, names, ends)
            if limit is not None:
                if tag in _FORMS:
                    forms.add(len(limits))
                boxes = (*boxes, len(limits))
                limits.append(limit)
        heading = heading or (int(tag[1]) if tag in _HEADINGS else 0)
    if at < len(page):
        add(page[at:])
    close()
    held = [0] * len(limits)
    for block, inside in zip(found, around, strict=True):
        for box in inside:
            held[box] += 0 if block.out else len(block.text)
    whole = sum(len(b.text) for b in found if not b.out)
    left_out = {i for i, (size, limit) in enumerate(zip(held, limits, strict=True)) if size <= limit * whole}
    for block, inside in zip(found, around, strict=True):
        block.out = block.out or not left_out.isdisjoint(inside)
    return found


def _judge(block: Block) -> bool | None:
    """Pass one: good, bad, or None where the text can't be told. A region lifts doubtful text."""
    if block.out:
        return False
    size = len(block.text)
    if block.linked > MAX_LINKS * size or block.text.startswith(("©", "(c) ")):
        return False
    words = block.text.lower().split()
    stops = sum(w.strip(_EDGES) in STOP_WORDS for w in words) / len(words)
    if size < SHORT:
        return False if block.linked and not block.region else None
    if size > LONG and (stops >= MANY_STOPS or block.region and (stops >= FEW_STOPS or stops < NO_STOPS)):
        return True
    if size > LONG and stops < NO_STOPS and len(_SENTENCE_MARKS.findall(block.text)) * SENTENCE >= size:
        # Sentences of a language the list doesn't know: length and links decide.
        return True
    return None if stops >= FEW_STOPS or block.region else False


def _decided(labels: list[bool | None], seen: list[bool], groups: list[int]) -> list[int | None]:
    """For each block the last one before it that is decided, seen and of the same group."""
    last: dict[int, int] = {}
    before = []
    for i, (label, group) in enumerate(zip(labels, groups, strict=True)):
        before.append(last.get(group))
        if label is not None and seen[i]:
            last[group] = i
    return before


def _neighbours(labels: list[bool | None], seen: list[bool], groups: list[int]) -> list[tuple[int | None, int | None]]:
    """The nearest decided blocks of the same group before and after each block."""
    ahead = _decided(labels[::-1], seen[::-1], groups[::-1])[::-1]
    after = [None if i is None else len(labels) - 1 - i for i in ahead]
    return list(zip(_decided(labels, seen, groups), after, strict=True))


def _settle(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Pass two: a label for every block."""
    anywhere = [0] * len(found)
    around = _neighbours(labels, [True] * len(found), anywhere)
    # What was left out by its place says nothing about the text of a region beside it.
    judged = [not b.out for b in found]
    beside = _neighbours(labels, judged, anywhere)
    inside = _neighbours(labels, judged, [b.region for b in found])
    some_good = any(labels)
    good_regions = {b.region for b, label in zip(found, labels, strict=True) if label}
    settled = []
    for i, block in enumerate(found):
        label = labels[i]
        if label is False and block.heading and block.region and not block.out:
            # A title that is a link to its own page: it goes with good text right after it.
            following = next((j for j in range(i + 1, len(found)) if judged[j]), None)
            label = following is not None and labels[following] is True and found[following].region == block.region
        if label is None and block.region:
            label = _settle_in_region(found, labels, i, inside[i], beside[i], some_good, block.region in good_regions)
        elif label is None:
            left, right = around[i]
            near = {labels[j] for j in (left, right) if j is not None}
            # Between a good and a bad block: a heading goes with what follows it, other text is
            # good if it is long enough to have stop words. With nothing decided all of it stays.
            if len(near) == 1:
                label = near.pop()
            elif near:
                label = labels[right] if block.heading else len(block.text) >= SHORT
            else:
                label = True
        settled.append(bool(label))
    return settled


def _settle_in_region(
    found: list[Block],
    labels: list[bool | None],
    i: int,
    inside: tuple[int | None, int | None],
    beside: tuple[int | None, int | None],
    some_good: bool,
    good_region: bool,
) -> bool:
    block = found[i]
    # With no good text on the page what stands in regions is the best there is.
    if not some_good or block.heading == 1 and good_region:
        return True
    own = inside != (None, None)
    left, right = inside if own else beside
    near = [j for j in (left, right) if j is not None]
    values = {labels[j] for j in near}
    if values == {True}:
        # A region of undecided text at one side of a body outside articles is a teaser.
        return own or len(near) == 2 or found[near[0]].article
    if len(values) == 2:
        return labels[right] is True if block.heading else own or len(block.text) >= SHORT
    return False


def main_text(page: str | None) -> str:
    """The good blocks of a page, one blank line between them; empty for null and for pages without one."""
    if not page:
        return ""
    found = blocks(page)
    kept = _settle(found, [_judge(b) for b in found])
    return "\n\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract_main_text(frame: DataFrame, *, html: str = "html") -> DataFrame:
    """``frame`` without ``html`` and with ``text``, the main text of the page, and ``n_chars``.

    Null and empty pages have an empty text. Other columns are kept; columns of the two names are
    replaced. A page is read as a whole; repeated rows give repeated results.
    """
    kept = [c for c in frame.columns if c not in ("text", "n_chars", html)]
    source = frame.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html}`").alias("__html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(len(kept)).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [*batch.columns[: len(kept)], pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return map_batches(source, extract, ", ".join([*fields, "text string", "n_chars long"]))
