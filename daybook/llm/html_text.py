"""Main text of web pages by scoring the element tree.

Every block of text gives points for its length and its commas to the elements
above it, the nearest most; an element's points shrink with the share of its text
that lies in links. The element with most points is kept, and of those beside it the
headings and all that have a paragraph and are not mostly links, without the menus,
forms, notices and comments inside them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Their content is never text of the page.
RAW = frozenset(
    "script style textarea title noscript iframe template svg select annotation annotation-xml".split()
)
# What these open goes on to the end of the page if it is never closed, as in a browser;
# of the others only the tag is skipped.
TO_THE_END = frozenset("script style textarea title".split())
# Elements that hold no part of an article, unless they are wrapped around it.
ASIDE = frozenset("nav header footer aside form button dialog menu label option".split())
# What an opening tag ends when it is still open.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"),
}
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An end tag of an inline element looks no further than this.
_LINE = BLOCKS - {"p"}
# Where such an ending stops looking.
SCOPES = {"li": ("ul", "ol", "menu"), "td": ("table",), "th": ("table",), "tr": ("table",)}

# Words in a class or id that mark parts which are not the article: of the layout, and
# notices or readers' words, which may well be longer than a short article.
_LAYOUT = re.compile(
    r"banner|breadcrumbs?|byline|dialog|footer|header|login|masthead|menu|modal|nav|navbar|navigation|"
    r"pager|pagination|popup|share|sharing|sidebar|signup|skip|skyscraper|social|tags|toolbar|tooltip|widgets?"
)
_NOTICE = re.compile(
    r"ads?|advert\w*|adsense|comments?|commentlist|consent|cookies?|copyright|disqus|gdpr|newsletter|"
    r"notices?|notifications?|promos?|promoted|promotion|recommended|related|replies|reply|respond|"
    r"sponsor\w*|subscribe|subscription"
)
# A compound is a mark if it ends in such a word, or goes on with these after it.
_NEUTRAL = re.compile(
    r"\d.*|area|articles|bar|block|body|bottom|box|buttons?|col|column|container|desktop|fixed|form|group|"
    r"holder|icons?|inner|items?|left|links?|list|message|meta|mobile|module|outer|overlay|panel|posts|"
    r"primary|region|right|row|secondary|section|slot|sticky|stories|text|title|top|unit|wrap|wrapper|zone"
)
# A name with one of these tells about something else on the page.
_ABOUT = frozenset("has have no non not with without".split())
_GOOD = re.compile(r"article|body|content|entry|main|post|story|text", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())

PARAGRAPH_WEIGHT = 25
# Lines that offer an answer to a reader's words.
ANSWER = frozenset("reply antworten répondre responder".split())
# Levels above a block whose points are kept apart, and what a level beyond keeps of them.
NEAR, FADING = 8, 0.9
_WEIGHTS = [1.0, 0.5, *[1 / (3 * level) for level in range(2, NEAR + 1)]]


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    mark: str = ""
    aside: bool = False
    bonus: float = 0.0
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    paragraph: bool = False


def _attributes(source: str) -> dict[str, str]:
    return {
        name.lower(): html.unescape(a or b or c) for name, a, b, c in _ATTRIBUTE.findall(source)
    }


def _named(names: str) -> str:
    """What the words of a class and an id mark: a notice, a part of the layout or nothing."""
    found = ""
    for name in names.lower().split():
        parts = [p for p in re.split("[-_]+", name) if p]
        if not _ABOUT.isdisjoint(parts):
            continue
        for part in reversed(parts):
            if _NOTICE.fullmatch(part):
                return "notice"
            if _LAYOUT.fullmatch(part):
                found = "layout"
            elif not _NEUTRAL.fullmatch(part):
                break
    return found


def _element(tag: str, source: str, parent: int) -> Element:
    mark, bonus = "form" if tag == "form" else "tag" if tag in ASIDE else "", 0.0
    if tag in ("article", "main"):
        bonus = 25.0
    if source.strip():
        given = _attributes(source)
        names = f"{given.get('class', '')} {given.get('id', '')}"
        named = "" if tag in ("html", "body", "article", "main") else _named(names)
        if (
            "hidden" in given
            or given.get("aria-hidden") == "true"
            or _HIDDEN.search(given.get("style", ""))
        ):
            mark = "hidden"
        elif named == "notice":
            mark = named
        elif given.get("role") in _ROLES:
            mark = "tag"
        elif mark != "tag":
            mark = named or mark
        if _GOOD.search(names):
            bonus += 10.0
    return Element(tag, parent, mark, bonus=bonus)


def parse(page: str) -> tuple[list[Element], list[tuple[int, str, int]]]:
    """The elements, each with its parent, and the blocks: (element, text, linked chars).

    Unclosed and stray tags are read as a browser would: an opening block ends an
    open paragraph, an end tag ends whatever is open inside its element.
    """
    elements = [Element("#page", -1)]
    blocks: list[tuple[int, str, int]] = []
    stack, run, linked, links = [0], [], 0, 0
    at, n, unclosed, still_open = 0, len(page), set(), Counter()

    def flush(owner: int) -> None:
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                blocks.append((owner, text, linked))
            run, linked = [], 0

    def owner() -> int:
        return next(e for e in reversed(stack) if e == 0 or elements[e].tag in BLOCKS or elements[e].mark)

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        run.append(text)
        if links:
            linked += len(text.strip())

    def close(position: int) -> None:
        """End the element at this depth and all inside it."""
        flush(owner())
        drop(position)

    def drop(position: int) -> None:
        nonlocal links
        for e in stack[position:]:
            links -= elements[e].tag == "a"
            still_open[elements[e].tag] -= 1
        del stack[position:]

    def find(tags: tuple[str, ...], scope: Collection[str] = ()) -> int | None:
        if not any(still_open[tag] for tag in tags):
            return None
        for depth in range(len(stack) - 1, 0, -1):
            tag = elements[stack[depth]].tag
            if tag in tags:
                return depth
            if tag in scope:
                return None
        return None

    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        if found.group(2) is None:
            continue
        tag = found.group(2).lower()
        if found.group(1):
            if tag == "br":
                run.append(" ")
                continue
            depth = find((tag,), () if tag in BLOCKS else _LINE)
            if depth is None:
                continue
            if tag in BLOCKS or elements[stack[depth]].mark:
                close(depth)
            else:
                drop(depth)
            continue
        if tag in RAW:
            if not found.group(3).rstrip().endswith("/"):
                end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in TO_THE_END:
                    at = n
                else:
                    unclosed.add(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                flush(owner())
            elif tag in ("br", "img"):
                run.append(" ")
            continue
        if tag in BLOCKS:
            depth = find(("p",), ("table", "td", "th", "li", "div", "article", "section"))
            close(depth) if depth is not None else flush(owner())
            depth = find(("option",), BLOCKS)
            if depth is not None:
                close(depth)
            if tag in ENDS:
                depth = find(ENDS[tag], SCOPES.get(tag, ("dl",)))
                if depth is not None:
                    close(depth)
        elif tag == "a":
            depth = find(("a",), BLOCKS)
            if depth is not None:
                links -= 1
                still_open["a"] -= 1
                del stack[depth]
        new = _element(tag, found.group(3), stack[-1])
        if new.mark:
            flush(owner())
        elements.append(new)
        stack.append(len(elements) - 1)
        still_open[tag] += 1
        links += tag == "a"
    flush(owner())
    return elements, blocks


def _set_aside(elements: list[Element], blocks: list[tuple[int, str, int]]) -> None:
    """Mark what is left out: all inside a marked element, unless the article lies in it.

    A mark other than hidden is ignored on an element that holds the page's main or
    article, on a form with most of the unlinked paragraphs outside of marks, and on a
    named part of the layout with four times as many. A notice holding an article must
    leave none of them outside. Outer elements come first, then those with more text.
    """
    over, level, hidden = [], [], []
    holds: dict[int, set[str]] = {}
    for i, e in enumerate(elements):
        up = over[e.parent] if i else -1
        over.append(i if e.mark else up)
        level.append((level[e.parent] if i else 0) + bool(e.mark))
        hidden.append(e.mark == "hidden" or bool(i) and hidden[e.parent])
    text, own, free = [0] * len(elements), [0] * len(elements), 0
    for owner, words, linked in blocks:
        unlinked = len(words) - min(linked, len(words))
        if unlinked < PARAGRAPH_WEIGHT or hidden[owner]:
            continue
        if over[owner] < 0:
            free += unlinked
        else:
            own[over[owner]] += unlinked
        text[owner] += unlinked
    # Inner elements come after outer ones. What a notice holds says nothing about the
    # elements around it.
    for i in range(len(elements) - 1, 0, -1):
        if elements[i].mark != "notice":
            text[elements[i].parent] += text[i]
    nearest = set()
    for i in range(len(elements) - 1, -1, -1):
        e = elements[i]
        if e.tag in ("article", "main") and text[i]:
            nearest.add(over[i])
            if over[i] >= 0:
                holds.setdefault(over[i], set()).add(e.tag)
        up = over[e.parent] if i else -1
        if i in holds and e.mark != "notice" and up >= 0:
            holds.setdefault(up, set()).update(holds[i])
    marked = [i for i, e in enumerate(elements) if e.mark and not hidden[i] and text[i]]
    outside, spared = -1 in nearest, set()
    for i in sorted(marked, key=lambda i: (level[i], -text[i])):
        mark, up = elements[i].mark, over[elements[i].parent]
        if up >= 0 and up not in spared:
            continue
        most = text[i] > free if mark != "notice" else free == 0
        held = holds.get(i, ())
        if (
            (not outside and ("main" in held or "article" in held and most))
            or (mark == "form" and most)
            or (mark == "layout" and text[i] > 4 * free)
        ):
            spared.add(i)
            free += own[i]
            outside |= i in nearest
    for i, e in enumerate(elements):
        e.aside = (bool(e.mark) and i not in spared) or bool(i) and elements[e.parent].aside


def _reader_comments(elements: list[Element], blocks: list[tuple[int, str, int]]) -> None:
    """Set aside what readers wrote, told by its structure: siblings that each can be answered.

    Two or more elements of one kind side by side, each with a line that offers a reply,
    are comments, whatever they are called. What is around them goes with them if it has
    no paragraph besides.
    """
    answered: dict[int, set[int]] = {}
    for owner, text, _ in blocks:
        if text.casefold() in ANSWER:
            element = elements[owner].parent
            for _ in range(NEAR):
                if element <= 0:
                    break
                answered.setdefault(elements[element].parent, set()).add(element)
                element = elements[element].parent
    comments = set()
    for children in answered.values():
        kinds = Counter(elements[i].tag for i in children)
        comments |= {i for i in children if kinds[elements[i].tag] > 1 and elements[i].tag in BLOCKS}
    if not comments:
        return
    inside, own, held = [False] * len(elements), [0] * len(elements), [False] * len(elements)
    for i in range(1, len(elements)):
        inside[i] = i in comments or inside[elements[i].parent]
    for owner, text, linked in blocks:
        own[owner] += not inside[owner] and not elements[owner].aside and len(text) - linked >= PARAGRAPH_WEIGHT
    for i in range(len(elements) - 1, 0, -1):
        own[elements[i].parent] += own[i]
        held[i] |= i in comments
        held[elements[i].parent] |= held[i]
    for i in range(1, len(elements)):
        around = held[i] and own[i] == 0 and own[0] > 0
        elements[i].aside |= inside[i] or around or elements[elements[i].parent].aside


def _leading_menus(elements: list[Element], blocks: list[tuple[int, str, int]]) -> set[int]:
    """Lists of links before the first heading or paragraph.

    Where no element bounds the article, it starts there.
    """
    started = (
        owner for owner, text, linked in blocks
        if elements[owner].tag in HEADS or len(text) - linked >= PARAGRAPH_WEIGHT
    )
    first = next(started, len(elements))
    links, around = [0] * len(elements), set()
    for i in range(len(elements) - 1, 0, -1):
        links[i] += elements[i].tag == "a"
        links[elements[i].parent] += links[i]
    element = first if first < len(elements) else -1
    while element >= 0:
        around.add(element)
        element = elements[element].parent
    return {
        i for i, e in enumerate(elements[:first])
        if e.tag in ("ul", "ol", "table", "div") and links[i] > 1 and e.linked > 0.8 * e.chars and i not in around
    }


def _add_up(elements: list[Element], blocks: list[tuple[int, str, int]]) -> None:
    """Points, characters, links and paragraphs of every element, each passed up once.

    Points reach the element around a block whole, the next one by half, then by a third
    over the distance; beyond NEAR levels they fade by a fixed part a level, so what an
    element has to pass on is a few sums however deep the page is.
    """
    near: dict[int, list[float]] = {}
    for owner, text, linked in blocks:
        weight = 1.0 if len(text) >= PARAGRAPH_WEIGHT else 0.25
        points = weight * (1 + text.count(",") + min(len(text) / 100, 3))
        first = owner
        if elements[owner].tag in ("p", "pre", "td", "li", "blockquote", "dd"):
            first = elements[owner].parent
        if first >= 0:
            near.setdefault(first, [0.0] * (NEAR + 1))[0] += points
        e = elements[owner]
        e.chars += len(text)
        e.linked += min(linked, len(text))
        e.paragraph |= len(text) - linked >= PARAGRAPH_WEIGHT
    for i in range(len(elements) - 1, -1, -1):
        e = elements[i]
        given = near.pop(i, None)
        if given is not None:
            e.points = sum(p * w for p, w in zip(given, _WEIGHTS, strict=True))
        if i:
            up = elements[e.parent]
            up.chars += e.chars
            up.linked += e.linked
            up.paragraph |= e.paragraph
            if given is not None:
                sums = near.setdefault(e.parent, [0.0] * (NEAR + 1))
                for level, points in enumerate(given[:-1]):
                    sums[level + 1] += points
                sums[NEAR] += given[NEAR] * FADING


def main_blocks(page: str) -> list[str]:
    """The blocks of the article, in page order."""
    elements, blocks = parse(page)
    _set_aside(elements, blocks)
    _reader_comments(elements, blocks)
    blocks = [b for b in blocks if not elements[b[0]].aside]
    _add_up(elements, blocks)

    def score(e: Element) -> float:
        return (e.points + e.bonus * (e.points > 0)) * (1 - e.linked / max(1, e.chars))

    if not blocks:
        return []
    scores = [score(e) for e in elements]
    best = max(range(len(elements)), key=lambda i: (scores[i], -i))
    # The article around the best container brings its headline along.
    element = best
    while element > 0:
        if elements[element].tag in ("article", "main"):
            best = element
        element = elements[element].parent
    kept = {best}
    whole = ("article", "main", "body", "html", "#page")
    if elements[best].tag not in whole:
        # A wrapper of nothing else has its siblings one level up.
        while elements[up := elements[best].parent].tag not in whole and elements[up].chars == elements[best].chars:
            best = up
        kept |= {
            i for i, e in enumerate(elements)
            if e.parent == elements[best].parent and not e.aside
            and (e.tag in HEADS or e.tag == "p" or (e.paragraph and e.linked < 0.5 * e.chars))
        }
        kept.add(best)
    else:
        threshold = max(10.0, 0.2 * scores[best])
        beside = elements[best].tag in ("article", "main")
        kept |= {
            i for i, e in enumerate(elements)
            if e.parent == elements[best].parent and not e.aside and (
                scores[i] >= threshold if e.tag == elements[best].tag
                else beside and (e.tag in HEADS or (e.paragraph and e.linked < 0.5 * e.chars))
            )
        }
    left = _leading_menus(elements, blocks) if elements[best].tag in ("body", "html", "#page") else set()
    inside: list[bool] = []
    for i, e in enumerate(elements):
        inside.append(i in kept or (e.parent >= 0 and inside[e.parent] and i not in left))
    return [text for owner, text, _ in blocks if inside[owner]]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = ["\n\n".join(main_blocks(page or "")) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page.

    Takes ``page_id``, ``url`` and ``html``; other columns are ignored. A null or
    empty page, or one without an article, has an empty text. Pages that repeat
    are answered one by one, whole pages are read whatever their length, and an
    empty table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_run, "page_id long, url string, text string")
