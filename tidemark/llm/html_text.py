"""Main text of web pages by two passes of rules over blocks.

A page becomes blocks: the text between tags that break lines.  The first pass
decides what it can: blocks in elements that name themselves boilerplate (by tag, role,
class or id; a class or id does not count on an element that holds the main text, and
within a line only if the whole of it is such a name) and blocks that are mostly links are
out; long blocks, and shorter ones with stop words, are
in.  Where articles outside boilerplate hold most of the text, blocks outside them are
out too; otherwise (teasers or comments that are articles) all blocks are judged alike.
The second pass gives every undecided block the label of the nearest decided
block of its own region (inside or outside the article), the preceding one if two
are as near; where a region has none, articles are in, and so is a page without an
article.

A projection: no shuffle, whole pages, one page in memory beyond its batch, in time linear
in its length.  Null or
empty html gives an empty text.  Broken markup (elements left open, stray end tags,
a page that ends within a tag) is read as far as it goes; only script, style, title and
textarea, whose content is no markup, run to the end of the page if left open.  Repeated rows are read
one by one; columns not named are dropped, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "title", "textarea")}
NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*+)", re.I)
SPECIAL = re.compile("[>\"']")
DROPPED = frozenset("noscript template svg math iframe object select button canvas audio video".split())
NESTING = frozenset("template svg math object".split())
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                       re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_ELEMENTS = frozenset("nav footer aside form menu dialog fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                      "toolbar".split())
BAD_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
    "signup login menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar rail related recommended "
    "recommendations share sharing social comment comments commentlist reply replies respond disqus discussion footer "
    "masthead topbar toolbar search widget copyright skip".split())
STOP_WORDS = frozenset(
    "a an and are as at be but by for from has have he in is it not of on or she that the they this to was were which "
    "with you der die das und ist im den von zu mit sich des ein eine nicht auf für es dem als auch an le la les de du "
    "et un une est que qui dans pour pas sur au aux par avec en el los las y del por con una para se su lo".split())
LONG, SHORT, STOP_DENSITY, LINK_DENSITY = 140, 40, 0.15, 0.5
PARTS = frozenset("has have no not with without".split())
SPLIT_NAMES = re.compile(r"[^a-z0-9]+")


def _named_bad(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in BAD_ELEMENTS or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = next(filter(None, values), "").lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value.strip() in BAD_ROLES:
            return True
    return False


def _name_is_bad(tag: str, attributes: str, whole: bool = False) -> bool:
    """Whether a class or the id is a boilerplate name, or, unless ``whole``, begins or
    ends with one and does not say that the element has, or has not, such a part."""
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() not in ("class", "id"):
            continue
        for one in next(filter(None, values), "").lower().split():
            if whole and one in BAD_NAMES:
                return True
            words = [w for w in SPLIT_NAMES.split(one) if w]
            if not whole and words and PARTS.isdisjoint(words) and not BAD_NAMES.isdisjoint((one, words[0], words[-1])):
                return True
    return False


class Tags:
    """The tags of a page in order, found in time linear in the page.  Where a tag ends is
    the first > outside its quotes; for all places at once that is worked out from the
    page's end, so what never closes is not searched again for every <."""

    def __init__(self, html: str) -> None:
        self.html = html
        self._marks = [m.start() for m in SPECIAL.finditer(html)]
        ends = [-1] * (len(self._marks) + 1)
        following: dict[str, int] = {}
        for i in range(len(self._marks) - 1, -1, -1):
            sign = html[self._marks[i]]
            if sign == ">":
                ends[i] = self._marks[i]
            else:
                closing = following.get(sign)
                ends[i] = ends[closing + 1] if closing is not None else -1
                following[sign] = i
        self._ends = ends

    def end(self, at: int) -> int:
        """Place of the > that closes a tag open at ``at``, or -1."""
        return self._ends[bisect_left(self._marks, at)]

    def __iter__(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        """(start, end, closing, name, attributes); no name for what is no element, and for
        elements whose content is no markup, which end with their end tag."""
        html, at = self.html, 0
        last = html.rfind(">")
        while (start := html.find("<", at)) >= 0:
            at = start + 1
            if html.startswith("<!--", start):
                close = html.find("-->", start + 4)
                at = close + 3 if close >= 0 else len(html)
                yield start, at, False, None, ""
                continue
            tag = NAME.match(html, start) if start < last else None
            if tag:
                name, closing = tag[2].lower(), bool(tag[1])
                raw = RAW_END.get(name) if not closing else None
                if raw and html[tag.end()] in " \t\n\r\f\v/>":
                    close = raw.search(html, html.find(">", tag.end()) + 1)
                    at = close.end() if close else len(html)
                    yield start, at, False, None, ""
                    continue
                close = self.end(tag.end())
                if close >= 0:
                    at = close + 1
                    yield start, at, closing, name, html[tag.end():close]
                    continue
            if html[start + 1:start + 2] in ("!", "?", "/"):
                close = html.find(">", start) if start < last else -1
                at = close + 1 if close >= 0 else len(html)
                yield start, at, False, None, ""


class Mark:
    """An element that only its name marks as boilerplate, and what it holds."""

    __slots__ = ("parent", "within", "good", "articles", "in_articles", "main")

    def __init__(self, parent: int, within: bool) -> None:
        self.parent, self.within = parent, within
        self.good = self.articles = self.in_articles = 0
        self.main = False


class Block:
    __slots__ = ("text", "linked", "bad", "region", "article", "mark")

    def __init__(self, text: str, linked: int, bad: bool, region: bool, article: bool, mark: int) -> None:
        self.text, self.linked, self.bad = text, linked, bad
        self.region, self.article, self.mark = region, article, mark


def dropped(tags: list[tuple[int, int, bool, str | None, str]]) -> dict[int, int]:
    """Start and end of the elements that hold no text of the page.  One that closes
    itself ends with its tag, and so does one that is left open."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for start, end, closing, tag, attributes in tags:
        if tag not in DROPPED:
            continue
        starts = opened.setdefault(tag, [])
        if not closing:
            ends[start] = end
            if not attributes.endswith("/"):
                starts.append(start)
        elif starts:
            ends[starts.pop()] = end
            if tag not in NESTING:
                starts.clear()
    return ends


def blocks(html: str) -> list[Block]:
    """Blocks of a page in order, each with its linked characters, whether an element
    around it names itself boilerplate, and whether it is in the article."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, int]] = []  # tag, bad, in <article> or <main>, in <article>, innermost mark
    marks: list[Mark] = []
    held: list[tuple[str, bool]] = []
    depth: Counter[str] = Counter()  # of the tags on the stack
    hidden: list[list] = []  # inline elements that name themselves boilerplate: tag, how often it is open
    bad = region = article = bad_paragraph = False
    links, mark, paragraph = 0, -1, -1

    def end_block() -> None:
        text = " ".join(unescape("".join(t for t, _ in held)).split())
        if text:
            linked = sum(len(" ".join(unescape(t).split())) for t, in_link in held if in_link)
            out.append(Block(text, linked, bad or bad_paragraph, region, article, max(mark, paragraph)))
        held.clear()

    def marked(around: int) -> int:
        marks.append(Mark(around, article))
        return len(marks) - 1

    tags = list(Tags(html))
    ends = dropped(tags)
    at = 0
    for start, end, closing, tag, attributes in tags:
        if start < at:
            continue
        if start > at and not hidden:
            held.append((html[at:start], links > 0))
        at = ends.get(start, end)
        if tag is None or start in ends:
            continue
        if tag in INLINE:
            if hidden and hidden[-1][0] == tag:
                hidden[-1][1] += -1 if closing else 1
                if not hidden[-1][1]:
                    hidden.pop()
            elif not closing and tag not in VOID and attributes and not attributes.endswith("/") and (
                    _named_bad(tag, attributes, region) or _name_is_bad(tag, attributes, True)):
                hidden.append([tag, 1])
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            elif tag == "br":
                held.append((" ", links > 0))
            continue
        end_block()
        links, paragraph, bad_paragraph = 0, -1, False
        hidden.clear()
        # Between the tags of a head only raw elements hold text, so where it ends does not matter.
        if tag in VOID or tag == "head":
            continue
        if tag == "p":
            # Ends with the next tag that breaks lines, so it needs no place on the stack.
            if not closing and attributes:
                bad_paragraph = _named_bad(tag, attributes, region)
                if not bad and not bad_paragraph and _name_is_bad(tag, attributes):
                    paragraph = marked(mark)
            continue
        if not closing:
            if not attributes.endswith("/"):
                stack.append((tag, bad, region, article, mark))
                depth[tag] += 1
            bad = bad or _named_bad(tag, attributes, region)
            if not bad and _name_is_bad(tag, attributes):
                mark = marked(mark)
            if tag in ("article", "main"):
                if mark >= 0 and not bad:
                    marks[mark].main |= tag == "main"
                    marks[mark].articles += tag == "article" and not article
                region, article = True, article or tag == "article"
        while closing and depth[tag]:
            one, bad, region, article, mark = stack.pop()
            depth[one] -= 1
            if one == tag:
                break
    rest = html[at:]
    if rest and not hidden and not re.match(r"<[a-z/!?][^>]*$", rest, re.I):
        held.append((rest, links > 0))
    end_block()
    settle(out, marks)
    return out


def settle(found: list[Block], marks: list[Mark]) -> None:
    """Makes the blocks in marked elements bad, unless the element holds the main text:
    <main>, or one article with most of the articles' long or stop-word-rich text and
    more of it than stands in no marked element, or most of that text on a page with no
    article.  A part of an article is never spared so."""
    if not marks:
        return
    total = unmarked = in_articles = 0
    for block in found:
        if not block.bad and first_pass(block, False):
            total += len(block.text)
            in_articles += len(block.text) * block.article
            if block.mark < 0:
                unmarked += len(block.text)
            else:
                marks[block.mark].good += len(block.text)
                marks[block.mark].in_articles += len(block.text) * block.article
    for mark in reversed(marks):
        if mark.parent >= 0:
            around = marks[mark.parent]
            around.good += mark.good
            around.articles += mark.articles
            around.in_articles += mark.in_articles
            around.main |= mark.main
    no_article = not any(b.article and not b.bad for b in found)
    bad: list[bool] = []
    for mark in marks:
        the_article = mark.articles == 1 and mark.in_articles > max(unmarked, in_articles // 2)
        spared = not mark.within and (mark.main or the_article or no_article and 2 * mark.good > total)
        bad.append(mark.parent >= 0 and bad[mark.parent] or not spared)
    for block in found:
        block.bad = block.bad or block.mark >= 0 and bad[block.mark]


def first_pass(block: Block, article: bool) -> bool | None:
    if block.bad or article and not block.region:
        return False
    if block.linked > LINK_DENSITY * len(block.text):
        return False
    if len(block.text) >= LONG:
        return True
    words = [w.strip(".,;:!?()\"'#$%&*|").lower() for w in block.text.split()]
    dense = sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words)
    return True if len(block.text) >= SHORT and dense else None


def holds_most(found: list[Block]) -> bool:
    """Whether articles outside boilerplate hold most of the text, links left out;
    text outside them counts where it is in by its own length and words."""
    inside = sum(len(b.text) for b in found if b.region and not b.bad and first_pass(b, False) is not False)
    return inside > sum(len(b.text) for b in found if not b.region and first_pass(b, False))


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    article = holds_most(found)
    labels = [first_pass(b, article) for b in found]
    # Decided blocks that may lend their label: those of the region in question.
    lends = [label is not None and not b.bad and (b.region or not article)
             for label, b in zip(labels, found, strict=True)]
    before: list[int | None] = []
    last = None
    for i, lend in enumerate(lends):
        last = i if lend else last
        before.append(last)
    after: list[int | None] = []
    last = None
    for i in range(len(lends) - 1, -1, -1):
        last = i if lends[i] else last
        after.append(last)
    after.reverse()
    kept = []
    for i, (block, label) in enumerate(zip(found, labels, strict=True)):
        if label is None:
            a, b = before[i], after[i]
            if a is None and b is None:
                label = True
            else:
                nearest = b if a is None or b is not None and b - i < i - a else a
                label = labels[nearest]
        if label:
            kept.append(block.text)
    return "\n".join(kept)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
            html_column: str = "html") -> DataFrame:
    """Rows (page_id, url, text), one for each row of ``pages``."""
    id_kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (id_column, url_column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts],
                                             ["page_id", "url", "text"])

    return pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"),
                        F.col(html_column).alias("html")).mapInArrow(
        run, f"page_id {id_kind}, url {url_kind}, text string")
