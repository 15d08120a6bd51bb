"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines: a block element's text, its white space turned into single spaces, is a line with a number
of characters, of which some are in links. Sums over sliding windows of lines decide: where a window's sum leaves
zero text surges, where it falls back to zero it dives, and the lines between make a region. A region is as strong as its
strongest window, links left out. Regions with a tenth of the strongest one's strength are strong enough, and the text from
the first of them to the last is kept, whole. Headings right before the first belong to it.

Tags are boundaries. Elements that never hold main text by their kind or because they aren't shown (menus, asides,
footers, forms, scripts, styles, hidden ones) count as zero: inside an <article> or <main> as one line, so that windows reach
over them, and elsewhere as a full window, so that text dives there and at the edges of <article> and <main>. If the
strongest window of all is inside an <article> or <main>, text outside counts as zero, too. Otherwise they say nothing
(teasers, say), and a region with half of its characters in links is not strong.

Names (class, id, role) only lower weights. A block that is named, as a whole, for something beside main text (an advert or
a notice, say) is a region of its own, whose windows count for LOWERED of their sums: it stays if it outweighs all else
and is long in itself. In main text, blocks named for what is mostly links (related pages, sharing) are named blocks only if at least half of
their characters are in links. Blocks named for reader comments stay only where a page has no other region. ``hidden`` and the like say
that an element isn't shown.

Null and empty pages give an empty text. Pages of any length and any markup are read in a time in proportion to their
length. Pages are independent; repeated rows and ties need no rule; unclosed elements end where their parent does or where
main text begins. An <article> inside a closed element that never holds main text goes with it, unless that is a form: whole
pages are put in one. Only the page and the key columns are read, so other columns may have any name; a key with the name
of a column to be made is an error. An empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Element and attribute names of HTML, and words that sites put in class, id and role.
RAW = "script style noscript template iframe title textarea".split()
EMBEDDED = "svg math object canvas audio video".split()
SKIPPED = "nav footer aside form menu button select dialog fieldset label".split()
INLINE = "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
NOT_MAIN = (
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay "
    "sidebar side widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager masthead topbar header footer colophon copyright legal comment comments commentlist reply replies disqus respond "
    "share sharing social related recommended newsletter subscribe signup login search toolbar skip"
).split()
#: Those of them that name a place for links rather than what it says: such a block is judged by its links.
OF_LINKS = "popup modal overlay share sharing social related recommended newsletter subscribe signup login search toolbar skip".split()
#: Words that may stand beside those in a name without changing what it names.
PLACES = "left right top bottom upper lower first second primary secondary site global page mobile desktop sticky fixed visually slot unit box block area bar panel list links link items item buttons button icons form wrap wrapper container inner outer posts articles stories section zone user users reader readers thread policy".split()
NOT_SHOWN = "hidden visually-hidden sr-only screen-reader-text d-none".split()
#: Skipped elements that may stand within a sentence.
IN_SENTENCES = "label button select".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
TITLED = "article content entry post story".split()
#: Elements whose end tag may be left out; the next of the kind ends them.
OPTIONAL = "p li dd dt tr td th".split()

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
QUOTED = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
WORDS = re.compile("[a-z]+")
COMMENT = re.compile("(comment|reply)(?![a-z])")
COMMENTS = re.compile("comment|repl(?:y|ies)|disqus|respond")
ENDS = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW + EMBEDDED}

#: Lines of a window; the share of the strongest region; the most of a region that may be links; the weight of a named
#: block, and the characters its strongest window has at least.
WINDOW, SHARE, LINKED, LOWERED, NAMED_LEAST = 3, 0.1, 0.5, 0.02, 1_000
#: Tags whose quotes don't end; from the last on, a tag ends at its first ">".
UNENDING = 16


class Tag(NamedTuple):
    close: bool
    name: str
    attributes: str


def scan(page: str) -> list[str | Tag]:
    """A page's texts and tags in order, without comments and elements that hold no text. No part is read over and over."""
    out: list[str | Tag] = []
    begin = at = 0
    behind_last, trusted, unended = page.rfind(">") + 1, UNENDING, set()

    def text(until: int) -> None:
        if until > begin:
            out.append(page[begin:until])

    while 0 <= (at := page.find("<", at)) < behind_last or page.startswith("<!--", at if at >= 0 else len(page)):
        if page.startswith("<!--", at):
            text(at)
            end = page.find("-->", at + 4)
            begin = at = end + 3 if end >= 0 else len(page)
        elif page.startswith("<![CDATA[", at):
            text(at)
            end = page.find("]]>", at)
            end = end if end >= 0 else len(page)
            out.append(page[at + 9 : end])
            begin = at = min(end + 3, len(page))
        elif page[at + 1 : at + 2] in ("!", "?"):
            text(at)
            begin = at = page.find(">", at) + 1
        elif found := NAME.match(page, at):
            whole = QUOTED.match(page, found.end()) if trusted else None
            trusted -= whole is None and trusted > 0
            end = whole.end() if whole else page.find(">", found.end()) + 1
            if not end:
                break
            text(at)
            close, name = bool(found[1]), found[2].lower()
            begin = at = end
            if not close and name in ENDS:
                ended = None if name in unended else ENDS[name].search(page, end)
                if ended:
                    begin = at = ended.end()
                    out.append(" ")
                elif name in RAW:
                    begin = at = len(page)
                else:
                    unended.add(name)
            elif name not in ENDS:
                out.append(Tag(close, name, page[found.end() : end - 1]))
        else:
            at += 1
    text(len(page))
    return out


def ended(tokens: list[str | Tag]) -> set[int]:
    """The places of start tags that have an end tag of their own."""
    found, opened = set(), {}
    for i, t in enumerate(tokens):
        if isinstance(t, Tag):
            if not t.close:
                opened.setdefault(t.name, []).append(i)
            elif opened.get(t.name):
                found.add(opened[t.name].pop())
    return found


def given(attributes: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def says_beside(token: str, in_main: bool) -> list[str]:
    """The words with which a class, id or role as a whole names something beside main text: all its words do, or say where it stands ("ad-slot", "left-sidebar")."""
    words = WORDS.findall(token)
    if words and words[-1] == "header" and (in_main or words[0] in TITLED):
        return []
    return [w for w in words if w in NOT_MAIN] if all(w in NOT_MAIN or w in PLACES for w in words) else []


def shown(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or NO_DISPLAY.search(attributes.get("style", "")):
        return False
    return not any(t in NOT_SHOWN for t in attributes.get("class", "").lower().split())


def named_beside(name: str, attributes: dict[str, str], in_main: bool) -> list[str]:
    """The words with which a block's names say that it is beside main text. Ids of headings are made of their own words."""
    if name in ("html", "body", "main"):
        return []
    tokens = f"{attributes.get('class', '')} {attributes.get('role', '')}".lower().split()
    slugs = attributes.get("id", "").lower().split() if name not in HEADINGS else []
    if name == "article":
        return ["comment"] if any(COMMENT.match(t) for t in tokens + slugs) else []
    return [w for t in tokens + slugs for w in says_beside(t, in_main)]


class Enclosure:
    """An element that the reader is inside of; ``closed`` says that it has an end tag of its own."""

    def __init__(self, name: str, closed: bool, inline: bool = False):
        self.name, self.closed, self.inline, self.depth, self.articles = name, closed, inline, 1, 0

    def holds(self, tag: Tag, starts_main: bool) -> bool:
        """Whether ``tag`` belongs to the element; if not, it has ended before. After its end tag, depth is 0."""
        begins = starts_main and (tag.name == "main" or self.name == "form" or not self.closed)
        outer = tag.close and tag.name in ("body", "html", "article", "main") and tag.name != self.name and not (tag.name == "article" and self.articles)
        next_one = self.name in OPTIONAL and not self.closed and not tag.close and tag.name == self.name
        if begins or outer or next_one or (self.name == "p" and tag.name not in INLINE and not (tag.close and tag.name == "p")):
            return False
        step = -1 if tag.close else 1
        self.depth += step * (tag.name == self.name)
        self.articles += step * (tag.name == "article" != self.name)
        return True


class Line(NamedTuple):
    """A line's text, its characters in links, whether it is in a main element, whether a heading, and its named block (0: none, below 0: reader comments)."""

    text: str
    linked: int = 0
    main: bool = False
    heading: bool = False
    block: int = 0


class Lines:
    """Reads a page's lines. None stands for a blank line, an empty line in main text for what is skipped there."""

    def __init__(self, page: str):
        self.lines: list[Line | None] = []
        self.parts: list[str] = []
        self.linked = self.main = self.blocks = self.block_now = 0
        self.of_links: list[int] = []
        self.link = self.heading = False
        self.skip: Enclosure | None = None
        self.named: Enclosure | None = None
        tokens = scan(page)
        self.ended = ended(tokens)
        for place, t in enumerate(tokens):
            if isinstance(t, Tag):
                self.tag(place, t)
            elif not self.skip:
                self.parts.append(t)
                self.linked += len(t) if self.link else 0
        self.end()
        self.free_blocks()

    def free_blocks(self) -> None:
        """Blocks that are named for links and hold other text, for the most part, are no named blocks."""
        total, linked = dict.fromkeys(self.of_links, 0), dict.fromkeys(self.of_links, 0)
        for x in self.lines:
            if x and x.block in total:
                total[x.block] += len(x.text)
                linked[x.block] += x.linked
        free = {b for b in total if linked[b] < LINKED * total[b]}
        if free:
            self.lines = [x._replace(block=0) if x and x.block in free else x for x in self.lines]

    def end(self) -> None:
        """The block that was open is a line."""
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            self.lines.append(Line(text, min(self.linked, len(text)), self.main > 0, self.heading, self.block_now if self.named else 0))
        self.parts, self.linked, self.heading = [], 0, False

    def boundary(self) -> None:
        self.end()
        self.lines += [Line("", main=True)] if self.main else [None] * WINDOW

    def tag(self, place: int, tag: Tag) -> None:
        name, attributes = tag.name, given(tag.attributes) if tag.attributes and not tag.close else {}
        starts_main = not tag.close and name in ("article", "main") and shown(attributes) and not named_beside(name, attributes, True)
        if self.skip:
            if self.skip.holds(tag, starts_main):
                self.skip = self.skip if self.skip.depth else None
                return
            self.skip = None  # it ended without an end tag of its own
        if self.named and (not self.named.holds(tag, starts_main) or not self.named.depth):
            self.boundary()
            self.named = None
        if name == "a":
            self.link = "href" in attributes
        inline = name in INLINE
        if not tag.close and name not in VOID and (not shown(attributes) or name in SKIPPED or (name == "header" and not self.main)):
            if not inline and name not in IN_SENTENCES:
                self.boundary()
            self.skip = Enclosure(name, place in self.ended, inline)
        elif inline:
            if name == "br":
                self.parts.append(" ")
        else:
            self.block(place, tag, attributes, starts_main)

    def block(self, place: int, tag: Tag, attributes: dict[str, str], starts_main: bool) -> None:
        self.end()
        if tag.name in ("article", "main"):
            if starts_main and not self.main:
                self.boundary()
            self.main = max(0, self.main + (-1 if tag.close else 1))
            if tag.close and not self.main:
                self.boundary()
        if not tag.close and not self.named and tag.name not in VOID and (words := named_beside(tag.name, attributes, self.main > 0)):
            self.boundary()
            self.blocks += 1
            self.block_now = -self.blocks if any(COMMENTS.match(w) for w in words) else self.blocks
            if self.main and all(w in OF_LINKS for w in words):
                self.of_links.append(self.block_now)
            self.named = Enclosure(tag.name, place in self.ended)
        self.heading = not tag.close and tag.name in HEADINGS


def window_sums(values: list[int], window: int) -> list[int]:
    """For each line, and as many behind the last, the sum of the ``window`` values that end there."""
    upto = [0] * window + list(accumulate(values, initial=0)) + [sum(values)] * window
    return [hi - lo for lo, hi in zip(upto, upto[window:])][1:]


def regions(lengths: list[int], unlinked: list[int] | None = None, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, strength) of each stretch of lines over which no window's sum of ``lengths`` is zero.

    The strength is the largest window's sum of ``unlinked``, or of ``lengths`` where that isn't given.
    """
    found, start, last, strength = [], None, 0, 0
    sums = window_sums(lengths, window)
    for i, (total, strong) in enumerate(zip(sums, sums if unlinked is None else window_sums(unlinked, window))):
        if not total:
            if start is not None:
                found.append((start, last + 1, strength))
                start = None
            continue
        if start is None:
            start, strength = i, 0
        if i < len(lengths) and lengths[i]:
            last = i
        if strong > strength:
            strength = strong
    return found


def passed_over(line: Line | None) -> bool:
    """Whether a line is in main text, and no part of its windows: runs of such lines count as one without text."""
    return line is not None and line.main and (line.block != 0 or not line.text)


def kept(lines: list[Line | None]) -> list[int]:
    """The places of the lines between the first surge and the last dive of strong regions."""
    at = [i for i, x in enumerate(lines) if not (passed_over(x) and i and passed_over(lines[i - 1]))]

    def counted(which: list[bool]) -> tuple[list[int], list[int]]:
        taken = [lines[i] if which[i] else None for i in at]
        return [len(x.text) if x else 0 for x in taken], [len(x.text) - x.linked if x else 0 for x in taken]

    def strongest(found: list[tuple[int, int, int]]) -> int:
        return max((strength for *_, strength in found), default=0)

    plain = [x is not None and not x.block for x in lines]
    within = [y and x.main for x, y in zip(lines, plain)]
    lengths, unlinked = counted(within)
    found = regions(lengths, unlinked)
    inside = strongest(found) > 0 and strongest(found) >= strongest(regions(*counted([y and not z for y, z in zip(plain, within)])))
    if not inside:
        lengths, unlinked = counted(plain)
        found = [r for r in regions(lengths, unlinked) if sum(lengths[r[0] : r[1]]) - sum(unlinked[r[0] : r[1]]) < LINKED * sum(lengths[r[0] : r[1]])]
    counts = within if inside else plain
    #: Where, how strong, whether of a named block.
    weighed = [(at[lo], at[hi - 1] + 1, float(strength), False) for lo, hi, strength in found]
    places: dict[int, list[int]] = {}
    for i, x in enumerate(lines):
        if x and x.block:
            places.setdefault(x.block, []).append(i)
    for block, own in places.items():
        if block < 0 and found:
            continue
        of = [lines[i] for i in own]
        strength = strongest(regions([len(x.text) for x in of], [len(x.text) - x.linked for x in of]))
        if strength >= NAMED_LEAST:
            weighed.append((own[0], own[-1] + 1, LOWERED * strength, True))
    least = SHARE * max((strength for _, _, strength, _ in weighed), default=0)
    strong = [r for r in weighed if r[2] >= least and r[2] > 0]
    if not strong:
        return []
    surge, dive = min(r[0] for r in strong), max(r[1] for r in strong)
    while surge and counts[surge - 1] and lines[surge - 1].heading:
        surge -= 1
    blocks = {lines[lo].block for lo, _, _, named in strong if named}
    return [i for i in range(surge, dive) if (x := lines[i]) and x.text and (counts[i] or x.block in blocks)]


def main_text(page: str | None) -> str:
    """The page's main text, blocks joined by newlines."""
    lines = Lines(page or "").lines
    return "\n".join(lines[i].text for i in kept(lines))


def extract(pages: DataFrame, page: str = "html", text: str = "text", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per row of ``pages``: the key columns, the main text and n_chars, its code points."""
    if {text, "n_chars"} & set(keys):
        raise ValueError(f"a key is named {text} or n_chars")

    def work(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [main_text(p) for p in b.column(len(keys)).to_pylist()]
            columns = [*b.columns[: len(keys)], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, text, "n_chars"])

    wanted = pages.select(*keys, text_of(page).alias("page"))
    kinds = ", ".join(f"`{k}` {kind}" for k, kind in wanted.dtypes[: len(keys)])
    return wanted.mapInArrow(work, f"{kinds}, `{text}` string, n_chars long")
