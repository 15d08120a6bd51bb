"""Line blocks against a definition that sums every window anew; names, boundaries, and pages made to be slow."""

import random
import time

import pytest
from seriesmill.llm import html_extract as H

WINDOW = H.WINDOW


def stretches(values, strengths):
    """(surge, dive, strength) by the definition: maximal runs of places whose window has text."""
    n = len(values)
    at = lambda xs, i: sum(xs[j] for j in range(i - WINDOW + 1, i + 1) if 0 <= j < n)
    out, run = [], []
    for i in range(n + WINDOW + 1):
        if at(values, i) > 0:
            run.append(i)
        elif run:
            out.append((run[0], max(j for j in run if j < n and values[j]) + 1, max(at(strengths, j) for j in run)))
            run = []
    return out


def plain_kept(lines):
    n, at = len(lines), []
    over = lambda x: bool(x and x.main and (x.block or x.text == ""))
    for i in range(n):
        if not (i and over(lines[i]) and over(lines[i - 1])):
            at.append(i)
    size = lambda which: [len(lines[i].text) if lines[i] and which(lines[i]) else 0 for i in at]
    free = lambda which: [len(lines[i].text) - lines[i].linked if lines[i] and which(lines[i]) else 0 for i in at]
    within, without = (lambda x: x.main and not x.block), (lambda x: not x.main and not x.block)
    top = lambda which: max((s for *_, s in stretches(size(which), free(which))), default=0)
    inside = top(within) > 0 and top(within) >= top(without)
    which = within if inside else lambda x: not x.block
    sizes, frees = size(which), free(which)
    found = [(at[lo], at[hi - 1] + 1, s, 0) for lo, hi, s in stretches(sizes, frees) if inside or 2 * (sum(sizes[lo:hi]) - sum(frees[lo:hi])) < sum(sizes[lo:hi])]
    for block in {x.block for x in lines if x and x.block}:
        own = [i for i in range(n) if lines[i] and lines[i].block == block]
        s = max(s for *_, s in stretches([len(lines[i].text) for i in own], [len(lines[i].text) - lines[i].linked for i in own]))
        if s >= H.NAMED_LEAST:
            found.append((own[0], own[-1] + 1, H.LOWERED * s, block))
    most = max((s for _, _, s, _ in found), default=0)
    strong = [r for r in found if r[2] > 0 and r[2] >= H.SHARE * most]
    if not strong:
        return []
    lo, hi = min(r[0] for r in strong), max(r[1] for r in strong)
    while lo and lines[lo - 1] and lines[lo - 1].heading and which(lines[lo - 1]):
        lo -= 1
    return [i for i in range(lo, hi) if lines[i] and lines[i].text and (which(lines[i]) or lines[i].block in {r[3] for r in strong} - {0})]


@pytest.mark.parametrize("seed", range(300))
def test_kept_lines_are_the_definition(seed):
    rng = random.Random(seed)
    lines, main, block, blocks = [], False, 0, 0
    for _ in range(rng.randint(0, 30)):
        act = rng.random()
        if act < 0.15:
            lines += [H.Line("", main=True)] * rng.randint(1, 2) if main else [None] * rng.randint(1, 4)
        if act < 0.25:
            main = not main
        if act > 0.85:
            block, blocks = (0, blocks) if block else (blocks + 1, blocks + 1)
        n = rng.choice([1, 5, 20, 80, 400, 3_000])
        lines.append(H.Line("x" * n, rng.choice([0, 0, n // 2, n]), main, rng.random() < 0.2, block))
    assert H.kept(lines) == plain_kept(lines)
    lengths = [len(x.text) if x else 0 for x in lines]
    assert H.regions(lengths) == stretches(lengths, lengths)


PARAGRAPH = "Words of the body text that go on for a while. " * 8
PAGES = {
    # Names inside main text delete nothing that carries it.
    "<article><div class='legal-history'><p>Law text stays.</div></article>": "Law text stays.",
    "<section class='social-science'><p>Science text.</p></section>": "Science text.",
    "<article><p>First.</p><div class='side-by-side'><p>Second.</p></div></article>": "First.\nSecond.",
    f"<article><section class=social><p>{PARAGRAPH * 9}</p></section><p>Short end.</p></article>": f"{(PARAGRAPH * 9).strip()}\nShort end.",
    f"<div class=widget><p>{PARAGRAPH * 9}</p></div>": (PARAGRAPH * 9).strip(),
    # A small named block is outweighed, wherever it stands.
    f"<article><p>{PARAGRAPH}</p><div class=ad>Buy now, buy here, buy more of it.</div><p>End.</p></article>": f"{PARAGRAPH.strip()}\nEnd.",
    f"<div><p>{PARAGRAPH}</p></div><div class=comments><p>{PARAGRAPH * 4}</p></div>": PARAGRAPH.strip(),
    # Names for places of links say nothing of blocks that hold text; links decide there.
    f"<article><p>{PARAGRAPH}</p><section id=social><p>{PARAGRAPH}</p></section></article>": f"{PARAGRAPH.strip()}\n{PARAGRAPH.strip()}",
    "<article><p>First part.</p><div class=related><p>Second part.</p></div><p>End.</p></article>": "First part.\nSecond part.\nEnd.",
    f"<article><p>{PARAGRAPH}</p><div class=related><a href=/1>One more</a> <a href=/2>Another</a></div><p>End.</p></article>": f"{PARAGRAPH.strip()}\nEnd.",
    # Reader comments go, however they are named and however long they are beside the article.
    f"<article><p>{PARAGRAPH}</p></article><ol class=commentlist><li>{PARAGRAPH}</li></ol>": PARAGRAPH.strip(),
    f"<div><p>{PARAGRAPH}</p></div><div class=user-comments><p>{PARAGRAPH}</p></div>": PARAGRAPH.strip(),
    f"<article><p>A short article of some eighty characters, which says all that it has to say.</p></article><section class=comments><p>{PARAGRAPH * 9}</p></section>": "A short article of some eighty characters, which says all that it has to say.",
    f"<div><p>{PARAGRAPH}</p></div><div class=cookie-policy-banner><p>We use cookies.</p></div>": PARAGRAPH.strip(),
    "<article><p>See <label>this</label> now.</p></article>": "See now.",
    # Windows reach over what is skipped inside main text, and dive at its edge.
    f"<article><p>{PARAGRAPH}</p><aside><p>a</p><p>b</p><p>c</p><p>d</p></aside><nav>n</nav><p>End.</p></article><p>Teaser</p>": f"{PARAGRAPH.strip()}\nEnd.",
    # No article, no main: the strongest windows say where the text is.
    f"<div><p>Skip</p></div><nav>m</nav><div><h1>Head</h1><p>{PARAGRAPH}</p></div><footer>f</footer><p>Legal line</p>": f"Head\n{PARAGRAPH.strip()}",
    f"<ul><li><a href=/1>{PARAGRAPH}</a></li></ul><hr><nav></nav><p>{PARAGRAPH}</p>": PARAGRAPH.strip(),
    # What isn't shown goes without ending its block.
    "<p>See <span class='hidden'>x</span>this <i hidden>y</i>text.</p>": "See this text.",
    "<p>An <a name=top>anchor</a> isn't a link.</p>": "An anchor isn't a link.",
    "<head><title>T</title><body><p>No end of head.": "No end of head.",
    "<ul><li class=ad>no<li>Item one.<li>Item two.</ul>": "Item one.\nItem two.",
    "<p>1 < 2 and <3</p>": "1 < 2 and <3",
}


@pytest.mark.parametrize("page", PAGES)
def test_pages(page):
    assert H.main_text(page) == PAGES[page]


@pytest.mark.parametrize("part", ["<script ", '<p class="', "<a<a", "<!--", "<", "</", "<svg>", "<![CDATA[", "<a b='", "&"])
def test_malformed_pages_take_time_in_proportion(part):
    page = part * (2_000_000 // len(part))
    began = time.perf_counter()
    H.main_text(page)
    assert time.perf_counter() - began < 3
