"""Chat formatting and HTML extraction on small cases."""

import hashlib

import public_tokenizers
import pytest
from seriesmill.llm import chat_format, html_extract

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|a<\\\\|b<||", "<<|", "\\<|", "plain"])
def test_escape_is_reversible(text):
    assert "<|" not in chat_format.escape(text) and chat_format.unescape(chat_format.escape(text)) == text


ROWS = [
    (1, 0, "system", "\n\n lead"), (1, 2, "assistant", "  é🎉 漢字\n\n"), (1, 1, "user", "hi"), (1, 3, "assistant", ""), (1, 4, "assistant", "<|im_start|>x <|endoftext|>"),
    (2, 0, "user", None), (2, 1, None, "no role"), (None, None, "assistant", "lost"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "assistant", "wörd " * 60_000),
]


@pytest.mark.parametrize("part_chars", [1_000_000, 5])
def test_round_trip(spark, part_chars):
    rows = spark.createDataFrame([(*r, "x", 0) for r in ROWS], "conv_id long, turn long, role string, text string, part string, ids int")
    got = {r.conv_id: r for r in chat_format.round_trip_digests(rows, FILE, part_chars).collect()}
    groups = {}
    for r in sorted(ROWS, key=lambda r: (str(r[0]), r[1] or 0)):
        groups.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        said = "".join(t for role, t in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv].loss_chars == len(said) and got[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].formatted_chars == len(chat_format.render(turns)[0])


def test_parts_and_empty(spark):
    rows = spark.createDataFrame(ROWS[:5], "conv_id long, turn long, role string, text string")
    whole = chat_format.format_conversations(rows, FILE).collect()
    cut = sorted(chat_format.format_conversations(rows, FILE, 1).collect(), key=lambda r: r.part)
    assert len(whole) == 1 and len(cut) == 5 and [r.last for r in cut] == [False] * 4 + [True]
    assert whole[0].ids == [i for r in cut for i in r.ids] and whole[0].loss == [i for r in cut for i in r.loss]
    assert chat_format.round_trip_digests(rows.limit(0), FILE).count() == 0


PAGES = {
    "": "",
    "plain a < b &lt;b&gt;": "plain a < b <b>",
    "<p>one <b>two</b>\n three<br>four<p>five": "one two three four\nfive",
    "<body><header><h1>Site</h1></header><nav><a href=/>home</a></nav><article><header><h1>Title</h1></header><p>Text &amp;amp; more.</p><aside>no</aside><p>End.</article><footer>f</footer>": "Title\nText &amp; more.\nEnd.",
    "<nav><ul><li>unclosed<article><p>kept</p></article>": "kept",
    "<script>var t='</p><p>no'</script><style>p{}</style><!-- <p>no</p> --><div id=content><p>Yes, this text is the text.</p></div><div class='cookie-notice'>no</div>": "Yes, this text is the text.",
    "<article><p>Body text.</p><div class=comments><p>first!</p></div></article><article class=comment><p>second!</p></article>": "Body text.",
    "<article><form><label>Mail</label><input></form><p class=ad>Buy<p>Sold words</article>": "Sold words",
    "<p>a b&nbsp;c</p>": "a b c",
    "<div class='page has-sidebar'><div class='entry-header'><h1>Head</h1></div><div class=entry><p>Words of the text.</p></div></div><div id=left-sidebar><p>no</p></div>": "Head\nWords of the text.",
    "<article class='post comments-open'><p>Open text.</p></article><article class='comment comment-7'><p>no</p></article>": "Open text.",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_extract.main_text(page) == PAGES[page]


NAMES = {
    "<p>See <a href='/hidden-gems'>gems</a> and <a title='The hidden cost' href=x>costs</a> in this sentence</p>": "See gems and costs in this sentence",
    "<div class='overflow-hidden'><p>Wrapped text.</p></div>": "Wrapped text.",
    "<section id='hidden-markov-models'><p>Models.</p></section><p>More.</p>": "Models.\nMore.",
    "<h2 id='related-work'>Related work</h2><p>Text of it.</p><section id='search-algorithms'><p>Trees.</p></section>": "Related work\nText of it.\nTrees.",
    "<h2 id=search>Search</h2><p>Text <a id=legal>of law</a>.</p>": "Search\nText of law.",
    "<div class='elementor-widget'><p>Built.</p></div><div class='main-with-sidebar'><p>Main.</p></div>": "Built.\nMain.",
    "<div aria-label='Results of the search'><p>Found.</p></div>": "Found.",
    "<div data-x='display:none'><p>Seen.</p></div><div style='color:red; display: none'>no</div><p hidden=''>no</p><p aria-hidden=true>no<p hidden>no": "Seen.",
    "<p>Text.</p><div class='ad-slot'>no</div><div id=left_sidebar>no</div><div class=related-posts>no</div><div role=navigation>no</div>": "Text.",
}


@pytest.mark.parametrize("page", NAMES)
def test_names_are_judged_whole(page):
    assert html_extract.main_text(page) == NAMES[page]


BODY = "<p>" + "Long body text of the page. " * 9 + "</p>"
TEXT = ("Long body text of the page. " * 9).strip()
CARDS = "<article><h3>Teaser</h3><p>Read on.</p></article>" * 2
NESTED = {
    f"<div class=body>{BODY}</div><aside>{CARDS}</aside>": TEXT,
    f"<div class=body>{BODY}</div><div class=related>{CARDS}</div>": TEXT,
    f"<div class=body>{BODY}</div><section class=comments><article><p>first!</p></article><p>no</p></section>": TEXT,
    f"<div class=body>{BODY}</div><hr><p>Next</p>{CARDS}": f"{TEXT}\nNext",
    f"<article>{BODY}<aside>{CARDS}no</aside><p>End.</p></article><section class=comments><article>no</article></section>": f"{TEXT}\nEnd.",
    f"<aside>unclosed<article>{BODY}</article>": TEXT,
    f"<aside>unclosed<main>{BODY}</main><aside>no</aside>": TEXT,
    f"<form><article>{BODY}</article></form>": TEXT,
    f"<form><main>{BODY}</main></form>": TEXT,
}


@pytest.mark.parametrize("page", NESTED)
def test_articles_beside_main_text(page):
    assert html_extract.main_text(page) == NESTED[page]


def test_regions():
    assert html_extract.regions([]) == []
    assert html_extract.regions([5, 0, 7, 0, 0, 0, 9]) == [(0, 3, 12), (6, 7, 9)]


def test_weak_regions_are_dropped_outside_articles():
    page = "<div>Skip</div><nav>m</nav><p>" + "long text " * 40 + "</p><footer>f</footer><div>Legal</div>"
    assert html_extract.main_text(page) == ("long text " * 40).strip()


def test_long_page():
    page = "<article>" + "<p>word &eacute; <i>x</i></p>" * 50_000 + "</article>"
    assert html_extract.main_text(page) == "\n".join(["word é x"] * 50_000)


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in html_extract.extract(pages).collect()) == [("1", "x", 1), ("1", "x", 1), ("None", "", 0)]
    assert html_extract.extract(pages.limit(0)).count() == 0
