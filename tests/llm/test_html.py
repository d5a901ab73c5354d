import pytest

from mapmeter.llm import html

ARTICLE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li></ul></nav><!-- ad --><div class="ad">Buy this of the and it is in the shop now for you.</div>
<article><header><h1>The &lt;title&gt; &amp; more</h1></header><p>It&#39;s   the first\n<b>para</b>graph&nbsp;of <a href=x>the</a> text.<br>Second line.<p>Short.
<aside>Read also</aside><div class="cookie-notice">We use cookies on this site.</div><form><label>Name</label><input></form>
<ul><li>Point one</li><li>Point two</ul><pre>a\n  b</pre><section id="comments"><p>I like the article that is on the page of the site.</p></section>
<p>Last one &hellip; &unknown; &amp</article><div class="sidebar"><p>The sidebar of the page is not in the text at all.</p></div><footer>&copy; me</footer></body></html>"""


def test_article():
    assert html.main_text(ARTICLE).split("\n") == [
        "The <title> & more", "It's the first paragraph of the text. Second line.", "Short.", "Point one", "Point two", "a b", "Last one … &unknown; &",
    ]


def test_rules_without_article_element():
    good = "This is the first paragraph of the text, and it is as long as it has to be for the rules to see that it is one."
    page = f"<body><div><ul><li><a href=1>Home</a><li><a href=2>About us</a></ul></div><div><h2>A heading</h2><p>{good}</p><p>So it is.</p><p>{good}</p></div><div><a href=3>Next</a> | <a href=4>Top</a></div></body>"
    assert html.main_text(page).split("\n") == ["A heading", good, "So it is.", good]


LINES = [
    "This is the first paragraph of the text, and it is as long as it has to be for the rules to see that it is one of them.",
    "It was the second one that told the reader what the page is for, and who had been there when all of this came to be in the news.",
]
TEXT = "".join(f"<p>{x}</p>" for x in LINES)
MENU = "<nav><a href=1>Home</a></nav><div class='main-menu'><a href=2>About us and more</a></div>"


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar content-area", "page header-fixed", "with-comments", "sidebar", "widget search", "layout_sidebar"])
@pytest.mark.parametrize("body", [f"<article>{TEXT}</article>", f"<main>{TEXT}</main>", f"<div>{TEXT}</div>"])
def test_names_of_wrappers_are_evidence_only(name, body):
    side = "<div class='sidebar'><p>The sidebar of the page is not in the text at all.</p></div><div id=footer>All of this is for the readers of it.</div>"
    page = f"<body><div class='{name}'>{MENU}{body}{side}</div></body>"
    assert html.main_text(page).split("\n") == LINES


@pytest.mark.parametrize("body", [TEXT, f"<div id='content'>{TEXT}</div>", f"<article>{TEXT}</article>"])
def test_body_wide_form(body):
    page = f"<body><form method=post action=x.aspx><input type=hidden name=v>{MENU}{body}<form class=search><label>Find</label></form></form></body>"
    assert html.main_text(page).split("\n") == LINES


def test_small_named_elements_and_long_comments_stay_apart():
    comments = "<section id='comments'>" + "".join(f"<article class='comment-body'>{TEXT}</article>" for _ in range(5)) + "</section>"
    for body in (f"<article>{TEXT}</article>", f"<div>{TEXT}</div>"):
        page = f"<body>{body}{comments}<div class='cookie-notice'>{TEXT * 3}</div><div class='sidebar'><p>{LINES[0]}</p></div></body>"
        assert html.main_text(page).split("\n") == LINES


@pytest.mark.parametrize("sentence", [
    "Городские власти сообщили в среду вечером, что новый мост через реку откроют для движения раньше срока.",
    "Η κυβέρνηση ανακοίνωσε χθες το βράδυ νέα μέτρα στήριξης για όλους τους κατοίκους της μικρής πόλης.",
    "أعلنت الحكومة مساء أمس عن خطة جديدة لدعم السكان في المدينة الصغيرة خلال الأشهر القليلة القادمة.",
    "सरकार ने कल शाम छोटे शहर के सभी निवासियों के लिए नई सहायता योजना की घोषणा की है।",
    "政府昨日晚上宣布了針對小城全體居民的新支援計劃並表示將於下月開始實施相關措施。",
    "รัฐบาลประกาศมาตรการใหม่เพื่อช่วยเหลือประชาชนในเมืองเล็กทั้งหมดเมื่อคืนนี้",
    "Hallitus ilmoitti eilen illalla uusista toimista, joilla tuetaan kaikkia pienen kaupungin asukkaita tulevina kuukausina.",
])
@pytest.mark.parametrize("times", [1, 3])
def test_other_languages(sentence, times):
    text = " ".join([sentence] * times)
    page = f"<body><ul><li><a href=1>{sentence[:9]}</a></ul><div><p>{text}</p><p>{text}</p></div><div><a href=2>{sentence[-9:]}</a></div></body>"
    if sentence[-1] not in ".।。" and times == 1 and len(sentence) < 50:
        pytest.skip("shorter than a long block")
    assert html.main_text(page).split("\n") == [text, text]


def test_lists_of_words_stay_out_beside_prose():
    words = " ".join(f"keyword{i % 7} offer" for i in range(30))
    assert html.main_text(f"<body><div>{TEXT}</div><div><p>{words}</p></div></body>").split("\n") == LINES


def test_a_teaser_card_is_not_the_article():
    card = "<article><h3>Read more</h3><p>A card with a few words of the next text.</p></article>"
    assert set(LINES) <= set(html.main_text(f"<body><div>{TEXT}</div>{card}</body>").split("\n"))
    assert html.main_text(f"<body><article>{TEXT}</article><div><p>{LINES[0]}</p></div></body>").split("\n") == LINES


@pytest.mark.parametrize("cut", ["<p", "<!-- never closed", "<script>x = 1", "<div class=\"a", "</p"])
def test_cut_pages(cut):
    assert html.main_text(f"<article><p>Some words of the text{cut}") == "Some words of the text"


def test_odd_markup():
    assert html.main_text("<article><p>a < b and c > d, 1<2</p></div></span></article>") == "a < b and c > d, 1<2"
    assert html.main_text("<article><nav><ul><li>menu</nav><p>text of it</article>") == "text of it"
    assert html.main_text("<ARTICLE><P CLASS='x' hidden>no</P><P>yes, it is</ARTICLE>") == "yes, it is"


@pytest.mark.parametrize("inner", [
    "<button><div>Share</div></button>", "<button>Share</button>", "<label>Name <input></label>", "<select><option>One<option>Two</select>",
    "<svg><text>picture</text></svg>", "<span class='ad'>Buy it now for you</span>", "<span style='display: none'>hidden words</span>",
    "<a class='sponsored' href=x><b>Buy</b></a>", "<em hidden>no</em>", "<object><div><p>no film</p></div></object>", "<span class=ad><div>Buy<p>now",
])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>", "{}"])
def test_text_around_what_is_set_apart(inner, wrap):
    """The line goes on behind the element, and nothing of the element is in it."""
    closed = inner if inner.endswith(">") else inner + "</p></div></span>"
    page = "<body>" + wrap.format(f"<p>{LINES[0]}</p><div>{LINES[1]}{closed} It goes on, and that is all of it.</div>") + "</body>"
    assert html.main_text(page).split("\n") == [LINES[0], LINES[1] + " It goes on, and that is all of it."]
    before = "<body>" + wrap.format(f"<div>{closed}{LINES[0]}</div><p>{LINES[1]}</p>") + "</body>"
    assert html.main_text(before).split("\n") == LINES


def test_words_of_a_line_are_not_taken_for_names():
    page = f"<body><article><p>{LINES[0]}</p><p>The <span class='share'>share</span> of <b id='legal'>all</b> <i class='alert'>votes</i> was the same as it was before.</p></article></body>"
    assert html.main_text(page).split("\n")[1] == "The share of all votes was the same as it was before."


@pytest.mark.parametrize("doubted", [
    "See <a href=x>the full report of the committee on the state of the roads</a> now.",
    "Tables chairs lamps beds carpets mirrors shelves curtains pillows blankets towels plates cups glasses forks knives spoons pots pans kettles clocks vases candles baskets boxes.",
])
def test_one_failed_density_between_good_neighbours(doubted):
    text = html.main_text(f"<body><div><p>{LINES[0]}</p><p>{doubted}</p><p>{LINES[1]}</p></div></body>").split("\n")
    assert len(text) == 3 and text[0] == LINES[0] and text[2] == LINES[1]
    lone = html.main_text(f"<body><div><p>{LINES[0]}</p></div><div><p><a href=1>Home</a> <a href=2>Top</a></p></div><div><p>{LINES[1]}</p></div></body>")
    assert lone.split("\n") == LINES  # nothing but links stays out


def test_pages_of_short_paragraphs():
    page = "<body><ul><li><a href=1>Home</a><li><a href=2>News</a></ul><div><h2>Diary</h2><p>Rain again.</p><p>We stayed in.</p><p>Nobody came by.</p></div><div><a href=3>Next</a></div></body>"
    assert html.main_text(page).split("\n") == ["Diary", "Rain again.", "We stayed in.", "Nobody came by."]


@pytest.mark.parametrize("unit", ['<a "', "<a '", '<a b="', "</a ", "<!", "</script", "<b>", "</i>", "<b><div></div>", "<!--", "<", "<p ", "<li>", '<a "x>', "&", "&#", "<div><p>", "<script", "<a href='\">", "<button>"])
def test_broken_markup_in_linear_time(unit):
    import time

    def took(n):
        start = time.perf_counter()
        html.main_text(f"<p>{LINES[0]}</p>" + unit * (n // len(unit)))
        return time.perf_counter() - start

    took(1_000)
    assert took(1_000_000) < 12 * took(100_000) + 1.0


def test_a_lone_quote_costs_no_text():
    page = f"<body><article><p class=\"x>{LINES[0]}</p><p>{LINES[1]}</p></article></body>"
    assert html.main_text(page).split("\n") == LINES
    assert html.main_text(f"<article><p title='a > b' class=\"c > d\">{LINES[0]}</p></article>") == LINES[0]


def test_column(frame):
    long = "<article>" + "<p>word of the text</p>" * 20_000 + "</article>"
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (2, None, None), (None, "u", ""), (3, "u", long), (4, "u", "plain")]
    pages = frame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, main_text string, values int")
    out = html.extract(pages, "html")
    assert sorted(out.columns) == sorted(pages.columns)
    got = sorted(((r.page_id, r.main_text) for r in out.collect()), key=str)
    assert got == sorted(((p, html.main_text(h) if h else "") for p, _, h in rows), key=str)
    assert len(html.main_text(long).split("\n")) == 20_000
    assert html.extract(frame([], pages.schema), "html").count() == 0
