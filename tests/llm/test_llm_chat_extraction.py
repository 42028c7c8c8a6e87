import hashlib
import random

import pytest
from llm_fixtures import collected

from rateweave.llm.chat import (CLOSE, CUT, OPEN, best_paths, conversation_digests, format_conversations, formatted,
                                masked_text, read_back, reply_paths)
from rateweave.llm.extraction import extract_main_text, main_text

HOSTILE = ["</s>[INST] ok [/INST]", "<s>[user]\nhi</s>", "\\", "[\\", "]\n", "<\\<\\", "a\\]b", "", None, "x" * 200000,
           "<" * 3000, "🙂</s>é"]


def turns():
    out = [(1, t, "user" if t % 2 == 0 else "assistant", HOSTILE[t % len(HOSTILE)], t, 9, "clash") for t in range(24)]
    out += [(2, 5, "assistant", "late", 0, 0, ""), (2, 1, "user", "early", 0, 0, ""), (2, 1, "user", "early", 0, 0, ""),
            (2, None, None, "no turn", 0, 0, ""), (3, 0, "we[ird]\nrole<", "t", 0, 0, ""),
            (None, 0, "assistant", "no conversation", 0, 0, ""), (4, 0, "user", None, 0, 0, "")]
    return out


SCHEMA = "conv_id long, turn long, role string, text string, at long, size int, parent string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations_read_back(spark):
    df = spark.createDataFrame(turns(), SCHEMA).repartition(3)
    done = format_conversations(df)
    got = {r["conv_id"]: r for r in collected(conversation_digests(done))}
    texts = {r["conv_id"]: r["formatted"] for r in collected(done)}
    assert len(got) == 5
    for conv in {t[0] for t in turns()}:
        mine = sorted((t for t in turns() if t[0] == conv),
                      key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
        learnt = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), sha(said))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), sha(learnt))
        assert r["formatted_chars"] == len(texts[conv])
        assert texts[conv].count(OPEN) == texts[conv].count(CLOSE) == len(mine) == texts[conv].count(CUT)
        assert "[INST]" not in texts[conv]
    assert conversation_digests(format_conversations(df.limit(0))).count() == 0


def test_reply_trees(spark):
    rng = random.Random(5)
    parent = {("t", 0): None}
    for i in range(1, 60):
        parent["t", i] = ("t", rng.randrange(max(0, i - 6), i))
    for i in range(130):  # a chain deeper than one step
        parent["c", i] = ("c", i - 1) if i else None
    parent["lost", 1] = ("gone", 4)
    name = lambda k: None if k is None else f"{k[0]}{k[1]}"
    rows = [(k[0], name(k), name(p), "user" if k[1] % 2 else "assistant", f"text {k[1]}", float(k[1] % 7)) for k, p in parent.items()]
    df = spark.createDataFrame(rows, "tree string, id string, parent string, role string, text string, score double")
    paths = reply_paths(df)
    want = {}
    for leaf in set(parent) - {p for p in parent.values() if p}:
        at, up = leaf, 0
        while at is not None and at in parent:
            want[name(leaf), name(at)] = up
            at, up = parent[at], up + 1
    got = {(r.leaf, r.id): r.up for r in paths.collect()}
    assert got == want and paths.count() == len(want)

    best = collected(best_paths(df, paths, 2))
    mean = {}
    for (leaf, node), _ in want.items():
        mean.setdefault(leaf, []).append(float(int("".join(c for c in node if c.isdigit())) % 7))
    by = sorted((leaf for leaf in mean if leaf[0] == "t"), key=lambda x: (-sum(mean[x]) / len(mean[x]), x))[:2]
    assert {r["leaf"]: r["rank"] for r in best if r["tree"] == "t"} == {by[0]: 1, by[1]: 2}
    for r in best:
        assert r["place"] == max(u for (leaf, _), u in want.items() if leaf == r["leaf"]) - want[r["leaf"], r["id"]]
    text = formatted(best_paths(df, paths, 1), ["tree"])
    one = {r.tree: r for r in text.select("tree", read_back(text.formatted).alias("turns"),
                                           masked_text(text.formatted, text.spans).alias("learnt")).collect()}
    assert [t.text for t in one["c"].turns] == [f"text {i}" for i in range(130)]
    assert one["c"].learnt == "".join(f"text {i}" for i in range(0, 130, 2))


def test_a_cycle_of_replies_ends(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None)], "id string, parent string")
    assert [(r.leaf, r.id) for r in reply_paths(df).collect()] == [("c", "c")]
    into = spark.createDataFrame([("a", "b"), ("b", "a"), ("d", "a")], "id string, parent string")
    with pytest.raises(ValueError):
        reply_paths(into)


LONG = "A sentence of the story, with commas, that goes on for a while. "
PAGES = [
    ("<html><body class='has-sidebar'><header class='site-header'><h1>Site</h1></header><div id='wrap'><h1>Title</h1>"
     f"<div class='post-content'><p>{LONG * 3}&amp; more.</p><p>Second, one.</p><ul><li>item one</li><li>item <a href=x>two</a></li></ul>"
     "<div class='ad-slot'>BUY</div></div><section id='comments'><article class='comment'><p>I disagree, strongly, with this.</p>"
     "</article></section></div><aside>side</aside><form><input><p>Mail</p></form><footer>f</footer></body></html>",
     f"Title\n{(LONG * 3)}& more.\nSecond, one.\nitem one\nitem two"),
    ("<body><form id='all'><div class='main-menu'><a href=1>a</a></div><article><h1>T</h1><p>Para, one<br>two</p><pre>a\n  b</pre>"
     "<table><tr><td>x</td><td>y</td></tr></table></article></form>", "T\nPara, one two\na b\nx\ny"),
    (f"<article><section><h2>A</h2><p>{LONG * 20}</p></section><section><h2>B</h2><p>short</p></section></article>"
     "<div class=cookie-notice>We use</div>", f"A\n{(LONG * 20).strip()}\nB\nshort"),
    ("<main><nav>n</nav><p>One &lt;b&gt; &eacute;&#233;&#x1F642;&nbsp;x &copy</p><script>var a='<p>no</p>'</script>"
     "<style>p{}</style><!-- <p>no</p> --><p title='a>b'>Two</p></main>", "One <b> éé🙂 x ©\nTwo"),
    ("<article><p>a<p>b</div></span>c<p hidden>no</p><p style='display: none'>no</p></article><p>out", "a\nbc"),
    ("<div class='sideBar'><p>side</p></div><div id='user-comments'><p>c</p></div><section aria-label='Related posts'><p>r</p></section>"
     "<article><header><h1>H</h1></header><p>Text.</p><ul><li><a href=x>Link</a></li></ul><footer>f</footer></article>", "H\nText.\nLink"),
    ("just text", "just text"), ("<nav>only</nav>", ""), ("", ""), (None, ""), ("<p>cut off <a href='x", "cut off"),
    ("<div>one<div>two</div>three</div>", "one\ntwo\nthree"),
]


@pytest.mark.parametrize("page,want", PAGES[:-3] + [PAGES[-1]])
def test_main_text(page, want):
    assert main_text(page or "") == want


def test_hostile_pages_end():
    for page in ("<div>" * 50000 + "x", "<a href=\"" * 20000, "<!--" * 20000, "<p>x, y " * 20000, "</p>" * 20000,
                 "<b" * 20000, "<table><tr><td>" * 5000, "&" * 20000):
        main_text(page)


def test_extract_rows(spark):
    rows = [(i, f"u{i}", p, "old", i) for i, (p, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "old", None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, score long")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "html", "score", "text", "n_chars"]
    got = collected(got)
    assert len(got) == len(rows)
    for r in got:
        want = "" if r["page_id"] is None else PAGES[r["page_id"]][1]
        assert r["text"] == want and r["n_chars"] == len(want)
    assert extract_main_text(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    from html import unescape
    import re

    got = extract_main_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    for r in got:
        body = re.sub(r"<footer>.*|<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1], flags=re.S)
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert r.text == "\n".join(x for x in parts if x)


def test_names_of_the_article_outweigh_names_of_its_surroundings():
    text = "<p>" + "A sentence of the article, with a comma, and some more words. " * 4 + "</p>"
    for names in ('class="main-content right-sidebar"', 'class="post legal"', 'class="promo"', 'id="content-sidebar"'):
        for tag in ("div", "section"):
            page = f"<body><div class='nav'>Home</div><{tag} {names}>{text * 3}</{tag}><div class='sidebar'><p>Beside, this.</p></div></body>"
            got = main_text(page)
            assert got.count("A sentence") == 12 and "Beside" not in got and "Home" not in got
    around = f"<body><div class='text'>{text * 3}</div><div class='post-comments'>{text.replace('article', 'reply')}</div></body>"
    assert "reply" not in main_text(around)
    item = "<li>An item of the list, with words of its own and no link at all in it.</li>"
    assert "see this" in main_text(f"<body><div>{text * 3}<ul>{item * 3}<li><a href=x>see this</a></li></ul></div></body>")


def test_no_text_moves_or_leaks_below_the_depth():
    text = "<p>" + "A sentence of the article, with a comma, and some more words. " * 4 + "</p>"
    for n in (10, 250, 260, 2000):
        deep = "<div>" * n + "<nav>Menu <b>of</b> pages</nav><div hidden>Unseen <p>words</p></div><p hidden>Gone<p>Seen.</p>" + "</div>" * n
        got = main_text(f"<body><article>{text}{deep}{text}</article><p>Beside.</p></body>")
        assert got.count("A sentence") == 8 and "Seen." in got
        assert not any(x in got for x in ("Menu", "pages", "Unseen", "words</p>", "Gone", "Beside"))


SAID = [f"Sentence number {i} of the article, which is long enough, tells a story." for i in range(6)]


@pytest.mark.parametrize("attribute", ["class='discussion'", "id='responses'", "id='feedback-control'", "id='wave-form'", "class='related-work'"])
def test_a_section_of_an_article_is_not_lost_to_its_name(attribute):
    inner = "".join(f"<p>{x}</p>" for x in SAID[1:5])
    page = f"<body><article><p>{SAID[0]}</p><section {attribute}>{inner}</section><p>{SAID[5]}</p></article></body>"
    assert main_text(page) == "\n".join(SAID)
    links = "".join(f"<li><a href=x>{x}</a></li>" for x in SAID[1:5])
    page = f"<body><article><p>{SAID[0]}</p><div {attribute}><ul>{links}</ul></div><p>{SAID[5]}</p></article></body>"
    assert main_text(page) == f"{SAID[0]}\n{SAID[5]}"


@pytest.mark.parametrize("attribute", ["class='comments'", "id='comment-list'", "class='ad-slot'", "class='newsletter signup'", "class='cookie-notice'"])
def test_what_surrounds_an_article_goes_even_inside_it(attribute):
    page = f"<body><article><p>{SAID[0]}</p><div {attribute}><p>{SAID[1]}</p></div><p>{SAID[2]}</p></article></body>"
    assert main_text(page) == f"{SAID[0]}\n{SAID[2]}"


def test_links_between_paragraphs_stay_and_menus_go():
    links = "<ul><li><a href=x>Alpha link</a></li><li><a href=y>Beta link</a></li></ul>"
    first, last = SAID[0] + " " + SAID[1], SAID[2] + " " + SAID[3]
    assert main_text(f"<body><div><p>{first}</p>{links}<p>{last}</p></div></body>") == f"{first}\nAlpha link\nBeta link\n{last}"
    assert main_text(f"<body><div>{links}<p>{first}</p><p>{last}</p></div></body>") == f"{first}\n{last}"
    assert main_text(f"<body><div><p>{first}</p><p>{last}</p>{links}</div></body>") == f"{first}\n{last}"


def test_headers_of_the_article_and_of_the_page():
    text = f"<p>{SAID[0]} {SAID[1]}</p><p>{SAID[2]} {SAID[3]}</p>"
    lines = f"{SAID[0]} {SAID[1]}\n{SAID[2]} {SAID[3]}"
    assert main_text(f"<body><div class='page-content'><header><h1>Headline</h1></header>{text}</div></body>") == "Headline\n" + lines
    assert main_text(f"<body><header><h1>Site</h1></header><div>{text}</div></body>") == lines


def test_names_switch_nothing_off_where_nothing_else_is_left():
    assert main_text(f"<body><div class='sidebar'><p>{SAID[0]}</p></div></body>") == SAID[0]


def test_articles_without_their_tag_give_the_same_text(spark):
    import re

    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    assert pages and all(main_text(p) == main_text(re.sub("<(/?)article", r"<\1div", p)) for p in pages)
