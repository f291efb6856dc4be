"""Main text: hand-made pages with known text, odd markup, learned weights."""

import random

from aerolake.llm import extract

PAGES = "page_id long, url string, html string, text int"


def page(rng, i, body=None):
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta, eps. &amp; caf&eacute;".split())
                               for _ in range(n))
    paragraphs = [words(rng.randrange(1, 60)) for _ in range(rng.randrange(1, 9))]
    title = words(5)
    inner = f"<h1>{title}</h1><p><b>{title}<br>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    html = (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style>'
            f'<script>var t="</p><article>";</script></head><body><nav><ul>'
            + "".join(f'<li><a href="/{k}">menu {k}</a></li>' for k in range(6))
            + f'</ul></nav><!-- note <p>not text --><div class="ad">buy this now {i}</div>'
            f'<article>{inner}</article><footer>&copy; site &middot; all of it</footer>'
            + rng.choice(["</body></html>", ""]))
    plain = [title, title, *paragraphs]
    text = "\n\n".join(" ".join(p.replace("&amp;", "&").replace("&eacute;", "é").split())
                       for p in plain)
    return html, text


def fixture(n=60):
    rng = random.Random(8)
    return [(i, f"u{i}", *page(rng, i)) for i in range(n)]


def test_known_pages(spark):
    rows = fixture()
    odd = [(100, None, None, ""), (101, "u", "", ""), (102, "u", "<script>only()</script>", ""),
           (103, "u", "just words, no tags &lt;here&gt;", "just words, no tags <here>"),
           (104, "u", "<article>" + "long text " * 100_000 + "</article>", ("long text " * 100_000).strip()),
           (0, "u0", rows[0][2], rows[0][3])]
    df = spark.createDataFrame([(a, b, c, 1) for a, b, c, _ in rows + odd], PAGES)
    got = sorted((r.page_id, r.text) for r in extract.extract(df).collect())
    assert got == sorted((a, d) for a, _, _, d in rows + odd)
    weights = extract.learn_weights(df)
    assert weights["word"] > 0 and weights["word:in"] > 0 > weights["word:out"]
    assert all(w < 0 for f, w in weights.items() if not f.startswith("word"))


def test_structures(spark):
    df = spark.createDataFrame([(a, b, c, 1) for a, b, c, _ in fixture()], PAGES)
    weights = extract.learn_weights(df)
    story = "<p>" + "one two three four five six seven. " * 6 + "</p>"
    plain = " ".join(("one two three four five six seven. " * 6).split())
    check = lambda html, text: extract.main_text(html, weights) == text
    assert check(f"<body><p>Welcome</p><article>{story}<div class='ad'>Buy</div>{story}</article>"
                 "<p>Subscribe</p></body>", f"{plain}\n\n{plain}")
    assert check(f"<article>{story}</article><section id='comments'><article><p>nice words here"
                 "</p></article></section>", plain)
    assert check(f"<div id=menu><a href=/x>home</a></div><div>{story}{story}</div>"
                 "<div class='cookie-notice'>We use cookies</div>", f"{plain}\n\n{plain}")
    assert check(f"<nav>unclosed menu <article>{story}<form>name <input> send</form></article>", plain)
    assert check(f"<article>{story}<table><tr><td>a</td><td>b</td></tr></table></article>",
                 plain + "\n\na b")
    assert check(f"<p class=notice>hear this<p>{'word ' * 30}", ("word " * 30).strip())
    assert check(f"<article>{story}<p>a&nbsp;&#x41;&lt;b&gt; \n\t c<br>d<!-- x -->e</p></article>",
                 plain + "\n\na A<b> c de")
    assert check("<article><p title=\"a > b\">text with quotes &quot; kept</p>", 'text with quotes " kept')


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>some plain words</p>", 1)], PAGES)
    assert [r.text for r in extract.extract(df).collect()] == ["some plain words"]
    assert extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_hinted_wrappers_keep_the_main_text():
    story = "<p>" + "one two three four five six seven. " * 6 + "</p>"
    plain = " ".join(("one two three four five six seven. " * 6).split())
    weights = dict(extract.DEFAULTS)
    for wrapper in ("class='no-sidebar'", "class=has-menu", "class='content-with-ads'",
                    "class='post search-result'", "id='page-form'", "class='main sidebar-right'"):
        page = (f"<nav>menu</nav><div {wrapper}>{story}<div class='ad'>Buy this</div>{story}</div>"
                "<div class='cookie-notice'>We use cookies</div>")
        assert extract.main_text(page, weights) == f"{plain}\n\n{plain}", wrapper
    page = f"<article><div class='has-ads widget'>{story}</div></article><div id=footer>all rights</div>"
    assert extract.main_text(page, weights) == plain
    page = f"<div>{story}</div><div id='comments'>{story}<p>I agree</p></div>"
    assert extract.main_text(page, weights) == plain
    assert extract.main_text(f"<div hidden>{story}</div><p>few words</p>", weights) == "few words"


def test_parts_are_left_out_whatever_their_share():
    weights = dict(extract.DEFAULTS)
    story = "<p>" + "one two three four five six seven. " * 6 + "</p>"
    plain = " ".join(("one two three four five six seven. " * 6).split())
    many = "buy this now " * 20
    check = lambda html, text: extract.main_text(html, weights) == text
    for name in ("ad", "ad-slot-300", "cookie-notice", "newsletter", "related-articles", "comments"):
        part = f"<div class='{name}'>{many}</div>"
        assert check(f"<article>Short text here</article>{part}", "Short text here"), name
        assert check(f"<article>Short text here{part}</article>", "Short text here"), name
    comments = "<div class=comments>" + "<p>I agree with this fully</p>" * 40 + "</div>"
    eleven = "one two three four five six seven eight nine ten eleven"
    assert check(f"<article><p>{eleven}</p>{comments}</article>", eleven)
    for part in ("<aside><article>TEASER one two</article></aside>",
                 "<footer><article>TEASER one two</article></footer>",
                 "<div class=related><article>TEASER one</article></div>",
                 "<article class='comment'>I agree</article>"):
        assert check(f"<article>{story}</article>{part}", plain), part
        assert check(f"{part}<article>{story}</article>", plain), part
    assert check(f"<main>{story}<section class=related><article>a b</article></section></main>", plain)
    assert check(f"<form id=all><div>menu</div><article>{story}</article></form>", plain)
    assert check(f"<article>{story}</article><p>between words</p><article>{story}</article>",
                 f"{plain}\n\n{plain}")
    for name in ("alert-level", "share-price", "promotion-history"):
        assert check(f"<article>{story}<p class={name}>level three</p></article>",
                     f"{plain}\n\nlevel three"), name
