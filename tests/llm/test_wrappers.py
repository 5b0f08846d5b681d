import pytest

from cohortlens.llm import wrappers

PAGES = "page_id bigint, url string, html string"


def text_of(*pages):
    """The text of the last page, with the wrapper of all."""
    streams = ["\t".join(wrappers.folded(wrappers.parse(p)[0])) for p in pages]
    slots = set(wrappers.wrapper_slots(wrappers.wrapper_of(list(dict.fromkeys(streams)))))
    return wrappers.main_text(pages[-1], slots, set())


def test_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><aside>side</aside><div class="ad">buy</div>
    <article><h1>Title &amp; more</h1><p><b>One&nbsp; two.<br><p>Three &#233; <i>four</i>
    five</p><div class="share-buttons">share</div><form><input>send</form><p>Last</p><section class="comments"><p>first!</p></section>
    <!-- <p>no</p> --></article><div id="sidebar">side</div><footer>&copy; foot</footer></body></html>"""
    assert text_of(page) == "Title & more\nOne two.\nThree é four five\nLast"


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div>x<script>var a='<p>y</p>'", "x"),
    ("<div>a<!-- never closed <p>b", "a"), ("<p>1 < 2 & 3 &lt; 4</p>", "1 < 2 & 3 < 4"), ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<main><p>m</p></main><p>body</p>", "m"), ("<div class='post-content'>c</div><div>d</div>", "c"),
    ("<div class='comment-list'>c</div><div>d</div>", "d"), ("<p hidden>h</p><p style='display: none'>n</p><p>v</p>", "v"),
    ("<div class=\"unclosed>a</div><p>b</p>", "a\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<article><header><h1>h</h1></header><p>t</p><footer>f</footer></article>", "h\nt"), ("<p>" + "w " * 50000 + "</p>", ("w " * 50000).strip()),
    ("<textarea>t</textarea><select><option>o</select><button>b</button>x", "x"), ("</div></p>x</nav>y", "x\ny"),
    ("<div role='navigation'>n</div><div role='main'>m</div>", "m"), ("<P CLASS=Notice>n</P><P>Ok</P>", "Ok"),
])
def test_defined_cases_of_pages(page, want):
    assert text_of(page) == want


def test_runs_fold_and_mismatches_become_optional_or_repeated():
    one = wrappers.folded("ul li # /li li # /li li # /li /ul p # /p".split())
    assert one == ["ul", "(li # /li)+", "/ul", "p", "#", "/p"]
    two = wrappers.folded("ul li # /li /ul h2 # /h2 p # /p p # /p".split())
    merged = wrappers.align(one, two)
    for stream in (one, two):
        assert wrappers.align(merged, stream) == merged  # the wrapper accepts both: aligning them changes nothing
    assert "(h2)?" in merged


def test_wrapper_has_every_slot_of_its_pages():
    pages = ["<article><h1>a</h1><p>b</p></article>", "<article><p>b</p><p>c</p><ul><li>x</li><li>y</li></ul></article>",
             "<nav>n</nav><article><h2>q</h2><blockquote>z</blockquote></article>"]
    streams = ["\t".join(wrappers.folded(wrappers.parse(p)[0])) for p in pages]
    slots = set(wrappers.wrapper_slots(wrappers.wrapper_of(streams)))
    for page in pages:
        assert {f"{t.region}{t.path}" for t in wrappers.parse(page)[1] if not t.dropped} <= slots
    assert wrappers.wrapper_of([]) == ""


def test_constants_of_a_template_go_and_pages_keep_their_rows(spark):
    page = "<div class='x1'>Welcome to our site</div><div class='x2'>{}</div><div class='x3'>All rights reserved</div>"
    rows = [(i, f"http://one.example/{i}", page.format(f"Story number {i} <br>with lines {i}")) for i in range(6)]
    rows += [(20, "https://two.example/a", page.format("alone")), (21, None, "<p>no host</p>"), (22, "broken", None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS slots", "3 AS text", "4 AS path")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in wrappers.extracted(df.drop("host", "slots")).collect()}
    assert got[3][0] == "Story number 3\nwith lines 3" and got[3][1] == len(got[3][0])
    assert got[20][0] == "Welcome to our site\nalone\nAll rights reserved"
    assert got[21][0] == "no host" and got[22] == ("", 0)
    assert wrappers.extracted(df).count() == len(rows)
    assert wrappers.extracted(df.limit(0)).collect() == []


def test_text_of_the_test_pages(spark, sf):
    """The pages' articles are text escaped and cut into paragraphs: undoing that by hand gives the same text."""
    import html
    import re

    from cohortlens.llm.queries import op1_wrappers

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in op1_wrappers(spark, sf).collect()}
    assert set(got) == set(pages)
    for page_id, page in pages.items():
        article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
        blocks = re.split(r"<(?:p|/p|br|h1|/h1)>", re.sub(r"</?b>", "", article))
        lines = (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks)
        assert got[page_id] == "\n".join(line for line in lines if line)


def test_copies_of_a_page_do_not_make_its_text_a_constant(spark):
    page = "<div class='x1'>Our site</div><div class='x2'>{}</div>"
    rows = [(i, "http://copies.example/a", page.format("Only story")) for i in range(5)]
    rows += [(10 + i, None, f"<p>pool of copies</p><!-- {i} -->") for i in range(4)] + [(20, "broken", "<p>another page</p>")]
    rows += [(30 + i, "http://three.example/", "<p>equal</p><p>pages</p>") for i in range(3)]
    rows += [(40 + i, "http://stories.example/", page.format(f"story {i % 4}")) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert {got[i] for i in range(5)} == {"Our site\nOnly story"} and {got[10 + i] for i in range(4)} == {"pool of copies"}
    assert got[20] == "another page" and {got[30 + i] for i in range(3)} == {"equal\npages"}
    assert [got[40 + i] for i in range(8)] == [f"story {i % 4}" for i in range(8)]


def test_constants_inside_articles_go_by_their_place_in_the_wrapper(spark):
    page = "<article><h1>{0}</h1><div class='by'>Our staff writes</div><p>{1}</p><h2 class='a+'>More {0}</h2>{2}<div class='end'>Read the daily letter</div></article>"
    rows = [(i, f"http://daily.example/{i}", page.format(f"Title {i}", f"What happened on day {i} " * 4, "<p>extra</p><p>more</p>" * (i % 2)))
            for i in range(6)]
    said = "Our staff writes"  # the same words elsewhere in an article are its own
    rows.append((9, "http://daily.example/9", page.format("Title 9", said, "<p>and a text that is long enough to be the article</p>")))
    copy = "<article><p>" + "The same long words in every copy. " * 5 + "</p><p>seen {} times</p></article>"
    rows += [(20 + i, "http://near.example/", copy.format(i)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(6):
        story = ("What happened on day %d " % i * 4).strip()
        assert got[i] == "\n".join([f"Title {i}", story, f"More Title {i}", *["extra", "more"] * (i % 2)])
    assert got[9].split("\n") == ["Title 9", said, "More Title 9", "and a text that is long enough to be the article"]
    assert all(got[20 + i].startswith("The same long words") for i in range(4))


def test_places_of_repeated_and_optional_texts():
    streams = [wrappers.parse(p)[0] for p in ("<p>a</p><p>b</p><i>c</i>", "<p>a</p><p>b</p><p>c</p><b>d</b><i>e</i>")]
    wrapper = wrappers.Wrapper(wrappers.wrapper_of(["\t".join(wrappers.folded(s)) for s in streams]))
    one, two = map(wrapper.places, streams)
    assert one[0] == one[1] == two[0] == two[2] and one[2] == two[4] != two[3]
    odd = wrappers.parse("<p class='a?'>x</p>")[0]
    assert wrappers.wrapper_slots("\t".join(wrappers.folded(odd))) == ["0p.a?"]


def test_ids_made_of_titles_keep_their_text(spark):
    slugs = """<article><h2 id='related-work'>Related work</h2><p>a</p><section id='search-algorithms'><p>b</p></section>
    <div id='social-history'>c</div><section id='comments'><h3>Comments</h3><p>d</p></section><div class='share'>no</div></article>"""
    assert text_of(slugs) == "Related work\na\nb\nc\nComments\nd"
    assert text_of("<main><section id='login-forms'><h2 id='search'>Search</h2></section><div id='top-nav'>no</div></main>") == "Search"
    assert text_of("<div id='left-sidebar'>no</div><div id='comments'>no</div><p>yes</p>") == "yes"
    page = "<article><p>Story of {0}</p><div id='comments'><p>reader {0}</p></div><h2 id='related-work'>Work {0}</h2></article>"
    rows = [(i, "http://many.example/", page.format(i)) for i in range(5)] + [(9, "http://few.example/", page.format(9))]
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i] for i in range(5)] == [f"Story of {i}\nWork {i}" for i in range(5)]
    assert got[9] == "Story of 9\nreader 9\nWork 9"


def test_section_headings_inside_an_article_stay(spark):
    page = ("<article><p>Share this recipe</p><h2>Serves four</h2><h1>Recipe {0}</h1><h2>Ingredients</h2><h3>Main part</h3><p>Eggs, {0} of them</p>"
            "<p>Advertisement</p><h2>Method</h2><p>Wash first.</p><p>Stir {0} times, then wait for {0} minutes.</p><h2>Read on</h2><p>Subscribe</p></article>")
    rows = [(i, f"http://cook.example/{i}", page.format(i)) for i in range(6)]
    found = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(6):
        assert found[i] == f"Serves four\nRecipe {i}\nIngredients\nMain part\nEggs, {i} of them\nMethod\nStir {i} times, then wait for {i} minutes."


def test_white_space_and_repeated_attributes():
    import re
    import sys

    from cohortlens.llm import wrappers

    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isspace() or re.match(r"\s", c) or code < 0x300:
            for said in (c, f"a{c}{c}b", f"{c} a", f"a{c}", f"{c}{c}"):
                assert wrappers._spaced(said) == re.sub(r"\s+", " ", said), hex(code)
    # Attributes of a template are read once, not at every tag of every page.
    wrappers._attributes.cache_clear()
    page = '<html><body><div class="a b">' + '<p class="text lead">x</p>' * 50 + "</div></body></html>"
    stream, texts = wrappers.parse(page)
    assert wrappers._attributes.cache_info().misses == 2
    assert {t.path for t in texts} == {"html/body/div.a.b/p.text.lead"} and len(texts) == 50
