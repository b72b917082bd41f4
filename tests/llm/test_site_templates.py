import random

import pytest

from feedlake.llm import site_templates as sites


def text(html):
    return "\n".join(t for t, _ in sites.Page(html).blocks())


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<article><h1>T</h1><p>a  b\n c<p>d</article>", "T\na b c\nd"),
        ("<nav>menu</nav><article><p>x</p></article><footer>f</footer>", "x"),
        ("<article><p>Fish &amp; chips &copy &#x41;&#66;</p></article>", "Fish & chips © AB"),
        ("<article><p><b>bold <i>it</b> more<br>line</p></article>", "bold it more line"),
        ("<article><p>a</p><div class='ad box'>buy</div><p>b</p></article>", "a\nb"),
        ("<article><p>a</p><form><p>name</p></form><!-- c --><script>if (a<b) '</p>'</script><p>b", "a\nb"),
        ("<main><article><p>x</p></article><section id='comments'><p>hi</p></section></main>", "x"),
        ("<article><p>short</p></article><article><p>a longer article</p></article>", "short\na longer article"),
        ("<header>site</header><article><header><h1>Title</h1></header><p>x</p></article>", "Title\nx"),
        ("<body class='sidebar'><div>kept</div><div hidden>gone</div><div style='display: none'>gone</div></body>", "kept"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
        ("<article><p>cut of", "cut of"),
        ("<article><p title=\"a>b\">quoted</p><p foo='", "quoted"),
        ("<article><pre>a\n  b</pre></article>", "a b"),
        ("< not a tag > 1 < 2", "< not a tag > 1 < 2"),
        ("<![CDATA[x & y]]><p>z", "x & y\nz"),
    ],
)
def test_main_text(html, want):
    assert text(html) == want


PAGES = "page_id long, url string, html string, key_a string, text string, host string"


def page(body, note, i):
    return f"<body><div class=top><p>Welcome to the site</p></div><div><p>{body}</p></div><div><p>{note}</p></div><p>no {i}</p></body>"


def test_templates_of_a_host_go(spark):
    rows = [(i, f"https://a.example/{i}", page(f"story {i}", "All about us", i), "k", "t", "h") for i in range(8)]
    rows += [(20 + i, f"http://b.example:80/{i}", page(f"story {i}", "All about us", i), "k", "t", "h") for i in range(3)]
    rows += [(40 + i, "https://a.example/x", f"<article><p>the same story</p></article><div><p>All about us</p></div>{i}", "k", "t", "h") for i in range(9)]
    out = {r["page_id"]: r for r in sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3]["text"] == "story 3\nno 3"
    assert out[21]["text"] == "Welcome to the site\nstory 1\nAll about us\nno 1"
    assert out[44]["text"] == "the same story"
    assert out[44]["n_templates"] > 0 and out[21]["n_templates"] == 0


def test_odd_rows(spark):
    rows = [(1, None, None, "", "", ""), (1, None, None, "", "", ""), (2, "x", "", "", "", ""), (None, "y", "<p>z", "", "", ""),
            (3, "http://h/", "<p>" + "long " * 50_000, "", "", ""), (4, "http://h/", "<div>" * 3000 + "deep", "", "", "")]
    out = sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((str(r["page_id"]), len(r["text"])) for r in out) == sorted(
        [("1", 0), ("1", 0), ("2", 0), ("None", 1), ("3", 249_999), ("4", 4)]
    )
    assert sites.main_texts(spark.createDataFrame([], PAGES)).count() == 0


def test_host():
    assert sites.host_of("https://User@WWW.Example.org:8080/a?b") == "www.example.org"
    assert sites.host_of(None) == sites.host_of("no address") == ""


def test_boxes_inside_main_content_go(spark):
    """Boxes that recur inside <article> and <main> go; an article's own passages and copies of it stay."""
    box = "<div class=xyz><p>Read this too</p><ul><li>one</ul></div>"
    article = "<article><h1>Shared title</h1><div><p>story {i} is long enough to be most of it</p></div><p>a passage</p>{box}</article>"
    main = "<main><div><p>tale {i} is long enough to be most of it all</p></div><section>{box}</section></main>"
    copy = "<article><div class=body><h1>Copied</h1><p>the very same story</p></div></article>"
    rows = [(i, "https://a.example/", article.format(i=i, box=box), "k", "t", "h") for i in range(6)]
    rows += [(10 + i, "https://b.example/", main.format(i=i, box=box), "k", "t", "h") for i in range(6)]
    rows += [(20 + i, "https://c.example/", copy, "k", "t", "h") for i in range(6)]
    rows += [(30, "https://d.example/", article.format(i=30, box=box), "k", "t", "h")]
    out = {r["page_id"]: r for r in sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3]["text"] == "Shared title\nstory 3 is long enough to be most of it\na passage"
    assert out[13]["text"] == "tale 3 is long enough to be most of it all"
    assert out[23]["text"] == "Copied\nthe very same story"
    assert out[30]["text"].endswith("a passage\nRead this too\none")


def test_templates_of_a_section_of_a_large_host_go(spark):
    """What recurs on a small share of a host with many pages is a template too."""
    rows = [(i, f"https://a.example/{i}", page(f"story {i}", "All of this section" if i < 8 else f"note {i}", i), "k", "t", "h") for i in range(400)]
    out = {r["page_id"]: r for r in sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3]["text"] == "story 3\nno 3"
    assert out[300]["text"] == "story 300\nnote 300\nno 300"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<main><p>intro</p><article><p>story</p></article><p>outro</p></main>", "intro\nstory\noutro"),
        ("<article><p>one</p></article><div>teaser</div><article><p>two</p></article>", "one\ntwo"),
        ("<div role=main><p>a</p></div><p>beside</p>", "a"),
        ("<article><p>a</p><div class='social-history'>kept</div><div class='social-links'>gone</div></article>", "a\nkept"),
        ("<article><div class=related-work><p>kept</p></div><div id=related><p>gone</p></div></article>", "kept"),
        ("<article><p>a</p><section class=site-header>gone</section><div class=ad-300x250>gone</div></article>", "a"),
        ("<article><p>x</p><article class=comment><p>nice</p></article></article>", "x"),
    ],
)
def test_all_of_the_main_content(html, want):
    assert text(html) == want


@pytest.mark.parametrize("tag", ["div", "main", "article", "section", "div class=story"])
def test_copies_of_a_page_keep_their_text(spark, tag):
    """However many copies a host has, they are one page; what differs beside the text makes them several."""
    body = "<{0}><div><p>the story of the day, told at length</p></div><p>and its end</p></{1}>"
    story = body.format(tag, tag.split()[0])
    rows = [(i, "https://a.example/", f"<body>{story}</body>", "k", "t", "h") for i in range(40)]
    rows += [(100 + i, "https://b.example/", f"<body><p>seen {i}</p>{story}</body>", "k", "t", "h") for i in range(12)]
    out = {r["page_id"]: r["text"] for r in sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(out[i] == "the story of the day, told at length\nand its end" for i in range(40))
    assert all("the story of the day, told at length\nand its end" in out[100 + i] for i in range(12))


def test_a_passage_on_a_few_of_many_pages_stays(spark):
    quote = "<div><h2>As they said</h2><blockquote>to be or not to be</blockquote></div>"
    rows = []
    for i in range(120):
        own = f"<div><p>page {i} has a text of its own that is long, number {i * 7}</p></div>"
        inside = quote if i < 6 else ""
        rows.append((i, "https://a.example/", f"<body><div id=c>{own}{inside}</div><div>all rights</div></body>", "k", "t", "h"))
    out = {r["page_id"]: r["text"] for r in sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3].endswith("\nAs they said\nto be or not to be") and out[3].startswith("page 3 has")
    assert "all rights" not in out[3] + out[50]
    few = {r["page_id"]: r["text"] for r in sites.main_texts(spark.createDataFrame(rows[:30], PAGES)).collect()}
    assert "to be" not in few[3]  # a fifth of the pages of a small host
    many = sites.main_texts(spark.createDataFrame(rows, PAGES), many_pages=6).filter("page_id = 3").first()
    assert "to be" not in many["text"]


def brute(rows, least_pages=5, share=0.1, many=1_000):
    """The same by plain loops over the parsed pages."""
    pages = [(page_id, sites.host_of(url), sites.Page(body or "")) for page_id, url, body, *_ in rows]
    seen, sizes = {}, {}
    for _, host, page in pages:
        sizes.setdefault(host, set()).add(page.text_hash())
        for subtree in page.subtrees():
            seen.setdefault((host, subtree), set()).add(page.text_hash())
    out = []
    for page_id, host, page in pages:
        gone = set()
        for subtree, inside in page.subtrees().items():
            n = len(seen[host, subtree])
            if n >= least_pages and (not inside or n >= many or n >= share * len(sizes[host])):
                gone.add(subtree)
        out.append((page_id, "\n".join(t for t, under in page.blocks() if not gone & set(under)), len(gone)))
    return sorted(out)


def test_counts_against_loops(spark):
    draw = random.Random(8)
    boxes = [f"<div><p>box {i}</p><ul><li>item {i}</ul></div>" for i in range(6)]
    rows = []
    for i in range(300):
        host = draw.choice(["a", "a", "a", "b", "c"])
        parts = [f"<p>{draw.choice(['x', 'y', 'z'])} text {draw.randrange(90)} and more of it</p>" for _ in range(draw.randrange(5))]
        parts += draw.sample(boxes, draw.randrange(4))
        draw.shuffle(parts)
        cut = draw.randrange(len(parts) + 1)
        open_, close = draw.choice([("<article>", "</article>"), ("<div>", "</div>"), ("<main>", "</main>"), ("", "")])
        html = f"<body>{''.join(parts[:cut])}{open_}{''.join(parts[cut:])}{close}</body>"
        rows.append((i, f"http://{host}.example/{i}", html, "k", "t", "h"))
    got = sites.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((r["page_id"], r["text"], r["n_templates"]) for r in got) == brute(rows)
    assert any(r["n_templates"] for r in got)
