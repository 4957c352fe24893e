import itertools
import random

import numpy as np

from citytherm.llm import htmltext as H

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="page">
<header><h2>Site name</h2><form><input value=x><label>Search</label></form></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href=/b>About us</a></ul></nav><!-- <p>not this</p> -->
<div class="cookie-notice">We use cookies.</div><script>var a = "</p><p>no</p>";</script>
<article class="post"><h1>The  title &amp; more</h1><p>First <b>bold</b>&nbsp;text<br>second line.<p>Unclosed &lt;p&gt; one, it is longer than others.
<div class="ad">Buy this now</div><ul><li>item one, short</li><li>item two.</li></ul>
<table><tr><td>a</td><td>b</td></tr></table><p>Last &eacute;&#x1F642; paragraph.</p>
<section id="comments"><h3>Comments</h3><p>A reader says this is all quite wrong, really.</p></section></article>
<aside><p>Related story that is long enough to look like a paragraph of the text.</p></aside>
<div hidden><p>Hidden words.</p></div><footer>&copy; site</footer></body></html>"""
TEXT = ["The title & more", "First bold text second line.", "Unclosed <p> one, it is longer than others.", "item one, short", "item two.", "a b", "Last é🙂 paragraph."]


def test_page_with_everything():
    assert H.extract(PAGE, H.Settings()).split("\n\n") == TEXT


def test_cut_off_anywhere_does_not_fail():
    for n in range(0, len(PAGE), 7):
        H.extract(PAGE[:n], H.Settings())
    assert H.extract("<article><p>one &am", H.Settings()) == "one &am"
    assert H.extract("<article><p>one</p><p cla", H.Settings()) == "one"


def test_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(40):
        n = rng.randint(1, 8)
        costs = np.array([rng.uniform(-2, 2) for _ in range(n)])
        edges = [(a, b, rng.uniform(0, 1.5)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(side):
            return (sum(max(c, 0) if not k else max(-c, 0) for c, k in zip(costs, side)) + sum(w for a, b, w in edges if side[a] != side[b]))
        best = min(cost(side) for side in itertools.product((False, True), repeat=n))
        assert abs(cost(H.cut(costs, edges).tolist()) - best) < 1e-6


def test_shape_model_serves_plain_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = H.fit(pages)
    assert len(model.weights) == 8 + len(H.KINDS)
    body = "Words of a long paragraph, with commas and an end. " * 6
    links = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(6))
    plain = f"<body><div><ul>{links}</ul></div><div><h1>Heading of it.</h1><p>{body}</p><p>{body}</p><p>{body}</p></div><div>&copy; me</div></body>"
    got = H.extract(plain, model)
    assert body.strip() in got and "link 3" not in got


def test_rows_nulls_and_empty(spark):
    rows = [(1, "u", None), (2, "u", ""), (None, None, "<p>"), (3, "u", PAGE), (3, "u", PAGE), (4, "u", "<article>" + "<p>x y.</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in H.main_text(df, H.Settings()).collect()]
    assert sorted(got, key=str) == sorted([(1, ""), (2, ""), (None, ""), (3, "\n\n".join(TEXT)), (3, "\n\n".join(TEXT)), (4, "\n\n".join(["x y."] * 20_000))], key=str)
    assert H.main_text(df.limit(0), H.fit(df.limit(0))).count() == 0


def test_hints_of_wrappers_and_elements_can_be_outvoted(spark):
    model = H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    long = ["The first long paragraph, with commas, of the text itself. " * 5, "A second one that goes on, and on, until it ends here. " * 5]
    text = "".join(f"<p>{t}</p>" for t in long)
    nav = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>'
    foot = "<footer>&copy; me</footer>"
    want = "\n\n".join(t.strip() for t in long)
    for page in (f'<body class="has-sidebar">{nav}<div>{text}</div>{foot}</body>',
                 f'<body><div class="page with-header">{nav}{text}{foot}</div></body>',
                 f'<body class="sidebar-right">{nav}<div id="content">{text}</div>{foot}</body>',
                 f'<body class="widget cookie-consent-shown"><main>{nav}{text}</main>{foot}</body>',
                 f'<body class="menu-closed">{nav}<article class="post sidebar-none">{text}</article>{foot}</body>'):
        assert H.extract(page, model) == want, page
        if "<div>" not in page and "with-header" not in page:  # a container names the text: no shape needed
            assert H.extract(page, H.Settings()) == want, page


def test_costs_and_neighbours_outvote_a_word():
    page = '<body><div><p>a</p><p class="story">b b</p><p class="share">c c</p><p class="story">d d</p></div><div class="content">e</div></body>'
    costs = [b.hint for b in H.blocks_of(page)]
    assert [c > 0 for c in costs] == [False, True, False, True, True] and max(map(abs, costs)) < 1
    assert H.extract(page, H.Settings(near=0)).split("\n\n") == ["b b", "d d", "e"]
    assert H.extract(page, H.Settings(near=3)).split("\n\n") == ["a", "b b", "c c", "d d", "e"]
    many = "<article><p>text</p></article><article class='comment'><p>no</p></article><p>x</p><div class='promo'>y</div>"
    assert H.extract(many + "<article>" + "<p>more of it</p>" * 9 + "</article>", H.Settings()).split("\n\n") == ["text"] + ["more of it"] * 9


def test_broken_and_hidden_markup_keeps_the_text():
    body = "<article><p>One of it.</p><p>Two.</p></article><footer>me</footer>"
    for page in (f"<html><head><title>no</title><meta charset=utf-8><body>{body}", f"<head><title>no</title><link href=x>{body}", f"<head><title>no<meta charset=x><body>{body}",
                 f"<head><noscript><link href=x><body>{body}", f"<title>no</title>{body}", f"<head><title>no{body}", f'<body><svg class="i" viewBox="0 0 1 1"/>{body}',
                 f"<body><div><svg><path d=x></div>{body}", f"<body><svg><path d=x>{body}", f"<body><div><button>no</div>{body}", f"<body><p><select><option>no</p>{body}",
                 f"<body><div><object data=x>no</div>{body}", f"<body><span><iframe src=x></span>{body}", f"<body><noscript>no<body>{body}", f"<body><p><template><b>no</p>{body}",
                 f'<body><button>no<button>no</button>{body}', f'<body data-hidden="false" title="Hidden lake">{body}', f'<body data-class="nav" data-x=\'class="menu" hidden\'>{body}'):
        assert H.extract(page, H.Settings()) == "One of it.\n\nTwo.", page
    for part in ("<svg><title>no</title><text>no</text></svg>", "<button>no</button>", "<select><option>no<option>no</select>", "<span hidden>no</span>", "<object><p>no</p></object>",
                 "<noscript><p>no</p></noscript>", "<template><div>no</div></template>", "<svg><foreignObject><div>no</div></foreignObject></svg>", "<iframe>no</iframe>",
                 "<i style='display: none'>no</i>", "<textarea><p>no</textarea>", "<script>'</p>'</script>"):
        assert H.extract(f"<article><p>One {part} two.</p><p>Three.</p></article>", H.Settings()) == "One two.\n\nThree.", part
    assert H.extract("<article>" + "<b></i>" * 30_000 + "<p>end</p></article>", H.Settings()) == "end"


def test_readers_comments_go_whatever_their_share(spark):
    model = H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    text = [f"Paragraph {i} of the article, with commas, and an end of its own." for i in range(4)]
    body = "".join(f"<p>{t}</p>" for t in text)
    said = "A reader writes that this is all wrong, and that it is long, and ends here. "
    for n in (1, 3, 12, 60, 200):
        for thread in ('<section id="comments"><h3>Comments</h3>{}</section>', '<div class="comment-list">{}</div>', '<ol class="box commentlist">{}</ol>'):
            many = "".join(f'<article class="comment"><p>{said * 3}</p></article>' if n % 2 else f"<p>{said}</p>" for _ in range(n))
            inside = f"<body><nav><a href=/>Home</a></nav><article>{body}{thread.format(many)}</article><footer>me</footer></body>"
            after = f"<body><article>{body}</article>{thread.format(many)}</body>"
            for page in (inside, after):
                for s in (model, H.Settings()):
                    assert H.extract(page, s).split("\n\n") == text, (n, thread)
    for wrapper in ('<body class="has-comments comments-open">{}</body>', '<body><article class="post comments-closed">{}</article></body>', '<body><form id="all">{}</form></body>'):
        assert H.extract(wrapper.format("<h1>A heading of it.</h1>" + body * 3), model).split("\n\n")[-12:] == text * 3, wrapper


def test_the_cut_turns_blocks_that_stand_between_others():
    """Costs alone would keep the label of each block; neighbours decide where the costs are weak."""
    page = '<body><div><p class="story">one</p><p>two</p><p class="story">three</p><p>four</p><p>five</p></div><div><p>six</p></div></body>'
    alone, joint = H.Settings(near=0, far=0, sibling=0), H.Settings()
    assert H.extract(page, alone).split("\n\n") == ["one", "three"]
    assert H.extract(page, joint).split("\n\n")[:3] == ["one", "two", "three"]
