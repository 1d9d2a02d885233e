"""HTML extraction: exact marginals, hand-made layouts, and the given pages against
their own marks."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from rtdw.llm import html_content as H

SF = "/root/testdata/sf0.01"
P = "The committee met on Tuesday, and after a long debate it agreed to publish the report in full."
Q = "Nobody expected the river to rise so fast; by noon the lower streets were under water, said the mayor."


@pytest.fixture(scope="module")
def pages(spark):
    from rtdw.llm.common import prepare
    prepare(spark)
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return H.train(pages)


def test_marginals_equal_enumeration():
    trees = [H.Tree("<div><p>a b. <b>c</b></p><nav><a>x</a></nav></div>t"), H.Tree("<ul><li>1<li>2, 3</ul>")]
    rng = np.random.default_rng(2)
    weights = H.PRIOR + rng.normal(size=len(H.PRIOR))
    forest = H.Forest(trees)
    for given in (False, True):
        got, both = forest.marginals(weights, given)
        score = forest.x @ weights[:H.WIDTH]
        same = weights[H.WIDTH:].reshape(H.PAIRS.shape)[forest.kind]
        start = 0
        for t in trees:
            n = len(t.parent)
            total, on, pair = 0.0, np.zeros(n), np.zeros((n, 2))
            for state in itertools.product((0, 1), repeat=n):
                s = np.array(state)
                mine = slice(start, start + n)
                if given and (s != forest.label[mine])[forest.observed[mine]].any():
                    continue
                e = (s * score[mine]).sum()
                for i in range(1, n):
                    if s[i] == s[t.parent[i]]:
                        e += same[start + i][s[i]]
                e = np.exp(e)
                total += e
                on += e * s
                for i in range(1, n):
                    if s[i] == s[t.parent[i]]:
                        pair[i, s[i]] += e
            assert np.allclose(got[start:start + n], on / total)
            assert np.allclose(both[start + 1:start + n], pair[1:] / total)
            start += n


def test_gradient_raises_the_likelihood_of_labels():
    source = f"<body><nav><a>x</a></nav><article><p>{P}</p><p>{Q}</p></article><footer>by me</footer></body>"
    w = H.fit([source] * 2, rounds=30)
    forest = H.Forest([H.Tree(x) for x in H.training_pages(source)])
    right = lambda v: np.abs(forest.marginals(v)[0] - forest.label)[forest.observed].mean()
    assert right(w) < right(H.PRIOR)


def _marked(source):
    """Blocks of the one article of a given page, by regular expressions."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", source or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", m[1]) if m else []
    plain = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(b for b in plain if b)


def test_given_pages_give_their_articles(pages, weights):
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r for r in H.extract(pages, weights).collect()}
    assert set(got) == set(source)
    for i, x in source.items():
        assert got[i]["text"] == _marked(x) and got[i]["n_chars"] == len(got[i]["text"])


def test_the_model_does_without_the_mark(pages, weights):
    """Held-out pages with names and marks taken away: nearly all article blocks are
    found and nearly nothing else."""
    sources = [r["html"] for r in pages.where("page_id % 5 = 0").collect()]
    bare = [re.sub(r"(</?)(?:nav|footer|article)(?=>)", r"\1div", x) for x in sources]
    hits = found = wanted = 0
    for x, got in zip(sources, H.texts(bare, weights)):
        want = _marked(x).split("\n")
        some = got.split("\n")
        wanted += sum(map(len, want))
        found += sum(map(len, some))
        hits += sum(len(b) for b in some if b in want)
    assert hits / wanted > 0.97 and hits / found > 0.97


LAYOUTS = {
    "div": (f"""<html><body class="has-sidebar"><div id="top"><a href=/>Home</a> <a href=/n>News</a></div><div class="wrap">
        <div class="post"><h1>Report out</h1><p>{P}</p><p>{Q} <a href="x">more here</a></p><div class="advert">Buy shoes now!</div>
        <p>{P}</p><ul><li>One point that matters, really.</li><li>Two</li></ul></div><div class="sidebar"><h3>Latest</h3><ul>
        <li><a href=1>Story one</a></li><li><a href=2>Story two</a></li></ul></div></div><section id="comments"><h2>Comments</h2>
        <p>Great read, thanks a lot for writing this piece!</p></section><footer>&copy; 2020 Site</footer></body></html>""",
            ["Report out", P, Q + " more here", P, "One point that matters, really.", "Two"]),
    "main": (f"""<body><header><h1>My Site</h1><nav><a href=/>Home</a></nav></header><div class="cookie-banner"><p>We use cookies
        to improve your experience, please accept them.</p><button>Accept</button></div><main><h1>Flood</h1><p>{Q}</p><aside>Read
        also: <a href=3>this one</a></aside><form action=/s><label>Email</label><input><button>Subscribe</button></form><p>{P}</p>
        </main><div class="related"><h3>Related</h3><p>{P}</p></div></body>""", ["Flood", Q, P]),
    "plain": (f"<body><p><a href=1>Home</a> | <a href=2>About</a> | <a href=3>Contact</a></p><h1>Flood</h1><p>{Q}<p>{P}<p>{Q}</body>",
              ["Flood", Q, P, Q]),
    "table": (f"<table><tr><td><a href=1>Home</a><br><a href=2>About</a><td><h2>Flood</h2><p>{Q}<p>{P}</table>", ["Flood", Q, P]),
    "comments inside": (f"""<body><nav><a href=/>x</a></nav><article><header><h1>Flood</h1></header><p>{Q}</p><div class="comments">
        <p>{P}</p><p>I agree.</p></div><p>{P}</p><footer>By me</footer></article><div class="notice">{P}</div></body>""",
                        ["Flood", Q, P]),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(weights, name):
    source, want = LAYOUTS[name]
    assert H.texts([source], weights)[0].split("\n") == want


def test_markup_and_references(weights):
    body = ("<ARTICLE ID=a><h1>A &amp; B &lt;i&gt; &#233;&eacute; &amp</h1><p class='x>y'>one\n\t two<br>three<!-- <p>no</p> -->"
            f" fo<b>ur</b><script>if (a<b) '</p>'</script><p>{P}<style>p{{}}</style><div>{Q}</div></span></ARTICLE>"
            "<script>never closed")
    assert H.texts([body], weights)[0].split("\n") == ["A & B <i> éé &", "one two three four", P, Q]


def test_edges(spark, pages, weights):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "   "), (3, "u", "<"), (4, "u", "a < b"), (5, "u", "<!-- open"),
            (6, "u", "</p></div>"), (7, "u", f"<article><p>{P}"), (7, "u", f"<article><p>{P}")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id int, url string, html string, text string, n_chars string")
    got = H.extract(df, weights)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got.collect()), key=repr)
    assert len(out) == len(rows) and sum(t == P and n == len(P) for _, _, t, n in out) == 2
    assert [(t, n) for i, _, t, n in out if i in (1, None)] == [("", 0)] * 3
    assert H.extract(df.limit(0)).count() == 0                   # nothing to learn from either
    assert np.array_equal(H.train(df.where("page_id < 6")), H.PRIOR)


def test_cost_is_linear(weights):
    for odd in ("<" * 200_000, "<a " * 70_000, "<!--" * 50_000, "<b>" * 60_000 + "x", "<div>" * 20_000 + "</p>" * 20_000,
                "<p title='" * 20_000, "<p a=\"" * 20_000 + ">", "&" * 200_000, "</x>" * 50_000, "<li>" * 50_000, "<b><p>" * 20_000):
        t = time.time()
        H.texts([odd], weights)
        assert time.time() - t < 10, odd[:10]
