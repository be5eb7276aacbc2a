"""Main text of pages: the model against enumeration, held-out layouts, odd pages."""

import html
import re

import numpy as np
import pytest

from lakeops.llm import dom, labelled_pages, pagetext
from lakeops.llm.queries import QUERIES


def enumerated(parent, kinds, unary, edges):
    """Marginals of all labellings, one by one."""
    n = len(parent)
    node, pair, total = np.zeros(n), np.zeros((n, 2, 2)), 0.0
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        weight = sum(u for u, on in zip(unary, y, strict=True) if on)
        weight += sum(edges[kinds[i], y[parent[i]], y[i]] for i in range(n) if parent[i] >= 0)
        weight = np.exp(weight)
        total += weight
        for i in range(n):
            node[i] += weight * y[i]
            if parent[i] >= 0:
                pair[i, y[parent[i]], y[i]] += weight
    return node / total, pair / total


@pytest.mark.parametrize("seed", range(6))
def test_messages_give_exact_marginals(seed):
    rng = np.random.default_rng(seed)
    sizes = [1, 4, 7]
    parents, depths, base = [], [], 0
    for size in sizes:
        own = [-1] + [int(rng.integers(0, i)) for i in range(1, size)]
        depth = [0]
        for p in own[1:]:
            depth.append(depth[p] + 1)
        parents += [p + base if p >= 0 else -1 for p in own]
        depths += depth
        base += size
    parent, depth = np.array(parents), np.array(depths)
    is_text = rng.random(base) < 0.5
    levels = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)]
    unary, edges = rng.normal(0, 2, base), rng.normal(0, 2, (2, 2, 2))
    trees = pagetext.Forest(parent, levels, is_text, np.zeros(0, int), np.zeros(0, int))
    node, pair = pagetext.sum_product(trees, unary, edges)
    wanted, wanted_pair = enumerated(parents, is_text.astype(int), unary, edges)
    assert np.allclose(node, wanted, atol=1e-12)
    children = np.flatnonzero(parent >= 0)
    assert np.allclose(pair[children], wanted_pair[children], atol=1e-12)


def test_held_out_layouts():
    """Pages drawn with another seed: nearly every run of text is told right."""
    model = pagetext.trained()
    pages = [dom.read(s) for s in labelled_pages.pages(200, seed=71)]
    trees = pagetext.forest(pages)
    truth = np.concatenate([pagetext.labels_of(p) for p in pages])
    runs = trees.is_text
    assert ((model.marginals(trees) >= 0.5) == truth)[runs].mean() > 0.98


def plain_article(source):
    """The table's pages have one article element; its blocks are h1 and p."""
    inner = source[source.index("<article>") : source.index("</article>")]
    blocks = [html.unescape(re.sub("<[^>]*>", " ", b)) for b in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_pages_of_the_table(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op11_tree_marginals"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == plain_article(pages[r.page_id].html)


PROSE = "The mill stood by the river, and nobody knew who had built it. It had not turned for years."
PAGES = {
    "aside": f"<body><header><a href='/'>Home</a></header><main><h1>Mill</h1><p>{PROSE}</p><aside class='related'>"
    f"<h3>More</h3><ul><li><a href='#'>x</a></li></ul></aside><p>{PROSE}</p></main><footer>&copy; 2024</footer></body>",
    "classes": f"<body><div class='cookie-notice'><p>{PROSE}</p><button>Fine</button></div><div id='nav'><a href=a>A</a> "
    f"<a href=b>B</a></div><div class='post-content'><h1>Mill</h1><p>{PROSE}<p>{PROSE}</div>"
    f"<div class='comments'><h3>Replies</h3><div class='comment'><p>{PROSE}</p></div></div></body>",
    "form": f"<body><form class='search'><input><p>Find it here.</p></form><article><h1>Mill</h1><p>{PROSE}</p>"
    f"<div class='ad'>{PROSE}</div><p>{PROSE}</p></article></body>",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_parts_that_are_no_content(name):
    assert pagetext.texts(pagetext.trained(), [PAGES[name]]) == [f"Mill\n{PROSE}\n{PROSE}"]


def test_reading_of_odd_markup():
    def runs(source):
        return [t for t in dom.read(source).text if t is not None]

    assert runs("<p>a&amp;b &#8364; &nbsp; c<br>d<!-- x -->e<i>f</i></p>g") == ["a&b € c def", "g"]
    assert runs("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>") == ["one", "two", "in", "three"]
    assert runs("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert runs("<script>if (a < b) '</p>'</script><style>p{}</style><p>x<textarea><p>no</textarea>y") == ["x y"]
    assert runs("<p title='a>b' class=x>c</p ><P>D</P>") == ["c", "D"]
    assert runs("a < b and <3 <unended") == ["a < b and <3"]
    assert runs("") == runs("<!-- never ends") == runs("<script>x") == []
    assert runs("no markup at all") == ["no markup at all"]
    assert runs("<head><title>t</title>text<p>after") == ["text", "after"]
    depth = 30_000
    page = dom.read("<div>" * depth + "deep" + "</div>" * depth)
    assert len(page.parent) == depth + 2 and page.depth[-1] == depth + 1


def test_odd_rows(spark):
    article = f"<article class='post'><h1>Mill</h1><p>{PROSE}</p></article>"
    rows = [
        (1, "u", article, "t"),
        (1, "u", article, "t"),
        (None, None, None, None),
        (3, "v", "", "t"),
        (4, "w", "<nav><a href=a>A</a></nav>", "t"),
        (5, "x", article.replace(PROSE, PROSE * 20_000), "t"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = pagetext.extract(df).collect()
    by_id = {r.page_id: r for r in found}
    assert len(found) == len(rows) and found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert by_id[1].text == f"Mill\n{PROSE}"
    assert by_id[None].text == by_id[3].text == by_id[4].text == "" and by_id[3].n_chars == 0
    assert by_id[5].n_chars == 5 + 20_000 * len(PROSE)
    assert pagetext.extract(df.limit(0)).count() == 0
