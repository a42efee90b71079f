from collections import Counter

import numpy as np
import pytest

from depthgrid.llm import dom, main_text, trees

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet")


@pytest.fixture(scope="module")
def sources(pages):
    return [r["html"] or "" for r in pages.orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def forest(sources):
    return main_text.train(sources[:120])


def test_reader_blocks_white_space_and_references():
    page = dom.read(
        "<body><p>a &amp; b&nbsp;<b>c</b>\n d<br>e<p>f<ul><li>g<li>h <a href='x>y'>i</a></ul>"
        "j<div>k<p>l</div>m</p><!-- no --><script>var x='<p>';</script><textarea>t</textarea>n &lt; o"
    )
    assert page.texts == ["a & b c d e", "f", "g", "h i", "j", "k", "l", "m", "n < o"]
    assert page.linked[3] == 1


@pytest.mark.parametrize(
    "source",
    ["", "<", "</", "<p", "<p class='x", "<!--", "<script>", "</p></div>", "a < b > c", "&#x110000;&bogus;",
     "<p " * 2000, "<div>" * 3000 + "x", "<a href=\"x>y</a><p>z", "\x00<p>퟿"],
)
def test_reader_survives_broken_markup(source, forest):
    assert isinstance(main_text.extract(source, forest), str)


def test_pages_give_their_article(sources, forest):
    held = sources[120:]
    good = 0
    for source, text in zip(held, main_text.extract_all(held, forest)):
        good += text == "\n\n".join(main_text.page_parts(dom.read(source))[0])
    assert good >= 0.98 * len(held)


def test_unseen_layouts(sources, forest):
    draw = np.random.default_rng(123)
    pool = [t for s in sources[120:] for t in main_text.page_parts(dom.read(s))[1]]
    wanted = found = hit = 0
    for source in sources[120:220]:
        main = main_text.page_parts(dom.read(source))[0]
        made = main_text.layout(draw, main[:12], pool)
        page, label = main_text.labelled(made)
        want = [t for o, t in zip(page.owners, page.texts) if label[o]]
        got = main_text.extract(made, forest).split("\n\n")
        wanted, found, hit = wanted + len(want), found + len(got), hit + (Counter(want) & Counter(got)).total()
    assert hit / wanted > 0.95 and hit / found > 0.95


def test_decoding_never_keeps_below_a_dropped_node():
    draw = np.random.default_rng(4)
    for _ in range(50):
        n = 12
        page = dom.Page(tags=["div"] * n, parents=[-1, *(int(draw.integers(k)) for k in range(1, n))])
        margins = draw.normal(0, 3, n)
        kept = main_text.kept_nodes(page, margins, 0.7)
        assert all(kept[p] or not kept[k] for k, p in enumerate(page.parents) if p >= 0)

        def value(choice):
            total = sum(-np.logaddexp(0, -m if c else m) for m, c in zip(margins, choice))
            return total - 0.7 * sum(choice[p] and not choice[k] for k, p in enumerate(page.parents) if p >= 0)

        best = max(
            (value(c) for c in np.array(np.meshgrid(*[[0, 1]] * n)).T.reshape(-1, n)
             if all(c[p] or not c[k] for k, p in enumerate(page.parents) if p >= 0)),
        )
        assert abs(value(kept) - best) < 1e-9


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0)).astype(float)
    model = trees.fit_forest(x[:3000], y[:3000])
    assert ((model.margins(x[3000:]) > 0) == y[3000:]).mean() > 0.95


def test_frame_nulls_clashing_columns_and_empty_tables(spark, forest):
    from pyspark.sql import functions as F

    body = "<article><p>" + "Some words of the article. " * 9 + "</p></article>"
    rows = [(1, "u", body, "mine"), (1, "u", body, "mine"), (2, None, None, "x"), (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.main_texts(pages.withColumn("n_chars", F.lit(3)), forest)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars", "main_text"]
    texts = [r.main_text for r in got.collect()]
    assert texts[0] == texts[1] == ("Some words of the article. " * 9).strip() and texts[2:] == ["", ""]
    empty = spark.createDataFrame([], pages.schema)
    assert main_text.main_texts(empty, main_text.fit(empty)).count() == 0
    assert main_text.extract("<nav>a</nav><p>b</p>", None) == "a\n\nb"


def test_long_page(forest):
    block = "<p>" + "Long words of the story, told at length. " * 20 + "</p>"
    text = main_text.extract(f"<nav><a href=x>menu</a></nav><article>{block * 3000}</article>", forest)
    assert text.count("\n\n") == 2999


def test_open_tags_without_end_take_linear_time():
    import time

    from depthgrid.llm import dom

    def seconds(n):
        begin = time.perf_counter()
        dom.read("<b>" * n + "</p>" * n + "</i>" * n + "<div>" * n)
        return time.perf_counter() - begin

    seconds(100)
    assert seconds(20_000) < 3


def test_a_family_is_counted_alike_below_and_above_200():
    from depthgrid.llm import dom

    column = main_text.NUMBERS
    for n in (199, 201):
        page = dom.read("<div>" + "<p>one</p>" * (n - 1) + "<h2>two</h2></div>")
        x = main_text.features(page)
        shares = {round(float(v), 4) for k, tag in enumerate(page.tags) if tag == "p" for v in x[k, :column]}
        assert round((n - 1) / n, 4) in shares
