import re

import numpy as np

from tickyard.llm import html_blocks as B, html_extract as X, html_training as H, url_filter as U

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def text_of(page):
    return [b.text for b in B.blocks(page)]


def test_blocks():
    assert text_of("<p>a &amp; b<br>c\n <b>d</b>e</p>f") == ["a & b c de", "f"]
    assert text_of("<p>one<p>two<ul><li>x<li>y</ul>z") == ["one", "two", "x", "y", "z"]
    assert text_of("<script>var t='</p>';</script><style>a</style>x<!-- <p>no</p> -->y") == ["xy"]
    assert text_of("<p title='a>b'>in</p><p class=\"x") == ["in"]
    assert text_of("") == [] and text_of("plain &eacute;&#233;&nbsp;x") == ["plain éé x"]
    b = B.blocks('<div class="Ad-Box top" id=q1><a href=x>link</a> rest')[0]
    assert b.path == ("div", "ad", "box", "top", "q") and b.link_chars == 4 and b.text == "link rest"
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert text_of("<script>never closed <p>x</p>") == []


def test_gradients():
    """Backpropagation against finite differences."""
    r = np.random.default_rng(0)
    m = X.BiLstm()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x = r.normal(size=(4, 2, X.INPUT)) * (r.random((4, 2, X.INPUT)) < 0.05)
    mask = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = r.integers(0, 2, (4, 2)).astype(float)

    def loss():
        p = m.probabilities(x, mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()
    g = m.gradients(x, mask, y)
    for name in m.p:
        flat = m.p[name].reshape(-1)
        for k in r.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[k]
            flat[k] = old + 1e-4
            up = loss()
            flat[k] = old - 1e-4
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-4 - g[name].reshape(-1)[k]) < 2e-3, name


def test_held_out_accuracy(spark):
    m = X.BiLstm()
    m.p = X.trained()
    pages = [p for p in map(B.blocks, H.training_pages(150, seed=1234)) if p]
    right = [((v >= 0.5) == np.array([b.main for b in p])) for p, v in zip(pages, X.label(pages, m, {}), strict=True)]
    assert np.concatenate(right).mean() > 0.97


def test_given_pages(spark):
    """The article of the given pages, cut out by its own element."""
    from tickyard.sources.tables import table
    rows = table(spark, "/root/testdata/sf0.001", "pages")
    got = {r.page_id: r.text for r in X.extract(rows).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        assert got[r.page_id] == "\n".join(text_of(inner)), r.page_id


def test_extract_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>The article has a long sentence here.</p></article>"),
            (3, "u", "<nav><a href=x>menu</a></nav>"), (3, "u", "<nav><a href=x>menu</a></nav>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    got = X.extract(df).collect()
    assert len(got) == 5 and X.extract(df).columns == ["page_id", "url", "text"]
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert X.extract(df.limit(0)).collect() == []


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(t), t, v) for v, t in RULES for h, _, p in [t.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://x.example.org/en/1?q", "http://a.org", "http://a.org/",
        "http://org/x", "http://morg/x", "http://b.com/fr/1#t", "http://b.com/de/", "http://b.com/fr", "ftp://c.net/?a/b", "http://É.org/",
        "x://y://z/p", "http://example.org/en/2", "http://h.com/de/1", "http://h.com/de/1", "http://a.com?x/fr/"]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id bigint, url string, host string")
    model = U.train(U.labelled_by_rules(df, RULES), steps=3)
    got = U.judge(df, RULES, model, "page_id").collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = parts(URLS[r.page_id])
        text, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, text)
        assert r.verdict == (verdict or ("allow" if r.score >= 0.5 else "block"))


def test_url_model_on_held_out_urls(spark):
    rows = [(f"http://{'shop' if i % 2 else 'docs'}{i}.example.net/{'buy' if i % 2 else 'guide'}/{i}", 1 - i % 2) for i in range(300)]
    weights = U.train(spark.createDataFrame(rows[:200], "url string, label int"))
    held = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows) if i >= 200], "page_id bigint, url string")
    got = U.judge(held, [], weights, "page_id").collect()
    assert np.mean([(r.verdict == "allow") == bool(rows[r.page_id][1]) for r in got]) > 0.95
    empty = U.train(spark.createDataFrame([], "url string, label int"))
    assert not any(empty[0]) and U.judge(held, [], empty, "page_id").filter("score <> 0.5").isEmpty()


def test_url_path_is_native(spark):
    df = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    plan = U.judge(df, RULES, ([0.0] * (1 << U.BITS), 0.0), "page_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
