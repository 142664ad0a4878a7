import math
import re

from pyspark.sql import functions as F

from murmura.llm import urls
from murmura.llm.queries import URL_RULES, labelled_urls, op9_url_filters


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.host + r.path), default=None)


ODD = [
    None, "", "no scheme", "http://", "http://COM", "https://A.com/x", "http://example.com/en/x?y#z", "http://www.Example.com/en/",
    "http://example.com/EN/", "x://notexample.com/en/", "http://a.net/es/", "http://net/fr/q", "http://a.b.net/fr", "http://com/?a=://net/es/",
    "p://u:p@h.com:80/", "http://a.com" + "/x" * 5000, "http://ÀB.net/es/é",
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, "a", "b") for i, u in enumerate(ODD)], "page_id long, url string, host string, rule string")
    rows = urls.judge(pages, URL_RULES, urls.Model([0.0] * 64, -1.0, 64)).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        host, path = split(ODD[r.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want and want.host + want.path)
        assert r.verdict == (want.verdict if want else "allow")
    assert urls.judge(pages.limit(0), URL_RULES, urls.Model([0.0] * 64, 0.0, 64)).collect() == []


def test_training_follows_gradient_descent(spark):
    """The same steps in plain Python, on the features that Spark gives."""
    dims, steps, rate, ridge = 256, 12, 4.0, 1e-3
    data = labelled_urls(spark)
    model = urls.train(data, dims=dims, steps=steps, rate=rate, ridge=ridge)
    url = F.col("url")
    rows = data.select(urls.features(urls.host_of(url), urls.path_of(url), dims).alias("x"), "block").collect()
    w, b = [0.0] * dims, 0.0
    aw, ab = w, b
    for step in range(steps):
        g, gb = [0.0] * dims, 0.0
        for r in rows:
            e = 1 / (1 + math.exp(-(ab + sum(aw[i] for i in r.x) / math.sqrt(len(r.x))))) - r.block
            gb += e / len(rows)
            for i in r.x:
                g[i] += e / math.sqrt(len(r.x)) / len(rows)
        nb, nw = ab - rate * gb, [a * (1 - rate * ridge) - rate * x for a, x in zip(aw, g)]
        s = step / (step + 3)
        aw, ab = [n + s * (n - a) for a, n in zip(w, nw)], nb + s * (nb - b)
        w, b = nw, nb
    assert all(abs(x - y) < 1e-9 for x, y in zip(model.weights, w)) and abs(model.bias - b) < 1e-9


def test_held_out_accuracy(spark):
    rows = op9_url_filters(spark, "/root/testdata/sf0.01").collect()
    poor = re.compile("casino|pills|spam|bets|ads-|adult")
    right = [(r.p_block >= 0.5) == bool(poor.search(r.host)) for r in rows]
    assert sum(right) >= 0.95 * len(right)


def test_labels_of_one_kind_or_none(spark):
    data = labelled_urls(spark)
    assert urls.train(data.filter("block")).bias > 0
    assert urls.train(data.filter("not block")).bias < 0
    assert urls.train(data.filter("url is null")).bias < 0
