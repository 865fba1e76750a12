from __future__ import annotations

from urllib.parse import urlsplit

from tidemark.llm import url_templates as ut
from tidemark.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, node string, label string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "x", "y", "z") for i, u in enumerate(urls)], SCHEMA)


def test_parts_and_rules(spark):
    urls = ["http://WWW.Example.ORG/es/1?x#y", "https://a.example.org/en/12", "http://org/en",
            "http://xorg/es/", "ftp://b.com/fr/ü?a", "http://c.com/de/2#t", "http://c.com/de",
            "no scheme", None, "", "http://", "http://h?q=/a", "http://É.com/fr/", "x://y://z/w",
            "http://example.org/en/1", "http://example.org/es/", "http://badexample.org/es/"]
    rows = {r.page_id: r for r in ut.judge(pages(spark, urls), ut.parse_rules(URL_RULES)).collect()}
    assert len(rows) == len(urls)
    rules = ut.parse_rules(URL_RULES)
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
            path = rest[cut:]
            path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host))
                and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        r = rows[i]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (best.name if best else None)
        assert r.verdict == (best.verdict if best else "allow")


def test_templates_follow_the_labels(spark):
    rules = ut.parse_rules(["block h.com/bad/a", "allow h.com/good/a"])
    urls = [f"http://h.com/bad/a{i}.html" for i in range(30)] \
        + [f"http://h.com/bad/z{i}.html" for i in range(10)] \
        + [f"http://h.com/good/a{i}" for i in range(30)] \
        + [f"http://h.com/good/z{i}" for i in range(10)] \
        + [f"http://h.com/other/{i}" for i in range(5)] + ["http://h.com", "http://i.com/bad/z1"]
    rows = ut.judge(pages(spark, urls), rules).collect()
    of = {r.path if r.host == "h.com" else "i": r for r in rows}
    assert of["/bad/z1.html"].template == "/bad/*.html" and of["/bad/z1.html"].rule is None
    assert of["/bad/z1.html"].verdict == "block"        # by its template
    assert of["/good/z1"].verdict == "allow" and of["/other/1"].verdict == "allow"
    assert of["i"].verdict == "allow" and of[""].template == ""


def test_alike_branches_merge_and_odd_tables(spark):
    rules = ut.parse_rules([])
    urls = [f"http://h.com/{b}/{i}" for b in ("a", "b") for i in range(20)] \
        + ["http://h.com/" + "/".join("p" * 1 for _ in range(30))]
    rows = ut.judge(pages(spark, urls + urls), rules).collect()
    assert len(rows) == 2 * len(urls)
    assert {r.template for r in rows if urlsplit("http://h.com" + r.path).path.count("/") == 2} \
        == {"/~/*"}
    assert ut.judge(pages(spark, urls).where("false"), rules).count() == 0


def test_deep_branches_are_told_apart(spark):
    top = "h.com/a/b/c/d/e/f/g/h"
    deep = f"http://{top}"
    rules = ut.parse_rules([f"block {top}/bad/a", f"allow {top}/good/a"])
    urls = [f"{deep}/{b}/{l}{i}" for b in ("bad", "good") for l in "az" for i in range(30)] \
        + [f"{deep}/other/{i}" for i in range(5)] + [deep, f"{deep}/bad", "http://l.com/a/b//"] \
        + ["http://i.com" + "/s" * n for n in range(6)] + ["http://j.com/" + "x/" * 200] * 2 \
        + [f"http://k.com/p{i}/q/r/s{j}" for i in range(2) for j in range(9)]
    rows = ut.judge(pages(spark, urls), rules).collect()
    assert len(rows) == len(urls)
    of = {r.host + r.path: r for r in rows}
    for i in range(30):
        bad, good = of[f"{top}/bad/z{i}"], of[f"{top}/good/z{i}"]
        assert bad.rule is None and good.rule is None
        assert (bad.verdict, good.verdict) == ("block", "allow")
        assert bad.template == "/a/b/c/d/e/f/g/h/bad/*"
        assert good.template == "/a/b/c/d/e/f/g/h/good/*"
    assert all(of[f"{top}/other/{i}"].verdict == "allow" for i in range(5))
    assert of[top].template == "/a/b/c/d/e/f/g/h"
    # Shared stretches are kept segment by segment, wherever pages end in them.
    assert all(r.template == r.path for r in rows if r.host in ("i.com", "j.com", "l.com"))
    assert {r.template for r in rows if r.host == "k.com"} == {"/~/q/r/~"}
