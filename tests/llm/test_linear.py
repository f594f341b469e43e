"""Long and deeply nested inputs that once took time or memory by their square."""

import time

from tidemark.llm import html, urlfilter


def letters(k):
    return "".join(chr(97 + int(c)) for c in str(k))


def test_pages_of_a_megabyte():
    crf = html.model()
    nested = "".join(f'<div class="n{letters(k)}">t{k}' for k in range(50_000))
    lists = "<dl><dt><div>" + "<h1>" * 50_000 + "<dt>x</dt>" * 50_000
    for page in (nested, lists, "<p>" * 200_000 + "x", "<li>" * 100_000 + "</ul>" * 100_000):
        began = time.time()
        html.main_text(page, crf)
        assert time.time() - began < 60


def test_shared_paths_score_as_whole_lists():
    """What blocks share of their paths is added once; the sum is that over each block's full list of features."""
    crf = html.model()
    for page, _ in html.labelled_pages(40, 77):
        blocks = html.leaf_blocks(page + '<div class="main post"><ul class="main"><li>x<div class="post ad">y</div>z')
        for b, s in zip(blocks, crf.scores(blocks), strict=True):
            feats = html.block_features(b)
            assert len(feats) == len({*feats}) and abs(s - crf.score(feats)) < 1e-9
            assert ("outside" in feats) == ("in:article" not in feats and "in:main" not in feats)


def test_open_elements_close_as_before():
    text = lambda page: [b.text for b in html.leaf_blocks(page)]
    assert text("<ul><li>a<ul><li>b</ul>c<li>d</ul>e") == ["a", "b", "c", "d", "e"]
    last = html.leaf_blocks("<table><tr><td><p>a<td>b<tr><td>c</table>d")[-2]
    assert sorted(html.block_features(last)) == sorted(["bias", "tag:td", "size:1", "links:0", "outside", "in:table", "in:tr", "in:td"])
    inner = html.leaf_blocks("<p>a<div><p>b<p>c")
    assert [f for f in html.block_features(inner[-1]) if f.startswith("in:")] == ["in:p", "in:div"] or {f for f in html.block_features(inner[-1]) if f.startswith("in:")} == {"in:p", "in:div"}


LISTED = "host string, path string, verdict string, is_rule boolean"


def test_hosts_of_very_many_labels(spark):
    deep = "x." * 100_000
    urls = [f"http://{deep}net/a", f"http://{deep}example.com/de/x?y", f"http://{deep}a.b.c.listed.test/p/1/", f"http://{'.' * 50_000}", "http://" + "." * 9 + "net/", f"http://u@{deep}listed.test:8/p/1/q", None]
    rows = [("net", "/", "block", True), ("example.com", "/de/", "block", True), ("c.listed.test", "/", "block", False), ("listed.test", "/p/1/", "block", False), ("a.b.c.d.e.f", "/", "block", True)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    began = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlfilter.judge_urls(pages, spark.createDataFrame(rows, LISTED)).collect()}
    assert got == {0: ("net/", "block"), 1: ("example.com/de/", "block"), 2: (None, "block"), 3: (None, "allow"), 4: ("net/", "block"), 5: (None, "block"), 6: (None, "allow")}
    assert time.time() - began < 120


def test_expressions_are_the_suffixes_that_can_be_listed():
    for host in ("a.b.c.d", "x", "", ".a.", "a..b"):
        labels = host.split(".")
        every = [(".".join(labels[i:]), len(labels) - i) for i in range(len(labels))]
        for counts in ([1], [2, 3], [1, 2, 3, 4, 9], []):
            for lengths in ([1], [1, 4], []):
                want = {h + "/abc/"[:n] for h, k in every if k in counts for n in lengths if n <= 5}
                got = urlfilter.expressions(host, "/abc/", lengths, counts)
                assert {*got} == want and len(got) == len(want)
