"""Style trees: importances against a plain count, and planted menus found without the fixed lists."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest

from siltstone.llm import style_tree

KIND = "page_id long, url string, html string"


def site(rng, host, pages):
    """(url, html, article, menu lines) of pages with a menu, some with a greeting, and a foot; headings come again."""
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    menu, foot, heads = [words(2) for _ in range(7)], words(6), [words(2) for _ in range(5)]
    for k in range(pages):
        article = [heads[k % 5], *(words(rng.randint(5, 30)) for _ in range(rng.randint(1, 5)))]
        noise = [*menu, foot]
        own = menu[:] if rng.random() < 0.9 else menu[:-1]
        noise = [*own, foot]
        body = "".join(f"<p>{x}</p>" if i else f"<h2>{x}</h2>" for i, x in enumerate(article))
        if rng.random() < 0.3:
            body += "<table><tr><td>" + (extra := words(4)) + "</td></tr></table>"
            article.append(extra)
        items = "".join(f"<li>{x}</li>" for x in own)
        yield f"http://{host}/{k}", f"<div class=x1><ul>{items}</ul></div><div class=x2>{body}</div><div class=x3>{foot}</div>", article, noise


def test_importances_as_counted_plainly(spark):
    rng = random.Random(8)
    pages = [(None, url, html) for host in ("a.x", "b.x") for url, html, *_ in site(rng, host, 12)]
    pages += pages[:3] + [(7, None, "<p>alone</p>"), (8, "http://a.x/e", ""), (9, "http://a.x/n", None)]
    got = {}
    for r in style_tree.style_trees(spark.createDataFrame([((u or "")[7:10], h) for _, u, h in pages], "host string, html string")).collect():
        got[r["host"], r["node"], r["feature"]] = (r["importance"], r["presentations"])
    shown, shapes, holders = Counter(), defaultdict(Counter), Counter()
    for host, html in {((u or "")[7:10], h) for _, u, h in pages}:
        found, tree = style_tree.blocks(html or "")
        if not found:
            continue
        for x in {(tree[e][1], w) for e, w in found}:
            shown[host, *x] += 1
        own = defaultdict(set)
        for e, inner in style_tree.branches(found, tree).items():
            path = []
            for x in (tree[c][1] for c in inner if c >= 0):
                path += [x] if path[-1:] != [x] else []
            own[tree[e][1]].add(tuple(path))
        for node, styles in own.items():
            holders[host, node] += 1
            shapes[host, node].update(styles)
    want = {}
    for (host, node), m in holders.items():
        if m >= max(style_tree.SEEN, style_tree.COMMON * holders[host, 0]):
            total = sum(shapes[host, node].values())
            entropy = -sum(n / total * math.log(n / total, m) for n in shapes[host, node].values())
            want[host, node, None] = (min(entropy, 1.0), len(shapes[host, node]))
    for (host, node, words), n in shown.items():
        if n >= max(style_tree.SEEN, style_tree.COMMON * holders[host, 0]):
            want[host, node, style_tree._digest(words)] = (1 - math.log(n, holders[host, node]), None)
    assert set(got) == set(want) and len(want) > 20
    for key, (importance, presentations) in want.items():
        assert got[key][1] == presentations and got[key][0] == pytest.approx(importance, abs=1e-9)


def test_planted_menus_are_found_without_the_lists(spark):
    rng = random.Random(9)
    pages = [x for host, n in (("a.x", 10), ("b.x", 40), ("c.x", 300)) for x in site(rng, host, n)]
    rows = [(i, url, html) for i, (url, html, *_) in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in style_tree.main_texts(spark.createDataFrame(rows, KIND), lists=False).collect()}
    removed = wrong = planted = 0
    for i, (_, _, article, noise) in enumerate(pages):
        gone = Counter(article + noise) - Counter(got[i].split("\n"))
        planted += len(noise)
        removed += sum((gone & Counter(noise)).values())
        wrong += sum((gone - Counter(noise)).values())
    print(f"recall {removed / planted:.3f}, wrongly removed {wrong}")
    assert removed / planted > 0.9 and wrong == 0


def test_a_branch_goes_whole_and_rare_content_stays():
    found, tree = style_tree.blocks("<div><ul><li>one<li>two<li>three</ul><p>text</p></div>")
    path = {w: tree[e][1] for e, w in found}
    item = lambda w, v: ((path[w], style_tree._digest(w)), (v, None))
    up = tree[tree[found[0][0]][0]][1]
    low = dict([item("one", 0.0), item("two", 0.0), item("three", 0.3), ((up, None), (0.0, 1))])
    assert style_tree.kept_blocks(found, tree, low) == ["text"]  # the fence of 0.3 goes with its branch
    assert style_tree.kept_blocks(found, tree, {**low, (up, None): (1.0, 9)}) == ["three", "text"]  # varied presentations keep it
    low.pop(item("three", 0)[0])
    assert style_tree.kept_blocks(found, tree, low) == ["three", "text"]  # shown by few pages
    everything = dict(item(w, 0.0) for _, w in found)
    assert style_tree.kept_blocks(found, tree, everything) == ["one", "two", "three", "text"]
    assert style_tree.kept_blocks([], [(-1, 0)], low) == []


def test_closed_and_open_raw_elements():
    text = lambda page: [w for _, w in style_tree.blocks(page)[0]]
    assert text("<p>a<svg/>b</p>") == ["ab"]
    assert text("<p>a<script/>var x<b>1</b></script>c</p>") == ["ac"]
    assert text("<p>a<iframe/>x") == ["a"]
    start = time.perf_counter()
    assert len(text("<p>a<svg/>" * 100_000)) == 100_000
    assert time.perf_counter() - start < 20


def test_empty_pages_and_extra_columns(spark):
    rows = [(1, None, None, "x"), (None, "", "", "y"), (1, "http://h/", "<p>a", None), (1, "http://h/", "<p>a", None)]
    got = style_tree.main_texts(spark.createDataFrame(rows, KIND + ", low string")).collect()
    assert sorted(r["text"] for r in got) == ["", "", "a", "a"] and sum(r["n_chars"] for r in got) == 2


def test_with_the_lists_the_trees_remove_what_no_list_names(spark, monkeypatch):
    rng = random.Random(10)
    pages = [x for host, n in (("a.x", 12), ("b.x", 40)) for x in site(rng, host, n)]
    df = spark.createDataFrame([(i, url, html) for i, (url, html, *_) in enumerate(pages)], KIND)
    with_trees = {r["page_id"]: r["text"] for r in style_tree.main_texts(df).collect()}
    trees = style_tree.style_trees
    monkeypatch.setattr(style_tree, "style_trees", lambda pages, lists: trees(pages, lists).limit(0))
    without = {r["page_id"]: r["text"] for r in style_tree.main_texts(df).collect()}
    for i, (_, _, article, noise) in enumerate(pages):
        assert Counter(without[i].split("\n")) == Counter(article + noise)
        assert not Counter(article) - Counter(with_trees[i].split("\n"))
    assert sum(len(with_trees[i].split("\n")) for i in with_trees) < sum(len(article) + 1 for _, _, article, _ in pages)
