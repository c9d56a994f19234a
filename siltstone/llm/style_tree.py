"""Main text of web pages by site style trees.

Every page is read into a tree of its block elements (tag and class) with blocks of text. The trees of a host's
pages are merged: a path of elements is a node. Its presentations are the sequences of its child elements, its
content the texts of its own blocks. With m the number of distinct pages that have the node, all by entropy:

* a presentation is as important as -sum p log p to the base m, p the share of the presentation among those seen (1 if m is 1);
* a content that n of the m pages show is 1 - log n / log m important (its pages share it evenly): 0 if all show it, 1 if one does.

In a page, importance is composed from the leaves up: a branch with l presentations in the host has
(1 - DAMP^l) of its node's importance and DAMP^l of the mean of its blocks and child branches. From the root
down, whole branches under ``LEAST`` are removed, and single blocks under it. A guard keeps content that few pages show:
a block can go only if ``SEEN`` pages and ``COMMON`` of the host's pages show it at its node, and a branch only if
all its blocks can. If nothing would be left of a page, it stays whole. Repeats inside a page count once, so what a
page says again and again is not taken for the site's.

Some branches are no article whatever they show: elements for menus, forms, scripts and so on, and
classes, ids and roles with the names of such parts (fixed lists below). If a page has article or main
elements, only they are read.

Reading is linear in the page: a scanner of tags, and one step per tag on a stack of open elements. A
paragraph ends where a block begins, unclosed elements end with their parents, and text after an open
comment or script is part of it. Character references are decoded.

Scale. Texts travel only inside their page's row. Hashes of the presentations and blocks of distinct pages are
written once, and counted by (host, node, hash) with map-side aggregation, so a host with a third of all pages is no
larger than its distinct contents. What goes to the pages of a host are the blocks that ``COMMON`` of its pages show and
the nodes that as many have: by that share, not more than a few times those of a mean page. They are broadcast to
the pages if they are few (checked), else joined by host.

Defined cases: a null or empty html has an empty text. A null url has an empty host of its own. Pages of a host
with equal html count once, pages without a block don't count. Ids may be null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import checked_broadcast, small_batches, written

LEAST, SEEN, COMMON, DAMP = 0.2, 8, 0.7, 0.9

# Fixed lists of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN = frozenset(("svg", "math"))  # here <svg/> has an end; <script/> and the like have none
RAW = frozenset("script style noscript template textarea title iframe svg math xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img ruby rt rp br".split())
NO_ARTICLE = frozenset("head nav footer aside form button select option menu dialog fieldset object audio video canvas".split())
# Fixed lists of the names of parts that are no article.
PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer comment comments commentlist reply replies disqus cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations widget widgets toolbar pagination pager complementary contentinfo search dialog".split()
)
HEADERS = frozenset("header masthead topbar".split())

_TAG = re.compile(r"""<(?:!--|!|\?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)""")
_NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def blocks(page: str, lists: bool = True) -> tuple[list[tuple[int, str]], list[tuple[int, int]]]:
    """(element, text) of the blocks of a page in order, and (parent, path) of its elements.

    Without ``lists`` only what is never text is left out: the fixed parts and articles are not looked for.
    """
    out: list[tuple[int, str]] = []
    outside: list[tuple[int, str]] = []
    tree: list[tuple[int, int]] = [(-1, 0)]
    # Open elements: name, block element, left out, in an article, place of the open paragraph of this scope.
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, -1)]
    count: dict[str, int] = {}
    text: list[str] = []
    article = False

    def close():
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words and not stack[block[-1]][2]:
                at = block[-1]
                (out if stack[at][3] else outside).append((stack[at][1], words))

    block = [0]

    def pop():
        name = stack[-1][0]
        if block[-1] == len(stack) - 1:
            close()
            block.pop()
        stack.pop()
        count[name] -= 1

    at, n, last = 0, len(page), page.rfind(">") + 1
    while at < n:
        m = _TAG.search(page, at, last)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            end = page.find("-->", at) if m[0] == "<!--" else page.find(">", at)
            at = n if end < 0 else end + (3 if m[0] == "<!--" else 1)
        elif m[1] or m[4]:
            if name == "br":
                text.append(" ")
            elif count.get(name):
                if name not in INLINE:
                    close()
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name in VOID:
            if name in INLINE:
                text.append(" " if name == "br" else "")
            else:
                close()
        elif name in RAW:
            if name in FOREIGN and (m[3] or m[6] or "").endswith("/"):
                continue
            end = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = n if end is None else end.start()
            if end is not None:
                shut = page.find(">", at)
                at = n if shut < 0 else shut + 1
        else:
            inline = name in INLINE
            if not inline:
                close()
                if stack[-1][4] >= 0:  # a block ends the open paragraph
                    while len(stack) > stack[-1][4] + 1:
                        pop()
                    pop()
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
                pop()
            attributes = m[3] or m[6] or ""
            parent = stack[-1]
            label, out_now, inside = name, parent[2], parent[3] or (lists and name in ("article", "main"))
            if attributes:
                for kind, *values in _NAMES.findall(attributes):
                    value = "".join(values).lower()
                    if kind.lower() == "class":
                        label = f"{name}.{value}"
                    parts = set(_SPLIT.split(value)) if lists else set()
                    out_now = out_now or bool(parts & PARTS) or (not parent[3] and bool(parts & HEADERS))
            out_now = name == "head" or out_now or (lists and (name in NO_ARTICLE or (name == "header" and not parent[3])))
            article |= inside and not out_now
            element = parent[1]
            if not inline:
                tree.append((element, _digest(f"{tree[element][1]}>{label}")))
                element = len(tree) - 1
            scope = len(stack) if name == "p" else parent[4] if inline else -1
            stack.append((name, element, out_now, inside, scope))
            count[name] = count.get(name, 0) + 1
            if not inline:
                block.append(len(stack) - 1)
            elif out_now and not parent[2]:
                close()
                block.append(len(stack) - 1)
    close()
    return out if article else outside, tree


def branches(found: list[tuple[int, str]], tree: list[tuple[int, int]]) -> dict[int, list[int]]:
    """Children of every element that holds a block, deepest elements last: elements, and blocks as -1 - number, in page order."""
    children: dict[int, list[int]] = {0: []}
    for number, (element, _) in enumerate(found):
        line = [element]
        while line[-1] not in children:
            children[line[-1]] = []
            line.append(tree[line[-1]][0])
        for low, high in zip(line, line[1:]):
            children[high].append(low)
        children[element].append(-1 - number)
    return children


def _features(lists):
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("node", pa.int64()), ("content", pa.bool_()), ("feature", pa.int64())])

    def run(batches):
        for b in batches:
            rows = []
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, tree = blocks(page or "", lists)
                seen = dict.fromkeys((tree[e][1], True, _digest(words)) for e, words in found)
                for element, inner in branches(found, tree).items() if found else ():
                    shape = [tree[x][1] for x in inner if x >= 0]
                    shape = [x for k, x in enumerate(shape) if not k or shape[k - 1] != x]
                    seen[tree[element][1], False, _digest(",".join(map(str, shape)))] = None
                digest = _digest(page or "")
                rows += [(host, digest, *x) for x in seen]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)

    return run


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "little", signed=True)


def style_trees(pages: DataFrame, lists: bool = True) -> DataFrame:
    """(host, node, feature, importance, presentations) of the blocks and nodes that most pages of a host show.

    A node has no feature and the number of its presentations, a block has its content and none. ``pages``: host, html.
    """
    seen = pages.mapInArrow(_features(lists), "host string, page long, node long, content boolean, feature long")
    seen = written(seen.distinct(), "features")
    node = ["host", "node"]
    counts = seen.groupBy(*node, "content", "feature").agg(F.count("*").alias("n"))
    shapes = counts.filter("not content").groupBy(*node).agg(
        F.sum("n").alias("total"), F.sum(F.col("n") * F.ln("n")).alias("logs"), F.count("*").alias("presentations"))
    at_node = seen.filter("not content").select(*node, "page").distinct().groupBy(*node).agg(F.count("*").alias("m"))
    hosts = seen.filter("node = 0 and not content").select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    many = F.col("m") >= F.greatest(F.lit(SEEN), COMMON * F.col("pages"))
    nodes = written(shapes.join(at_node, node).join(hosts, "host").filter(many), "nodes")
    entropy = (F.ln("total") - F.col("logs") / F.col("total")) / F.ln("m")
    contents = counts.filter(F.col("content") & (F.col("n") >= SEEN)).join(nodes.select(*node, "m", "pages"), node)
    contents = contents.filter(F.col("n") >= COMMON * F.col("pages"))
    return nodes.select(*node, F.lit(None).cast("long").alias("feature"), F.least(entropy, F.lit(1.0)).alias("importance"), "presentations").union(
        contents.select(*node, "feature", 1 - F.ln("n") / F.ln("m"), F.lit(None).cast("long")))


def kept_blocks(found: list[tuple[int, str]], tree: list[tuple[int, int]], low: dict) -> list[str]:
    """Texts of a page's blocks without its branches of low importance; ``low``: (node, feature) to (importance, presentations)."""
    if not found or not low:
        return [words for _, words in found]
    children = branches(found, tree)
    block = [low.get((tree[e][1], _digest(words)), (None,))[0] for e, words in found]
    value: dict[int, float] = {}
    guard: dict[int, bool] = {}
    for element in sorted(children, reverse=True):  # an element comes after its parent
        inner = children[element]
        parts = [value[x] if x >= 0 else 1.0 if block[-1 - x] is None else block[-1 - x] for x in inner]
        mean = sum(parts) / len(parts)
        if any(x >= 0 for x in inner):
            own, shapes = low.get((tree[element][1], None), (1.0, 1))
            weight = DAMP ** shapes
            mean = (1 - weight) * own + weight * mean
        value[element] = mean
        guard[element] = all(guard[x] if x >= 0 else block[-1 - x] is not None for x in inner)
    gone: set[int] = set()
    for element in sorted(children):
        if (tree[element][0] in gone and element) or (guard[element] and value[element] < LEAST):
            gone.add(element)
    kept = [words for (e, words), importance in zip(found, block) if e not in gone and (importance is None or importance >= LEAST)]
    return kept or [words for _, words in found]


def _extract(lists):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            texts = []
            for page, low in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                low = {(x["node"], x["feature"]): (x["importance"], x["presentations"]) for x in low or ()}
                texts.append("\n".join(kept_blocks(*blocks(page or "", lists), low)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return run


def main_texts(pages: DataFrame, lists: bool = True) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars. Without ``lists`` by the style trees alone."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("host", host)
    small_batches(pages)
    low = written(style_trees(pages.select("host", "html"), lists), "low")
    n = low.count()
    kind = "struct<node: bigint, feature: bigint, importance: double, presentations: bigint>"
    joined = pages.withColumn("low", F.lit(None).cast(f"array<{kind}>"))
    if n:
        by_host = low.groupBy("host").agg(F.collect_list(F.struct("node", "feature", "importance", "presentations")).alias("low"))
        joined = pages.join(checked_broadcast(by_host, n), "host", "left")
    return joined.select("page_id", "url", "html", "low").mapInArrow(_extract(lists), "page_id long, url string, text string, n_chars long")
