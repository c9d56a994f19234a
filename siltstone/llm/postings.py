"""Nearest neighbours by balanced posting lists.

Fit, on a bounded sample (``SAMPLE`` vectors, spread by hash): the sample is halved again and again along the
line between two means, so that all leaves have the same number of sample vectors; leaf means are the centroids
of the posting lists. There is one list for some ``LIST_ROWS`` vectors, ``MOST_LISTS`` at most, so lists grow
beyond that; a list of more than ``PART_ROWS`` rows is searched in parts by different tasks. Centroids are linked
to their ``LINKS`` nearest ones; that graph is sent to all tasks (its size is bounded by ``MOST_LISTS``) and
searched best first, from entries spread over the leaves.

Index: every vector is in its nearest list, and a boundary vector also in up to ``COPIES - 1`` further ones whose
centroids are at most ``NEAR`` times as far. Search: a query reads the lists whose centroids are at most ``reach``
times as far as its nearest; the graph search is widened until it has met a centroid beyond that, so the ratio
alone decides how many lists are read. The ratio is fitted: it is the one that reaches ``RECALL`` of the true
neighbours of ``TRIALS`` sample vectors within the sample, so it is small for vectors in separate groups and large
for vectors without structure. Scores are computed from the original vectors in double precision.

Equal vectors are one entry of the index with their ``KEPT`` smallest ids, which is all that ten neighbours can
need (a query may be one of them): thousands of copies cost one entry, and queries with one vector are searched
once. Nothing is limited before that which could be in a result.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without id, take no part;
nor do vectors of another length than the most frequent (the smallest of several such). Repeated rows of one id
are candidates as often as they occur; rows with the query's id are none; a repeated query is answered once. Ties
go to the smaller id. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.shared import written

TOP, EVERY = 10, 100
#: Ids kept of equal vectors: ten, and the query itself.
KEPT = TOP + 1
#: Vectors to fit from, vectors to a list, and the most lists.
SAMPLE, LIST_ROWS, MOST_LISTS = 65_536, 400, 4_096
#: Lists a vector is in at most, and how much further their centroids may be.
COPIES, NEAR = 2, 1.02
#: Share of the sample's true neighbours that a search has to reach, and sample queries to fit the reach on.
RECALL, TRIALS = 0.97, 256
#: Links of a centroid, entries of a walk, and centroids that a walk keeps: to place a vector, and to begin a search.
LINKS, ENTRIES, PLACE_BEAM, SEARCH_BEAM = 16, 16, 8, 64
#: Rows of a list, or queries at it, that one task takes.
PART_ROWS = 20_000
#: Vectors that are walked through the graph together.
WALK = 1_024
SEED = 7

FOUND = "q1 long, q2 long, k1 long, k2 long, score double, ids array<long>"
RESULT = "query_id long, rank int, vec_id long, score double"


# Fit --------------------------------------------------------------------------------------------


@dataclass
class Graph:
    """Centroids, their nearest centroids, and where a walk begins."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def _halves(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size on the two sides of a line between two means."""
    a, b = x[rng.choice(len(x), 2, replace=False)]
    order = np.arange(len(x))
    for _ in range(6):
        order = np.argsort(x @ (b - a), kind="stable")
        a, b = x[order[:len(x) // 2]].mean(0), x[order[len(x) // 2:]].mean(0)
    return order[:len(x) // 2], order[len(x) // 2:]


def fit(sample: np.ndarray, lists: int) -> Graph:
    """A graph of ``lists`` centroids (a power of two, no more than the sample has vectors)."""
    rng = np.random.default_rng(SEED)
    leaves = [np.arange(len(sample))]
    while 2 * len(leaves) <= min(lists, len(sample)):
        leaves = [leaf[half] for leaf in leaves for half in _halves(sample[leaf], rng)]
    centroids = np.stack([sample[leaf].mean(0) for leaf in leaves]).astype(np.float32)
    square = (centroids ** 2).sum(1)
    links = np.empty((len(centroids), min(LINKS, len(centroids))), np.int32)
    for low in range(0, len(centroids), WALK):
        part = centroids[low:low + WALK]
        links[low:low + WALK] = np.argsort(square - 2 * part @ centroids.T, axis=1, kind="stable")[:, :links.shape[1]]
    entries = np.unique(np.linspace(0, len(centroids) - 1, min(ENTRIES, len(centroids))).astype(np.int32))
    return Graph(centroids, links, entries)


def walk(graph: Graph, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroids that a best-first walk meets, nearest first, and their distances."""
    n, k = len(x), len(graph.centroids)
    beam = min(beam, k)
    x = x.astype(np.float32)
    square, own = (graph.centroids ** 2).sum(1), (x ** 2).sum(1)[:, None]

    def far(nodes, rows):
        return np.maximum(square[nodes] - 2 * np.matmul(graph.centroids[nodes], x[rows, :, None])[:, :, 0] + own[rows], 0)

    def nearest(nodes, dist, done):
        best = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
        return tuple(np.take_along_axis(c, best, 1) for c in (nodes, dist, done))

    rows = np.arange(n)
    seen = np.zeros((n, k), bool)
    seen[:, graph.entries] = True
    nodes = np.hstack([np.broadcast_to(graph.entries, (n, len(graph.entries))), np.zeros((n, beam), np.int32)])
    dist = np.hstack([far(nodes[:, :len(graph.entries)], rows), np.full((n, beam), np.inf, np.float32)])
    nodes, dist, done = nearest(nodes, dist, np.zeros(nodes.shape, bool))
    while len(rows):
        # The nearest centroid not looked at yet brings in its links; a walk ends when its whole beam is done.
        ahead = np.where(done[rows], np.inf, dist[rows])
        pick = ahead.argmin(1)
        more = np.isfinite(ahead[np.arange(len(rows)), pick])
        rows, pick = rows[more], pick[more]
        done[rows, pick] = True
        links = graph.links[nodes[rows, pick]]
        met = seen[rows[:, None], links]
        seen[rows[:, None], links] = True
        away = far(links, rows)
        away[met] = np.inf
        nodes[rows], dist[rows], done[rows] = nearest(
            np.hstack([nodes[rows], links]), np.hstack([dist[rows], away]), np.hstack([done[rows], np.zeros(links.shape, bool)])
        )
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.sqrt(np.take_along_axis(dist, order, 1))


def lists_within(graph: Graph, x: np.ndarray, ratio: float, most: int | None, beam: int):
    """(row, list) for the nearest list of each vector and those at most ``ratio`` times as far."""
    out, todo = [], np.arange(len(x))
    while len(todo):
        later = []
        for low in range(0, len(todo), WALK):
            rows = todo[low:low + WALK]
            nodes, dist = walk(graph, x[rows], beam)
            inside = dist <= ratio * dist[:, :1]
            inside[:, 0] = True
            if most is None and beam < len(graph.centroids):
                # All of the beam is within reach: there may be more.
                wider = inside.all(1) & np.isfinite(dist[:, -1])
                later.append(rows[wider])
                inside[wider] = False
            if most is not None:
                inside[:, most:] = False
            r, c = np.nonzero(inside & np.isfinite(dist))
            out.append((rows[r], nodes[r, c]))
        todo = np.concatenate(later) if later else todo[:0]
        beam *= 2
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


def fitted_reach(graph: Graph, sample: np.ndarray) -> float:
    """The ratio of distances to centroids that reaches ``RECALL`` of the true neighbours within the sample."""
    if len(sample) < 2:
        return 1.0
    rows, lists = lists_within(graph, sample, NEAR, COPIES, PLACE_BEAM)
    order = np.argsort(rows, kind="stable")
    rows, lists = rows[order], lists[order]
    first = np.searchsorted(rows, np.arange(len(sample)))
    last = np.searchsorted(rows, np.arange(len(sample)), "right") - 1
    square, centre, needed = (sample ** 2).sum(1), graph.centroids.astype(float), []
    for q in np.unique(np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int)):
        away = square - 2 * sample @ sample[q]
        away[q] = np.inf
        true = np.argpartition(away, min(TOP, len(away) - 1) - 1)[:TOP]
        far = np.sqrt(((centre - sample[q]) ** 2).sum(1))
        best = np.minimum(far[lists[first[true]]], far[lists[last[true]]])
        needed.append(best / max(far.min(), 1e-300))
    return float(np.quantile(np.concatenate(needed), RECALL))


# Spark ------------------------------------------------------------------------------------------


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding and a key of it, of the rows that take part."""
    e = F.col("embedding")
    whole = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(e, lambda c: c != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & whole)
    size = F.size(e)
    usual = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").limit(1).select("size").scalar()
    keys = F.xxhash64(e).alias("k1"), F.xxhash64(F.lit(1), F.reverse(e)).alias("k2")
    return rows.where(size == usual).select("vec_id", *keys, "embedding")


def entries(rows: DataFrame) -> DataFrame:
    """Distinct vectors with their smallest ids; ``asked`` if one of all their ids is a query."""
    key = ["k1", "k2"]
    each = rows.groupBy(*key, "vec_id").agg(F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    asked = (F.col("vec_id") % EVERY == 0)
    least = each.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))).where(F.col("nth") <= KEPT)
    copies = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "n"))), lambda s: F.array_repeat(s["vec_id"], F.least(s["n"], F.lit(KEPT)).cast("int"))))
    kept = least.groupBy(*key).agg(F.first("embedding").alias("embedding"), copies.alias("ids"))
    queries = rows.where(asked).select(*key).distinct().withColumn("asked", F.lit(True))
    return kept.join(queries, key, "left").withColumn("asked", F.coalesce("asked", F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _assigned(graph, ratio: float, most: int | None, beam: int):
    def assign(batches):
        for b in batches:
            if b.num_rows:
                rows, lists = lists_within(graph.value, _matrix(b.column("embedding")), ratio, most, beam)
                yield b.take(pa.array(rows)).append_column("list", pa.array(lists.astype(np.int32)))

    return assign


def _parts(rows: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Rows of a list in as many parts as it needs, each once for every part of the other side."""
    part = F.pmod(F.xxhash64("k1", F.lit(own)), F.col(own)).cast("int")
    return rows.join(F.broadcast(sizes), "list").withColumn(f"{own}_part", part).withColumn(
        f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    ).drop(own, other)


def _nearest(queries: pa.Table, posted: pa.Table) -> pa.Table:
    """The nearest entries of one part of a list for the queries at it, by score, then smallest id."""
    schema = pa.schema([("q1", pa.int64()), ("q2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
    if not len(queries) or not len(posted):
        return schema.empty_table()
    q, x = _matrix(queries["embedding"]), _matrix(posted["embedding"])
    square, least = (x ** 2).sum(1), np.array([ids[0].as_py() for ids in posted["ids"]])
    rows, entries_, scores = [], [], []
    for low in range(0, len(q), 256):
        part = q[low:low + 256]
        own = (part ** 2).sum(1)[:, None]
        rough = square - 2 * part @ x.T + own
        k = min(KEPT, len(x)) - 1
        bound = np.partition(rough, k, axis=1)[:, k:k + 1] + 1e-9 * (own + square.max())
        for i, at in enumerate(np.flatnonzero(r) for r in rough <= bound):
            score = np.sqrt(((x[at] - part[i]) ** 2).sum(1))
            order = np.lexsort((least[at], score))[:KEPT]
            rows.append(np.full(len(order), low + i))
            entries_.append(at[order])
            scores.append(score[order])
    rows, entries_ = pa.array(np.concatenate(rows)), pa.array(np.concatenate(entries_))
    return pa.Table.from_arrays(
        [*(queries[name].take(rows) for name in ("k1", "k2")), *(posted[name].take(entries_) for name in ("k1", "k2")), pa.array(np.concatenate(scores)), posted["ids"].take(entries_)],
        schema=schema,
    )


def nearest(embeddings: DataFrame, list_rows: int = LIST_ROWS, reach: float | None = None) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by ``EVERY``; ``reach`` is fitted if not given."""
    spark = embeddings.sparkSession
    rows = written(vectors(embeddings), "vectors")
    index = written(entries(rows), "entries")
    n = index.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    share = SAMPLE / n
    sample = index if share >= 1 else index.where(F.pmod(F.xxhash64("k2"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sample.orderBy("k1", "k2").select("embedding").toArrow()
    lists = min(MOST_LISTS, max(1, n // list_rows), max(1, len(sample)))
    sample = _matrix(sample["embedding"])
    graph = fit(sample, 1 << (lists.bit_length() - 1))
    reach = fitted_reach(graph, sample) if reach is None else reach
    graph = spark.sparkContext.broadcast(graph)

    held = "k1 long, k2 long, embedding array<double>, ids array<long>, list int"
    posted = index.select("k1", "k2", "embedding", "ids").mapInArrow(_assigned(graph, NEAR, COPIES, PLACE_BEAM), held)
    posted = written(posted, "postings")
    asked = index.where("asked").select("k1", "k2", "embedding").mapInArrow(_assigned(graph, reach, None, SEARCH_BEAM), "k1 long, k2 long, embedding array<double>, list int")
    asked = written(asked, "asked")

    def parts(side, name):
        return side.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias(name))

    sizes = written(parts(posted, "p").join(parts(asked, "q"), "list"), "sizes")
    where = ["list", "p_part", "q_part"]
    left = _parts(asked, sizes, "q", "p").groupBy(*where)
    right = _parts(posted, sizes, "p", "q").groupBy(*where)
    found = left.cogroup(right).applyInArrow(_nearest, FOUND)

    # Of each distinct query vector the nearest entries, then of each query the nearest rows.
    query = ["q1", "q2"]
    by_score = Window.partitionBy(*query).orderBy("score", F.col("ids")[0])
    best = found.dropDuplicates([*query, "k1", "k2"]).withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= KEPT)
    best = best.groupBy(*query).agg(F.collect_list(F.struct("score", "ids")).alias("best"))
    asking = rows.where(F.col("vec_id") % EVERY == 0).select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("vec_id").alias("query_id")).distinct()
    answers = asking.join(best, query).select(*query, "query_id", F.explode("best").alias("b"))
    answers = answers.select(*query, "query_id", F.col("b.score").alias("score"), F.explode("b.ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", *query).orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= TOP).select("query_id", "rank", "vec_id", "score")
