"""Nearest neighbours by inner product through robust-pruned directed graphs, one per shard.

Equal vectors are one point that knows its smallest ids, as many as a result can show. Points are dealt to bands
of length, each up to twice as long as its shortest point, and within a band by a hash to shards of about SHARD
points. Each shard becomes a graph of DEGREE edges per node: points arrive in
batches, a greedy search over the graph so far proposes neighbours, and pruning keeps the near ones
that no kept one covers: a candidate goes where a kept neighbour is nearer to it by more than the
factor SPREAD. Edges are added backwards as well, and full nodes are pruned the same way. An extra coordinate
makes all points of a shard equally long, so that near means a large inner product. Within a band it leaves the
points' own distances well above single precision, however long the points of other bands are.

Graphs are stored. Every query then visits every shard: in each, a beam of BEAM nodes is expanded until
none of it is unexpanded, and the beam's points are scored in double precision on the vectors as given. Queries
stream past a shard's graph, in salted shares of QUERIES, so neither side is gathered. A shard no larger than
the beam is scanned whole. Recall on the test tables is measured in the tests and the README.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of
other lengths form shards of their own. Rows that repeat id and vector count once. A null id takes no part. An
empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmart.llm.blobs import pack, unpack
from eventmart.llm.common import stored

DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
SPREAD = 1.2
SHARD = 1 << 14
QUERIES = 4096     # of one share of a shard
TOGETHER = 256     # queries or points searched at once
EXPANDED = 4       # nodes of each beam expanded at once


def usable(vectors, id_col="vec_id", vector_col="embedding"):
    """vec_id, vector (doubles) of the rows that take part, each once."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(fine).dropDuplicates(["vec_id", "vector"])


def beam_search(points, graph, start, queries, beam):
    """(ids, inner products) of the best `beam` nodes found for each query, best first; missing ones are -1."""
    m, n = len(queries), len(points)
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = seen[:, start] = True
    ids = np.full((m, beam), n)
    score = np.full((m, beam), -np.inf, np.float32)
    ids[:, 0], score[:, 0] = start, queries @ points[start]
    open_ = np.zeros((m, beam), bool)
    open_[:, 0] = True
    active = np.arange(m)
    while len(active):
        a = active[:, None]
        ranked = np.argsort(~open_[active], axis=1, kind="stable")[:, :EXPANDED]  # beams are sorted, so the best open ones
        is_open = open_[a, ranked]
        nodes = np.where(is_open, ids[a, ranked], n)
        open_[a, ranked] = False
        near = np.sort(graph[nodes].reshape(len(active), -1), axis=1)
        new = ~seen[a, near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[a, near] = True
        r, c = np.nonzero(new)
        found = np.full(near.shape, -np.inf, np.float32)
        found[r, c] = np.einsum("ij,ij->i", points[near[r, c]], queries[active[r]])
        all_score = np.concatenate([score[active], found], axis=1)
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_open = np.concatenate([open_[active], new], axis=1)
        best = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        score[active], ids[active] = np.take_along_axis(all_score, best, 1), np.take_along_axis(all_ids, best, 1)
        open_[active] = np.take_along_axis(all_open, best, 1) & np.isfinite(score[active])
        active = active[open_[active].any(axis=1)]
    ids[~np.isfinite(score)] = -1
    return ids, score


def pruned(points, owners, candidates, degree=DEGREE):
    """Up to `degree` diverse neighbours for each owner out of its candidates (missing ones are -1)."""
    n = len(points)
    length = float(points[0] @ points[0])
    candidates = np.where((candidates < 0) | (candidates == owners[:, None]), n, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
    there = candidates < n
    vectors = points[np.minimum(candidates, n - 1)]
    distance = 2 * (length - np.einsum("ijk,ik->ij", vectors, points[owners]))
    distance[~there] = np.inf
    order = np.argsort(distance, axis=1, kind="stable")
    candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    alive = np.isfinite(distance)
    result = np.full((len(owners), degree), n)
    rows = np.arange(len(owners))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        result[some, k] = candidates[rows[some], first[some]]
        picked = vectors[rows, first]
        between = 2 * (length - np.einsum("ijk,ik->ij", vectors, picked))
        alive &= ~(SPREAD * SPREAD * between <= distance)
        alive[rows, first] = False
        alive[~some] = False
    return result


def lengthened(vectors):
    """Vectors with one more coordinate that makes them equally long, in single precision."""
    vectors = vectors / np.abs(vectors).max()  # so that squares neither overflow nor vanish
    squares = (vectors ** 2).sum(1)
    extra = np.sqrt(np.maximum(squares.max() - squares, 0))
    scale = 1 / np.sqrt(squares.max())
    return (np.concatenate([vectors, extra[:, None]], axis=1) * scale).astype(np.float32)


def build_graph(vectors):
    """(graph, start): neighbours per node, with the number of nodes for a missing one."""
    points, n = lengthened(vectors), len(vectors)
    graph = np.full((n + 1, DEGREE), n, np.int64)
    order = np.random.Generator(np.random.PCG64(3)).permutation(n)
    start = int(np.argmax(points @ points.mean(0)))
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        batch = order[done:done + min(max(done, 16), TOGETHER)]
        ids, _ = beam_search(points, graph, start, points[batch], BUILD_BEAM)
        if done <= BUILD_BEAM:  # at first, all that is there
            ids = np.concatenate([ids, np.broadcast_to(order[:done], (len(batch), done))], axis=1)
        graph[batch] = pruned(points, batch, ids)
        source = np.repeat(batch, DEGREE)
        target = graph[batch].ravel()
        source, target = source[target < n], target[target < n]
        # each target takes its nearest new sources, as many as a node has edges
        near = np.einsum("ij,ij->i", points[source], points[target])
        by = np.lexsort((-near, target))
        source, target = source[by], target[by]
        owners, first = np.unique(target, return_index=True)
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        few = place < DEGREE
        arrived = np.full((len(owners), DEGREE), -1)
        arrived[np.searchsorted(owners, target[few]), place[few]] = source[few]
        graph[owners] = pruned(points, owners, np.concatenate([graph[owners], arrived], axis=1))
        done += len(batch)
    return graph, start


def search(vectors, points, graph, start, queries, beam=BEAM):
    """Ids of the points found for each query (missing ones are -1)."""
    n = len(vectors)
    if n <= beam:
        return np.broadcast_to(np.arange(n), (len(queries), n))
    queries = queries / np.abs(queries).max(axis=1, keepdims=True)  # a query's length does not change its order
    asked = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    return np.concatenate([beam_search(points, graph, start, asked[i:i + TOGETHER], beam)[0] for i in range(0, len(asked), TOGETHER)])


def band():
    """Number of the band of length of the column `vector`: log2 of the length, to the nearest whole number, so that
    vectors scaled to length 1 lie in the middle of a band."""
    longest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / longest) * (x / longest))
    return F.round(F.log2(longest) + F.log2(squares) / 2).cast("int")


def index_table(points, places):
    """dim, band, shard, graph (blob): one row per shard, stored."""
    def build(table):
        vectors = np.array(table.column("vector").to_pylist(), np.float64)
        ids = table.column("ids").to_pylist()
        graph, start = build_graph(vectors) if len(vectors) > BEAM else (np.zeros((0, DEGREE), np.int64), 0)
        blob = pack(np.array(vectors.shape), vectors.ravel(), graph.astype(np.int32).ravel(), np.array([start]),
                    np.cumsum([0, *map(len, ids)]), np.array([x for i in ids for x in i], np.int64))
        return pa.table({"dim": table.column("dim")[:1], "band": table.column("band")[:1], "shard": table.column("shard")[:1], "graph": pa.array([blob], pa.binary())})

    dealt = points.join(places, ["dim", "band"]).withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    rows = dealt.select("dim", "band", "shard", "vector", "ids")
    return stored(rows.groupBy("dim", "band", "shard").applyInArrow(build, "dim int, band int, shard int, graph binary"), "graphs")


FOUND = [("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]


def _answers(graph, query_ids, keys, queries, k):
    vectors, points, edges, start, first, ids = graph
    found = search(vectors, points, edges, start, queries)
    out = [[], [], [], []]
    for i in range(len(queries)):
        near = found[i][found[i] >= 0]
        score = np.array([np.dot(vectors[j], queries[i]) for j in near])
        candidates = np.concatenate([ids[first[j]:first[j + 1]] for j in near]) if len(near) else near
        score = np.repeat(score, first[near + 1] - first[near])
        other = candidates != query_ids[i]
        candidates, score = candidates[other], score[other]
        best = np.lexsort((candidates, -score))[:k]
        out[0].append(np.full(len(best), query_ids[i]))
        out[1].append(np.full(len(best), keys[i]))
        out[2].append(candidates[best])
        out[3].append(score[best])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, (_, t) in zip(out, FOUND)], [n for n, _ in FOUND])


def nearest(vectors, is_query, k=20, id_col="vec_id", vector_col="embedding", shard=SHARD):
    """The k nearest other rows of each row for which the column `is_query` holds: query_id, rank, vec_id, score."""
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("n", smallest).where(F.col("n") <= k + 1)  # a query may be one of them
    points = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = stored(points.withColumn("dim", F.size("vector")).withColumn("band", band()), "points")
    places = stored(points.groupBy("dim", "band").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")), "places")
    index = index_table(points, places)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query_key"), "vector", F.size("vector").alias("dim"))
    shares = -(-queries.count() // QUERIES) or 1
    share = F.pmod(F.xxhash64("query_id", "query_key"), F.lit(shares)).cast("int")
    asked = queries.join(places, "dim").select(
        "dim", "band", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), share.alias("share"), F.lit(1).alias("kind"),
        F.lit(None).cast("binary").alias("graph"), "query_id", "query_key", "vector")
    known = index.select(
        "dim", "band", "shard", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("kind"), "graph",
        F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("long").alias("query_key"), F.lit(None).cast("array<double>").alias("vector"))
    place = ["dim", "band", "shard", "share"]
    met = known.unionByName(asked).repartition(*place).sortWithinPartitions(*place, "kind")

    def answer(batches):
        graph = at = None
        for batch in batches:
            where = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
            kind = batch.column(4).to_pylist()
            i = 0
            while i < len(where):
                if kind[i] == 0:
                    shape, flat, edges, start, first, ids = unpack(batch.column(5)[i].as_buffer())
                    flat = flat.reshape(shape)
                    graph, at = (flat, lengthened(flat), edges.reshape(-1, DEGREE).astype(np.int64), int(start[0]), first, ids), where[i]
                    i += 1
                    continue
                upto = i
                while upto < len(where) and kind[upto] == 1 and where[upto] == where[i] and upto - i < TOGETHER:
                    upto += 1
                if where[i] == at:
                    asked_ = np.array(batch.column(8)[i:upto].to_pylist(), np.float64)
                    yield _answers(graph, batch.column(6)[i:upto].to_numpy(), batch.column(7)[i:upto].to_numpy(), asked_, k)
                i = upto

    found = met.mapInArrow(answer, "query_id long, query_key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
