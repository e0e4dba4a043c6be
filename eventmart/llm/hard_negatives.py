"""Hard negatives by exact inner-product search over lists that clusters of anchors share.

Anchors are clustered by direction. For a cluster with center c whose members lie within the angle b of it, no
candidate i scores higher with a member u than |u| |i| cos(max(0, angle(i, c) - b)). Candidates are sorted by this bound
once per cluster, and all members walk the one list together, each until the bound certifies that nothing better
can follow: first for its positives, then, knowing their scores, for the negatives of each. Scores are exact integers;
the bound carries a margin of a millionth for rounding.

Candidates are dealt by a hash to shards of about SHARD rows and anchors to shares of about SHARE; a task holds a shard
and a share, whatever the size of the table or of a label. What a shard finds for an anchor is merged by score and
id. Copies of one vector are spread by their ids like any other rows.

Defined results: rows with a null vec_id or label, a null vector, or a null or non-finite component take no part. Rows
that share a vec_id count once, as the smallest (label, vector). Only vectors of equal length are compared; zero and
empty vectors score 0. An anchor without positives, or a positive without negatives, gives no rows; so does a
positive of negative score. Inner products beyond 64 bits are an error. An empty table gives an empty result. Other
columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored

SHARD = 1 << 13     # candidates held by a task
SHARE = 1 << 13     # anchors held by a task
MEMBERS = 64        # aim for the anchors of a cluster
CLUSTERS = 256      # at most, in a share
TOGETHER = 256      # members that walk a list at once
FIRST, STEP = 64, 1024  # the walk's strides grow from one to the other
MARGIN = 1e-6
PLACE = ["dim", "shard", "share"]


def usable(vectors, id_col="vec_id", vector_col="embedding", label_col="label", scale=256):
    """vec_id, label, vector (floor(scale * x), as doubles), dim of the rows that take part, each id once."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(fine)
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))

    def grid(x):  # doubles from 2**53 on are whole numbers
        return F.when(F.abs(scale * x) < float(1 << 53), F.floor(scale * x).cast("double")).otherwise(scale * x)

    return one.select("vec_id", "row.label", F.transform("row.vector", grid).alias("vector"), F.size("row.vector").alias("dim"))


def matrix(column, dim):
    """The vectors of an Arrow column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64)


def _unit(rows):
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def cluster_numbers(vectors, rounds=8):
    """A cluster for each vector, by spherical k-means from evenly spaced members; deterministic."""
    k = int(np.clip(len(vectors) // MEMBERS, 1, CLUSTERS))
    units = _unit(vectors)
    centers = units[np.arange(k) * len(units) // k]
    for _ in range(rounds):
        number = np.argmax(units @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, number, units)
        kept = np.linalg.norm(sums, axis=1) > 0
        centers[kept] = _unit(sums)[kept]
    return np.argmax(units @ centers.T, axis=1)


def scores(left, right):
    """Inner products of all pairs, exactly, as 64-bit integers."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if most < 1 << 53:
        return (left @ right.T).astype(np.int64)
    if not most < 1 << 62:
        raise ValueError("an inner product may exceed 64 bits")
    return np.einsum("id,jd->ij", left.astype(np.int64), right.astype(np.int64))


def shared_list(candidates, ids, members):
    """(order, bounds): candidates by falling bound on what any member scores per unit of its length."""
    length = np.linalg.norm(candidates, axis=1)
    directions = _unit(members)
    center = _unit(directions.sum(axis=0, keepdims=True))[0]
    wide = np.arccos(np.clip(directions[np.any(directions, axis=1)] @ center, -1, 1)).max(initial=0)
    off = np.arccos(np.clip(np.divide(candidates @ center, length, out=np.ones_like(length), where=length > 0), -1, 1))
    bound = length * (np.cos(np.maximum(0, off - wide)) + MARGIN)
    order = np.lexsort((ids, -bound))
    return order, bound[order]


class Best:
    """The k best (score, id) of each row, by falling score and rising id. Rows are members, or members' positives."""

    def __init__(self, rows, k):
        self.score = np.full((rows, k), -np.iinfo(np.int64).max)  # its negative is a number too
        self.id = np.full((rows, k), np.iinfo(np.int64).max)

    def add(self, rows, score, ids, fits):
        """Take in scores (rows x candidates) where `fits`."""
        worst, worst_id = self.score[rows, -1:], self.id[rows, -1:]
        fits = fits & ((score > worst) | ((score == worst) & (ids < worst_id)))
        for i in np.flatnonzero(fits.any(axis=1)):
            s = np.concatenate([self.score[rows[i]], score[i, fits[i]]])
            n = np.concatenate([self.id[rows[i]], ids[fits[i]]])
            best = np.lexsort((n, -s))[:self.score.shape[1]]
            self.score[rows[i]], self.id[rows[i]] = s[best], n[best]

    def full(self, rows):
        return self.id[rows, -1] < np.iinfo(np.int64).max


def walk(order, bounds, lengths, done, visit):
    """Members walk a list until they are certified. `visit(active, part)` looks at the part of the list for the active
    members; `done(active, upper)` tells who needs nothing that scores `upper` or less. Returns rows looked at."""
    active, at, step, looked = np.arange(len(lengths)), 0, FIRST, 0
    while len(active) and at < len(order):
        part = order[at:at + step]
        visit(active, part)
        looked += len(active) * len(part)
        at, step = at + step, min(2 * step, STEP)
        if at < len(order):
            active = active[~done(active, lengths[active] * bounds[at])]
    return looked


def _by_cluster(anchors):
    """(rows of the anchors) of at most TOGETHER members of one cluster."""
    number = anchors.column("cluster").to_numpy()
    order = np.argsort(number, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
        for i in range(0, len(members), TOGETHER):
            yield members[i:i + TOGETHER]


def _sides(candidates, anchors):
    dim = anchors.column("dim")[0].as_py()
    return (matrix(candidates.column("vector"), dim), *[candidates.column(c).to_numpy() for c in ("vec_id", "label")],
            matrix(anchors.column("vector"), dim), *[anchors.column(c).to_numpy() for c in ("vec_id", "label")])


def positives_in(candidates, anchors, k):
    """(anchor_id, positive_id, positive_score): the k best rows of the anchors' labels among the candidates."""
    out = [np.zeros(0, np.int64)] * 3
    if len(candidates) and len(anchors):
        rows, ids, labels, vectors, anchor_ids, anchor_labels = _sides(candidates, anchors)
        found = []
        for members in _by_cluster(anchors):
            mine, best = vectors[members], Best(len(members), k)
            order, bounds = shared_list(rows, ids, mine)

            def visit(active, part):
                fits = (anchor_labels[members[active], None] == labels[part]) & (anchor_ids[members[active], None] != ids[part])
                best.add(active, scores(mine[active], rows[part]), ids[part], fits)

            def done(active, upper):
                return best.full(active) & (upper < best.score[active, -1])

            walk(order, bounds, np.linalg.norm(mine, axis=1), done, visit)
            m, j = np.nonzero(best.id < np.iinfo(np.int64).max)
            found.append((anchor_ids[members[m]], best.id[m, j], best.score[m, j]))
        out = [np.concatenate(c) for c in zip(*found)]
    return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), map(pa.array, out))))


def negatives_in(candidates, anchors, k, low):
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): for each positive, the k best rows of other
    labels that score from `low` percent of it up to it."""
    out = [np.zeros(0, np.int64)] * 5
    if len(candidates) and len(anchors):
        rows, ids, labels, vectors, anchor_ids, anchor_labels = _sides(candidates, anchors)
        sought = anchors.column("positives").to_pylist()
        found = []
        for members in _by_cluster(anchors):
            mine, width = vectors[members], max(len(sought[i]) for i in members)
            goal = np.full((len(members), width), -1)  # a negative score has no negatives
            name = np.zeros((len(members), width), np.int64)
            for m, i in enumerate(members):
                for j, p in enumerate(sought[i]):
                    name[m, j], goal[m, j] = p["positive_id"], p["positive_score"]
            best = [Best(len(members), k) for _ in range(width)]
            order, bounds = shared_list(rows, ids, mine)

            def visit(active, part):
                score = scores(mine[active], rows[part])
                other = anchor_labels[members[active], None] != labels[part]
                for j in range(width):
                    p = goal[active, j, None]
                    best[j].add(active, score, ids[part], other & (score <= p) & (score >= -(-low * p // 100)) & (p >= 0))

            def done(active, upper):
                ready = np.ones(len(active), bool)
                for j in range(width):
                    p = goal[active, j]
                    certified = best[j].full(active) & (upper < best[j].score[active, -1])
                    ready &= certified | (p < 0) | (100 * upper < low * p)
                return ready

            walk(order, bounds, np.linalg.norm(mine, axis=1), done, visit)
            for j in range(width):
                m, i = np.nonzero(best[j].id < np.iinfo(np.int64).max)
                found.append((anchor_ids[members[m]], name[m, j], goal[m, j], best[j].id[m, i], best[j].score[m, i]))
        out = [np.concatenate(c) for c in zip(*found)]
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
    return pa.table(dict(zip(names, map(pa.array, out))))


def _clustered(share):
    """The anchors of a share with their cluster."""
    share = share.sort_by("vec_id")
    number = cluster_numbers(matrix(share.column("vector"), share.column("dim")[0].as_py()))
    return share.append_column("cluster", pa.array(number.astype(np.int32)))


def _met(candidates, anchors, cells, work, schema):
    """`work` for each shard of candidates and share of anchors of its dimension."""
    sides = [side.repartition(cells, *PLACE).groupBy(*PLACE) for side in (candidates, anchors)]
    return sides[0].cogroup(sides[1]).applyInArrow(work, schema)


def hard_negatives(vectors, is_anchor, label=None, positives=5, negatives=5, low=80, id_col="vec_id", vector_col="embedding",
                   label_col="label", shard=SHARD, share=SHARE):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` and `label` are columns over vec_id and label: which rows are anchors, and the label to use.
    """
    rows = usable(vectors, id_col, vector_col, label_col)
    if label is not None:
        rows = rows.withColumn("label", label.cast("long"))
    rows = stored(rows, "vectors")
    number = F.xxhash64("vec_id")
    # as many rows as there are lengths of vectors
    sizes = stored(rows.groupBy("dim").agg(
        F.ceil(F.count("*") / shard).cast("int").alias("shards"),
        F.ceil(F.greatest(F.count_if(is_anchor), F.lit(1)) / share).cast("int").alias("shares")), "sizes")
    cells = int(sizes.agg(F.sum(F.col("shards") * F.col("shares"))).first()[0] or 1)
    placed = rows.join(sizes, "dim")
    anchors = placed.where(is_anchor).select(
        "vec_id", "label", "vector", "dim", "shards", F.pmod(number, F.col("shares")).cast("int").alias("share"))
    anchors = anchors.groupBy("dim", "share").applyInArrow(
        _clustered, "vec_id long, label long, vector array<double>, dim int, shards int, share int, cluster int")
    anchors = stored(anchors, "anchors")
    every = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    candidates = placed.select("vec_id", "label", "vector", "dim", F.pmod(number, F.col("shards")).cast("int").alias("shard"), every)
    everywhere = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    asked = anchors.select("*", everywhere)

    found = _met(candidates, asked, cells, lambda c, a: positives_in(c, a, positives), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    best = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives)
    goals = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = anchors.join(goals, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    asked = stored(asked, "positives").select("*", everywhere)

    found = _met(candidates, asked, cells, lambda c, a: negatives_in(c, a, negatives, low),
                 "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    hardest = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
