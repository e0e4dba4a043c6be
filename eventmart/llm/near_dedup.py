"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct 5-word shingles. HASHES minima are taken of it; groups of ROWS minima
make the band keys that propose candidates, and BITS low bits of the first SIGNED minima are packed into a signature
of a few long integers. Two signatures agree by chance in one of 2**BITS lanes, so the share of agreeing lanes m is
corrected to (m - C) / (1 - C) with C = 2**-BITS; candidates estimated far below the threshold are dropped, the
others are confirmed on the full sets. At the threshold a band agrees with probability 0.32, all bands
fail with 1e-10; the estimate is cut six standard deviations below.

Only what can change the components is looked at, and no group of documents becomes a list of pairs:
1. documents with the same set become one class, kept by its smallest id;
2. every member of a band's bucket is paired with the bucket's smallest member alone. Of these partners each
   class confirms the one with the highest estimate, which gives a first set of components;
3. in buckets whose members still belong to several components, signatures are compared block by block inside a
   task, which only tells which components have candidates in common: families of components;
4. in families of several components, full sets are compared block by block inside a task, which only tells
   which components are linked.
After that every pair that shares a band is in one component, or was estimated too low, or was compared in full. A
large group costs a row per member and band, and a row per member and block of its bucket or family.

Defined results: a null text, like one without words, has an empty set and is linked with nothing. Fewer words
than a shingle form one shingle. Rows with the same id count as one document. A row without an id is linked with
nothing and has no component; it is kept. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import stored
from eventmart.llm.components import star_components
from eventmart.llm.words import MIX_A, MULTIPLIER, U, Hasher, mixed, segment_sums, slices

SHINGLE = 5
PERCENT = 75       # linked where 100 * intersection >= PERCENT * union
ROWS = 4
BANDS = 60
HASHES = BANDS * ROWS
SIGNED = 128
BITS = 2
LANES = 64 // BITS
WORDS = SIGNED // LANES
CHANCE = 2.0 ** -BITS
ESTIMATE_FROM = 0.45
SHARE = 500        # partners of a class confirmed by one task at a time
SIGNATURE_BLOCK = 2048  # members of a bucket compared by signature at a time
SET_BLOCK = 512         # members of a family compared in full at a time,
SHINGLE_BLOCK = 1 << 20  # of about so many shingles together, or a single longer text
SIGNATURE = [f"s{i}" for i in range(WORDS)]
SET = ["set_a", "set_b", "n_shingles"]

_rng = np.random.Generator(np.random.PCG64(5))
FACTORS = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
ID_BITS = U(52)  # bits of a shingle's hash; the others number the text within a slice
ID_SHIFT = U(12)


def shingle_sets(words, size=SHINGLE):
    """(hashes, bounds): the distinct shingles of each text of a slice, sorted, as 52-bit numbers."""
    found, doc, _ = words.shingles(size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = np.zeros(len(short), U)
        for i in range(size - 1):
            there = words.counts[short] > i
            whole[there] = whole[there] * MULTIPLIER + words.hash[words.first[short[there]] + i]
        found = np.concatenate([found, mixed(whole + words.counts[short].astype(U) * MIX_A)])
        doc = np.concatenate([doc, short])
    keys = np.sort((doc.astype(U) << ID_BITS) | (found >> ID_SHIFT))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    bounds = np.searchsorted(keys, np.arange(len(words.counts) + 1).astype(U) << ID_BITS)
    return keys & ((U(1) << ID_BITS) - U(1)), bounds


def minima(sets, bounds):
    """HASHES minima of each non-empty set, as an array of (hash, set)."""
    there = np.flatnonzero(np.diff(bounds))
    x = (mixed(sets) >> U(32)).astype(np.uint32)
    result = np.empty((HASHES, len(there)), np.uint32)
    if len(there):
        for k in range(HASHES):
            np.minimum.reduceat(x * FACTORS[k] + SHIFTS[k], bounds[:-1][there], out=result[k])
    return result, there


def sketches(docs, id_col="doc_id", text_col="text"):
    """Per row: doc_id, set_a and set_b (a hash of the set), n_shingles, bands, s0, s1, ..."""
    def sketch(batches):
        hasher = Hasher()
        for batch in batches:
            for a, b, words in slices(batch.column(1), hasher):
                sets, bounds = shingle_sets(words)
                low, there = minima(sets, bounds)
                n = b - a
                keys = np.zeros((n, BANDS), U)
                for band in range(BANDS):
                    key = np.full(len(there), band + 1, U)
                    for row in low[band * ROWS:(band + 1) * ROWS]:
                        key = mixed(key * MULTIPLIER + row.astype(U))
                    keys[there, band] = key
                lanes = ((low[:SIGNED] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(U)
                packed = np.zeros((n, WORDS), U)
                for i in range(SIGNED):
                    packed[there, i // LANES] |= lanes[i] << U(BITS * (i % LANES))
                used = np.diff(bounds) > 0
                offsets = np.concatenate([[0], np.cumsum(used * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[a:b], pa.array(segment_sums(mixed(sets), bounds).view(np.int64)),
                    pa.array(segment_sums(mixed(sets * MULTIPLIER + U(1)), bounds).view(np.int64)), pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[used].ravel().view(np.int64))),
                    *[pa.array(np.ascontiguousarray(packed[:, i]).view(np.int64)) for i in range(WORDS)]], schema.names)

    schema = T.StructType([
        *[T.StructField(c, T.LongType()) for c in ["doc_id", *SET]], T.StructField("bands", T.ArrayType(T.LongType())),
        *[T.StructField(c, T.LongType()) for c in SIGNATURE]])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sketch, schema)


def estimate(left, right):
    """Estimated similarity of two signatures given as lists of columns."""
    odd = int("01" * LANES, 2)
    differing = F.lit(0)
    for a, b in zip(left, right):
        x = a.bitwiseXOR(b)
        differing = differing + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd)))
    return ((1 - differing / SIGNED) - CHANCE) / (1 - CHANCE)


def _confirmed(docs, pairs, id_col, text_col):
    """The pairs (a, b) whose full sets reach the threshold. Texts of `a` are met by those of their partners."""
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    partner = pairs.join(shares, "a").select(
        F.col("b").alias("doc"), F.col("a").alias("group"), F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("role"))
    owner = shares.select(F.col("a").alias("doc"), F.col("a").alias("group"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("role"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    # texts always move to the pairs by id, at every size alike
    rows = partner.unionByName(owner).hint("merge").join(texts, "doc")
    rows = rows.repartition("group", "share").sortWithinPartitions("group", "share", "role", "doc").select("group", "share", "role", "doc", "text")

    def confirm(batches):
        hasher, place, mine = Hasher(), None, None
        for batch in batches:
            group, share, role, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            out = []
            for a, b, words in slices(batch.column(4), hasher):
                sets, bounds = shingle_sets(words)
                for i in range(a, b):
                    own = sets[bounds[i - a]:bounds[i - a + 1]]
                    if role[i] == 0:
                        place, mine = (group[i], share[i]), own.copy()
                        continue
                    if place != (group[i], share[i]):
                        continue
                    at = np.searchsorted(mine, own)
                    both = np.count_nonzero(mine[np.minimum(at, len(mine) - 1)] == own) if len(mine) else 0
                    if 100 * both >= PERCENT * (len(own) + len(mine) - both):
                        out.append((group[i], doc[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return rows.mapInArrow(confirm, "a long, b long").distinct()


class _Labels:
    """Components of a block's members; `join` says whether two of them were apart."""

    def __init__(self, components):
        self.names, self.of = np.unique(components, return_inverse=True)

    def join(self, i, others):
        """Join member i with others; the pairs of names that this brings together."""
        mine, found = self.of[i], np.unique(self.of[others])
        found = found[found != mine]
        if len(found):
            self.of[np.isin(self.of, found)] = mine
        return [(self.names[mine], self.names[x]) for x in found]


def _family_blocks(members):
    """family, blocks: how many blocks hold the texts of each family, by their number and by their shingles.

    Members are dealt to blocks by hash, so a block's shingles keep near the mean whatever the lengths of the texts.
    """
    return members.groupBy("family").agg(F.greatest(
        F.ceil(F.count("*") / SET_BLOCK), F.ceil(F.sum("n_shingles") / SHINGLE_BLOCK)).cast("int").alias("blocks"))


def _blocks(rows, group):
    """Every pair of the `blocks` blocks of each group's members: columns `block` (number of the pair) and `side`.

    A member of block k takes part in the pairs (i, k) and (k, j); one block is a pair with itself.
    """
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    paired = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    paired = paired.withColumn("block", low * F.col("blocks") + high).withColumn("side", (F.col("mine") != low).cast("int"))
    return paired.repartition(group, "block").sortWithinPartitions(group, "block", "doc_id")


def _streamed(batches, columns):
    """Tables of consecutive rows with equal first two columns."""
    held, place = [], None
    for batch in batches:
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)], 1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.append(cut, len(key))):
            if a == b:
                continue
            if place is not None and tuple(key[a]) != place:
                yield pa.Table.from_batches(held)
                held = []
            place = tuple(key[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _pairs_out(found):
    found = [(max(x), min(x)) for x in found]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], ["u", "v"])


def _families(open_):
    """Pairs of components that have members with like signatures in one bucket."""
    def compare(batches):
        odd = U(int("01" * LANES, 2))
        most = (1 - ESTIMATE_FROM) * (1 - CHANCE) * SIGNED  # lanes that may differ
        for table in _streamed(batches, 2):
            labels, side = _Labels(table.column(2).to_numpy()), table.column(3).to_numpy()
            signs = np.stack([table.column(4 + i).to_numpy().view(U) for i in range(WORDS)], 1)
            right = np.flatnonzero(side == 1) if side.any() else np.arange(len(side))
            found = []
            for i in np.flatnonzero(side == 0):
                apart = right[labels.of[right] != labels.of[i]]
                if len(apart):
                    x = signs[apart] ^ signs[i]
                    near = np.bitwise_count((x | (x >> U(1))) & odd).sum(1) <= most
                    found += labels.join(i, apart[near])
            yield _pairs_out(found)

    counted = open_.withColumn("blocks", F.ceil(F.col("members") / SIGNATURE_BLOCK).cast("int"))
    rows = _blocks(counted, "key").select("key", "block", "component", "side", *SIGNATURE)
    return rows.mapInArrow(compare, "u long, v long").distinct()


def _links(docs, members, id_col, text_col):
    """Pairs of components of one family that have linked members, by their full sets."""
    def compare(batches):
        hasher = Hasher()
        for table in _streamed(batches, 2):
            labels, side = _Labels(table.column(2).to_numpy()), table.column(3).to_numpy()
            found = [(shingle_sets(w)) for _, _, w in slices(table.column(4), hasher)]
            sets = np.concatenate([x for x, _ in found])
            size = np.concatenate([np.diff(b) for _, b in found])
            bounds = np.concatenate([[0], np.cumsum(size)])
            universe, number = np.unique(sets, return_inverse=True)
            mark = np.zeros(len(universe), np.int32)
            right = np.flatnonzero(side == 1) if side.any() else np.arange(len(side))
            pairs = []
            for i in np.flatnonzero(side == 0):
                apart = right[labels.of[right] != labels.of[i]]
                apart = apart[(100 * np.minimum(size[apart], size[i]) >= PERCENT * np.maximum(size[apart], size[i]))]
                if not len(apart):
                    continue
                mine = number[bounds[i]:bounds[i + 1]]
                mark[mine] = 1
                theirs = np.concatenate([number[bounds[j]:bounds[j + 1]] for j in apart])
                both = segment_sums(mark[theirs].astype(np.int64), np.concatenate([[0], np.cumsum(size[apart])]))
                mark[mine] = 0
                pairs += labels.join(i, apart[100 * both >= PERCENT * (size[apart] + size[i] - both)])
            yield _pairs_out(pairs)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = _blocks(members.hint("merge").join(texts, "doc_id"), "family").select("family", "block", "component", "side", "text")
    return rows.mapInArrow(compare, "u long, v long").distinct()


def near_duplicates(docs, id_col="doc_id", text_col="text"):
    """Per row: doc_id, n_shingles, component_id, kept."""
    sketch = stored(sketches(docs, id_col, text_col), "sketches")
    with_id = sketch.where("doc_id is not null and n_shingles > 0")
    classes = stored(with_id.groupBy(*SET).agg(F.min("doc_id").alias("class"), F.count("*").alias("copies")), "classes")
    first = with_id.join(classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi")

    bands = first.select("doc_id", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader < last").select("key", "leader")
    members = stored(bands.join(buckets, "key"), "band-members")
    signature = stored(first.join(members.select("doc_id").distinct(), "doc_id", "left_semi").drop("bands"), "signatures")

    mine = [F.col(f"m.{c}") for c in SIGNATURE]
    theirs = [F.col(f"t.{c}") for c in SIGNATURE]
    stars = members.where("doc_id != leader").select("doc_id", "leader").distinct()
    rated = (stars.join(signature.alias("m"), "doc_id").join(signature.withColumnRenamed("doc_id", "leader").alias("t"), "leader")
             .select("doc_id", "leader", estimate(mine, theirs).alias("estimate")).where(F.col("estimate") >= ESTIMATE_FROM))
    best = rated.groupBy("doc_id").agg(F.max(F.struct("estimate", (-F.col("leader")).alias("leader"))).alias("best"))
    pairs = stored(best.select((-F.col("best.leader")).alias("a"), F.col("doc_id").alias("b")), "star-pairs")
    edges = stored(_confirmed(docs, pairs, id_col, text_col), "star-edges")
    labels = star_components(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))

    label = F.coalesce("root", "doc_id")
    placed = stored(members.join(labels.select(F.col("u").alias("doc_id"), "root"), "doc_id", "left").select("key", "doc_id", label.alias("component")), "placed")
    buckets = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members"))
    open_ = stored(placed.join(buckets.where("x < y").select("key", "members"), "key").join(signature, "doc_id"), "open-buckets")
    families = star_components(_families(open_)).withColumnRenamed("u", "component").withColumnRenamed("root", "family")
    # a family's smallest component is known by its own number
    heads = families.select("family").distinct().select(F.col("family").alias("component"), "family")
    apart = open_.select("doc_id", "component", "n_shingles").distinct().join(families.unionByName(heads), "component")
    members = stored(apart.join(_family_blocks(apart), "family").drop("n_shingles"), "families")
    if not members.isEmpty():
        links = _links(docs, members, id_col, text_col)
        edges = stored(labels.select("u", F.col("root").alias("v")).unionByName(links), "all-edges")
        labels = star_components(edges)

    shared = classes.join(labels.select(F.col("u").alias("class"), "root"), "class", "left")
    shared = shared.select(*SET, F.coalesce("root", "class").alias("component")).where(F.col("root").isNotNull() | (F.col("copies") > 1))
    result = sketch.select("doc_id", *SET).join(shared, SET, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs, id_col="doc_id", text_col="text"):
    """One row of each component, with all its columns: the one with the smallest id."""
    dropped = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped.hint("merge"), id_col, "left_anti").select(*docs.columns)
