"""Quality scores from a factorisation machine.

A document's features are its words, hashed into BUCKETS buckets and weighted by damped counts of unit length, and
statistics of its structure and length, each put into one of BINS bins (one feature per bin). The machine adds
a weight per feature and, for each pair of features, the product of their vectors of RANK numbers. The sum over
all pairs is half of (sum of v x) squared minus the sum of (v x) squared, so a score takes time linear
in the document's features.

The model is fitted in one task, on at most TRAIN_ROWS labelled rows, those whose ids have the smallest
hashes; the rows' features, not their texts, are gathered. Its size is fixed, so it can be broadcast.

Defined results: a null text is an empty one and is scored by its structure alone. A null id is held out.
Rows without a label are not learnt from; repeated labels of a document count once, as 1 if any is. Without
any labelled row every score is 0.5. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.blobs import pack, unpack
from eventmart.llm.words import Hasher, segment_sums, slices

BUCKET_BITS = 18
BINS = 16
RANK = 8
TRAIN_ROWS = 8000
EPOCHS = 6
BATCH = 64
RATE = 0.05
PENALTY = 1e-5
THRESHOLD = 0.3
STATISTICS = ["upper", "digit", "mark", "newline", "beyond ascii", "odd mark", "word length", "long word", "one byte word", "distinct words", "characters", "words"]
BUCKETS = 1 << BUCKET_BITS
FEATURES = BUCKETS + BINS * len(STATISTICS)


def _classes():
    table = np.zeros((256, 6), np.int32)
    letters = set(range(65, 91)) | set(range(97, 123)) | set(range(48, 58)) | {9, 10, 11, 12, 13, 32}
    marks = set(range(33, 127)) - letters
    for column, members in enumerate([range(65, 91), range(48, 58), marks, [10], range(128, 256), marks - set(map(ord, ".,;:'\"!?()-"))]):
        table[list(members), column] = 1
    return table


CLASSES = _classes()


def _bins(values, scale):
    return np.clip((np.sqrt(values) * scale).astype(np.int64), 0, BINS - 1)


def features(words):
    """(feature, value, bounds per text) of the texts of a slice."""
    docs, bounds = len(words.counts), words.offsets
    size = np.maximum(np.diff(bounds), 1)
    shares = np.stack([segment_sums(CLASSES[:, i][words.data], bounds) for i in range(CLASSES.shape[1])], 1) / size[:, None]
    count = np.maximum(words.counts, 1)
    length = words.ends - words.starts
    mean = segment_sums(length, words.first) / count
    long_ = segment_sums((length > 20).astype(np.int64), words.first) / count
    short = segment_sums((length == 1).astype(np.int64), words.first) / count

    key = (words.doc.astype(np.uint64) << np.uint64(BUCKET_BITS)) | (words.hash >> np.uint64(64 - BUCKET_BITS))
    key, times = np.unique(key, return_counts=True)
    doc, bucket = (key >> np.uint64(BUCKET_BITS)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int64)
    value = 1 + np.log(times)
    first = np.searchsorted(doc, np.arange(docs + 1))
    norm = np.sqrt(np.maximum(segment_sums(value * value, first), 1e-12))
    value = value / norm[doc]
    distinct = np.diff(first) / count

    bins = np.stack([
        *[_bins(shares[:, i], s) for i, s in enumerate((16, 24, 24, 48, 20, 32))],
        np.clip(mean.astype(np.int64), 0, BINS - 1), _bins(long_, 24), _bins(short, 24), np.clip((distinct * BINS).astype(np.int64), 0, BINS - 1),
        np.clip(np.log2(np.diff(bounds) + 1).astype(np.int64), 0, BINS - 1), np.clip(np.log2(words.counts + 1).astype(np.int64), 0, BINS - 1)], 1)
    bins += BUCKETS + np.arange(len(STATISTICS)) * BINS
    # each text's words, then its statistics
    at = first[1:].repeat(len(STATISTICS))
    feature = np.insert(bucket, at, bins.ravel())
    value = np.insert(value, at, np.full(bins.size, 1 / np.sqrt(len(STATISTICS))))
    return feature, value, first + np.arange(docs + 1) * len(STATISTICS)


class Machine:
    """weights: one per feature; vectors: RANK per feature."""

    def __init__(self, weights=None, vectors=None, bias=0.0):
        if weights is None:
            rng = np.random.Generator(np.random.PCG64(7))
            weights = np.zeros(FEATURES, np.float32)
            vectors = rng.normal(0, 0.05, (FEATURES, RANK)).astype(np.float32)
        self.weights, self.vectors, self.bias = weights, vectors, bias

    def packed(self):
        return pack(np.array([self.bias]), self.weights, self.vectors.ravel())

    @classmethod
    def unpacked(cls, blob):
        (bias,), weights, vectors = unpack(blob)
        return cls(weights, vectors.reshape(-1, RANK), float(bias))

    def margins(self, feature, value, bounds):
        scaled = self.vectors[feature] * value[:, None]
        total = segment_sums(scaled.astype(np.float64), bounds)
        squares = segment_sums((scaled.astype(np.float64) ** 2).sum(1), bounds)
        return self.bias + segment_sums(self.weights[feature] * value, bounds) + 0.5 * ((total ** 2).sum(1) - squares)

    def scores(self, feature, value, bounds):
        return 1 / (1 + np.exp(-np.clip(self.margins(feature, value, bounds), -30, 30)))


def fit(rows, epochs=EPOCHS):
    """A machine from [(label, features, values)], by stochastic gradients with per-parameter rates."""
    machine = Machine()
    if not rows:
        machine.vectors[:] = 0
        return machine
    share = min(max(np.mean([r[0] for r in rows]), 0.01), 0.99)
    machine.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, RANK), 1e-6, np.float32), 1e-6
    rng = np.random.Generator(np.random.PCG64(11))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = [rows[i] for i in order[at:at + BATCH]]
            feature, value = np.concatenate([r[1] for r in chosen]), np.concatenate([r[2] for r in chosen])
            bounds = np.concatenate([[0], np.cumsum([len(r[1]) for r in chosen])])
            doc = np.repeat(np.arange(len(chosen)), np.diff(bounds))
            error = machine.scores(feature, value, bounds) - np.array([r[0] for r in chosen])
            scaled = machine.vectors[feature] * value[:, None]
            total = segment_sums(scaled.astype(np.float64), bounds)
            used, place = np.unique(feature, return_inverse=True)
            slope = error[doc] * value
            grad_w = np.bincount(place, slope, len(used)) / len(chosen) + PENALTY * machine.weights[used]
            each = slope[:, None] * (total[doc] - scaled)
            grad_v = np.stack([np.bincount(place, each[:, k], len(used)) for k in range(RANK)], 1) / len(chosen) + PENALTY * machine.vectors[used]
            seen_w[used] += grad_w ** 2
            seen_v[used] += grad_v ** 2
            machine.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            machine.vectors[used] -= RATE * grad_v / np.sqrt(seen_v[used])
            grad_b = error.mean()
            seen_b += grad_b ** 2
            machine.bias -= RATE * grad_b / np.sqrt(seen_b)
    return machine


def fold(id_col="doc_id", folds=5):
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def train(docs, labels, id_col="doc_id", text_col="text", label_col="quality", rows=TRAIN_ROWS):
    """A machine fitted on labelled rows outside the held-out fold."""
    labelled = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 0))
                .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label")))
    sample = labelled.orderBy(F.xxhash64("id"), "id").limit(rows)  # so bounded, and small enough to broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").select("id", "label", "text")

    def extract(batches):
        hasher = Hasher()
        for batch in batches:
            for a, b, words in slices(batch.column(2), hasher):
                feature, value, bounds = features(words)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[a:b], batch.column(1)[a:b],
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(feature, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(value, pa.float32()))], ["id", "label", "feature", "value"])

    def learn(table):
        table = table.sort_by([("id", "ascending")])
        label, feature, value = (table.column(c).to_numpy() for c in ("label", "feature", "value"))
        machine = fit([(label[i], feature[i], value[i].astype(np.float64)) for i in range(len(label))])
        return pa.table({"machine": pa.array([machine.packed()], pa.binary())})

    gathered = texts.mapInArrow(extract, "id long, label int, feature array<int>, value array<float>")
    learnt = gathered.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(learn, "machine binary").first()
    return fit([]) if learnt is None else Machine.unpacked(learnt["machine"])


def score(docs, machine, carried, text_col="text"):
    """One column, `carried`, of every row and its score: columns `carried` and `score`."""
    model = docs.sparkSession.sparkContext.broadcast(machine.packed())
    rows = docs.select(F.col(text_col).alias("text"), carried.alias("carried"))
    schema = T.StructType([rows.schema["carried"], T.StructField("score", T.DoubleType())])

    def apply(batches):
        known, hasher = Machine.unpacked(model.value), Hasher()
        for batch in batches:
            for a, b, words in slices(batch.column(0), hasher):
                yield pa.RecordBatch.from_arrays([batch.column(1)[a:b], pa.array(known.scores(*features(words)))], schema.names)

    return rows.mapInArrow(apply, schema)


def quality_scores(docs, labels, threshold=THRESHOLD):
    """Per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels), F.struct("doc_id", (fold() == 0).alias("held_out")))
    return scored.select("carried.*", "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs, labels, threshold=THRESHOLD):
    """The rows that the classifier accepts, with all their columns."""
    return score(docs, train(docs, labels), F.struct("*")).where(F.col("score") >= threshold).select("carried.*")
