"""The classifier: better than any constant on held-out documents, and scores that a plain version gives too."""

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventmart.llm import quality, words
from eventmart.llm.queries import QUERIES
from tests.llm import brute

SMALL, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def auc(pairs):
    """Chance that a document of label 1 scores above one of label 0, ties half."""
    good, bad = ([s for q, s in pairs if q == label] for label in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def balanced(pairs):
    return sum(np.mean([p == label for q, p in pairs if q == label]) for label in (0, 1)) / 2


def held_out(spark, folder):
    """(true label, row) of the labelled documents that the model has not learnt from."""
    label = dict(zip(*[pq.read_table(f"{folder}/labels.parquet").column(c).to_pylist() for c in ("doc_id", "quality")]))
    rows = [r for r in QUERIES["op8_quality"](spark, folder).collect() if r.held_out]
    assert all(brute.fold(r.doc_id) == 0 for r in rows)
    return [(label[r.doc_id], r) for r in rows if label.get(r.doc_id) is not None]


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")
def test_held_out_labels_are_ranked(spark):
    """A constant, or the length alone, ranks no better than chance."""
    got = held_out(spark, SMALL)
    lengths = dict(zip(*[pq.read_table(f"{SMALL}/documents.parquet").column(c).to_pylist() for c in ("doc_id", "n_chars")]))
    assert auc([(q, 0) for q, _ in got]) == 0.5 and abs(auc([(q, lengths[r.doc_id] or 0) for q, r in got]) - 0.5) < 0.2
    assert auc([(q, r.score) for q, r in got]) >= 0.97


@pytest.mark.skipif(not Path(LARGE).exists(), reason="no test tables here")
def test_held_out_labels_are_predicted(spark):
    """Five of six labels are 1, so both labels count alike here: a constant gets a half."""
    got = held_out(spark, LARGE)
    assert balanced([(q, 1) for q, _ in got]) == 0.5
    assert balanced([(q, r.predicted) for q, r in got]) >= 0.9


def plain_hash(word):
    mask, up, total = (1 << 64) - 1, 1, 0
    for byte in word:
        total = (total + int(words.BYTE_VALUES[byte]) * up) & mask
        up = up * int(words.MULTIPLIER) & mask
    x = (total + len(word)) & mask
    x = (x ^ x >> 30) * int(words.MIX_A) & mask
    x = (x ^ x >> 27) * int(words.MIX_B) & mask
    return x ^ x >> 31


def plain_margin(machine, text):
    """The machine's margin of a whole text, pair by pair."""
    data = (text or "").encode()
    found, raw = {}, [w for w in data.split()]
    for w in raw:
        bucket = plain_hash(w.lower()) >> 64 - quality.BUCKET_BITS
        found[bucket] = found.get(bucket, 0) + 1
    value = {b: 1 + math.log(n) for b, n in found.items()}
    norm = math.sqrt(max(sum(v * v for v in value.values()), 1e-12))
    features = [(b, v / norm) for b, v in value.items()]
    size, count, top = max(len(data), 1), max(len(raw), 1), quality.BINS - 1

    def binned(share, scale):
        return min(int(math.sqrt(share) * scale), top)

    marks = [c for c in data if 33 <= c < 127 and not chr(c).isalnum()]
    shares = [sum(65 <= c <= 90 for c in data), sum(48 <= c <= 57 for c in data), len(marks), data.count(b"\n"), sum(c > 127 for c in data),
              sum(chr(c) not in ".,;:'\"!?()-" for c in marks)]
    bins = [binned(n / size, s) for n, s in zip(shares, (16, 24, 24, 48, 20, 32))]
    bins += [min(int(sum(map(len, raw)) / count), top), binned(sum(len(w) > 20 for w in raw) / count, 24),
             binned(sum(len(w) == 1 for w in raw) / count, 24), min(int(len(found) / count * quality.BINS), top),
             min(int(math.log2(len(data) + 1)), top), min(int(math.log2(len(raw) + 1)), top)]
    features += [(quality.BUCKETS + i * quality.BINS + b, 1 / math.sqrt(len(bins))) for i, b in enumerate(bins)]
    total = machine.bias + sum(float(machine.weights[f]) * v for f, v in features)
    for i, (f, v) in enumerate(features):
        for g, w in features[:i]:
            total += float(machine.vectors[f].astype(np.float64) @ machine.vectors[g].astype(np.float64)) * v * w
    return total


TEXTS = ["The quick brown fox.\nThe end", "", None, " \t\n", "ÄÖ ü中\U0001f600 naïve", "AAAA 12345 #$% a b c", "a " * 50, "x" * 500, "one", "Same same SAME",
         " ".join(f"word{i}" for i in range(60))]


def test_scores_equal_the_plain_version():
    rng = np.random.default_rng(2)
    machine = quality.Machine(rng.normal(size=quality.FEATURES).astype(np.float32), rng.normal(0, 0.3, (quality.FEATURES, quality.RANK)).astype(np.float32), 0.25)
    got = []
    for _, _, part in words.slices(pa.array(TEXTS), words.Hasher(), rows=4):
        got += list(machine.margins(*quality.features(part)))
    assert got == pytest.approx([plain_margin(machine, t) for t in TEXTS], rel=1e-4, abs=1e-3)
