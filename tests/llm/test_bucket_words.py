"""Buckets of op3 are bounded by words as well as by bytes."""

import random

from eventmart.llm import blobs, substring_dedup
from tests.llm import brute
from tests.llm.helpers import by_id, documents


def test_word_bucket_count(spark):
    rows = [(1, "a b  c\n"), (2, None), (3, ""), (4, " x y")]
    # words and an empty piece at each white-space end: 4 + 1 + 1 + 3
    assert blobs.word_bucket_count(documents(spark, rows, clashing=False), 4) == 3


def test_substring_buckets_bounded_by_words(spark, monkeypatch):
    """Texts of one-letter words are few bytes but many words; they are spread over buckets of few words, with
    the same result."""
    used = []

    def bucketed(docs, buckets, *args):
        used.append(buckets)
        return blobs.bucketed(docs, buckets, *args)

    monkeypatch.setattr(substring_dedup, "bucketed", bucketed)
    monkeypatch.setattr(substring_dedup, "BUCKET_WORDS", 200)
    rng, passage = random.Random(5), " ".join("abcdefghijklmnop")
    rows = [(i, " ".join(rng.choices("xyz", k=rng.randrange(30))) + (" " + passage if i % 3 else "")) for i in range(60)]
    got = by_id(substring_dedup.without_repeats(documents(spark, rows, clashing=False)), "n_words", "n_removed", "kept_sha256")
    assert used and used[0] > 5
    assert got == brute.without_repeats(rows)
