"""Language-model scores from an n-gram model in Elias-Fano tries, one trie per part of the contexts.

The model is a bigram model over words and an end token, smoothed towards the unigram model: the probability of w
after v is (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR), with P the add-one-half unigram estimate. Where v w was not
seen that is the context's back-off weight PRIOR / (c(v) + PRIOR) times P(w). A trie holds the contexts,
their successors, a quantised log probability per successor and a quantised back-off weight per context.

Neither counts nor model ever come together. Texts are dealt to buckets; a bucket sends each part of the
words its distinct words with their training counts, and learns their counts in the corpus, which give unigram
probabilities. Then it sends each part of the contexts its distinct bigrams with training counts; the part adds
up the counts of all buckets, builds its trie and answers all buckets from it. What travels is a bucket's
distinct n-grams, so a frequent one costs an entry per bucket; contexts that hold more than a part's share of the
corpus are split by successor over several parts, which every bucket works out from the context's count. It
grows with the corpus, and so does the number of parts.

Defined results: a null text is an empty one, the end token alone. A null id counts as the empty text for the
fold. Rows with the same id are scored each by itself. An empty table gives an empty result; without any training
document the unigram estimate rests on the add-one-half terms alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventmart.llm.blobs import bucket_count, bucketed, by_part, narrow, pack, part_of, unpack
from eventmart.llm.elias_fano import Sequence, Mapped, Trie
from eventmart.llm.words import U, Hasher, mixed, slices
from eventmart.session import work_dir

BUCKET_BYTES = 12 << 20
PRIOR = 60.0
END, START = mixed(np.array([1, 2], U) << U(60))
STEP = 16 / 32767        # log10 per code of a probability
UNSEEN = 1 << 15         # flag of an answer that is a back-off weight
UNIGRAM_STEP = 16 / 255  # log10 per code of a unigram probability inside a bigram's
KEY_BITS = U((1 << 40) - 1)


def _codes(log10, step, most):
    return np.clip(np.rint(-log10 / step), 0, most).astype(np.int64)


class _Bucket:
    """Tokens of a bucket's documents in a fixed order, as numbers of its distinct words."""

    def __init__(self, table):
        ids = table.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        order = np.argsort(ids, kind="stable")
        if len(np.unique(ids)) < len(ids):  # equal ids keep no fixed order, so texts settle it
            texts = table.column("text").fill_null("").to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
        self.table = table.take(pa.array(order))
        hasher, tokens, counts = Hasher(), [], []
        for _, _, words in slices(self.table.column("text"), hasher):
            tokens.append(np.insert(words.hash, words.first[1:], END))
            counts.append(words.counts + 1)
        self.counts = np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        train = ~self.table.column("held_out").to_numpy(zero_copy_only=False)
        self.train = np.repeat(train, self.counts)
        self.words, self.word = np.unique(np.concatenate(tokens), return_inverse=True)
        self.word = self.word.astype(np.int32)
        self.train_counts = np.bincount(self.word[self.train], minlength=len(self.words))

    def bigrams(self):
        """(context numbers, word numbers, training counts, number of each token's bigram), by context and word.

        The number of the start is that of no word."""
        context = np.empty(len(self.word), np.int64)
        context[1:] = self.word[:-1]
        context[self.first[:-1]] = len(self.words)
        keys, place = np.unique(context * (len(self.words) + 1) + self.word, return_inverse=True)
        place = place.astype(np.int32)
        return *np.divmod(keys, len(self.words) + 1), np.bincount(place[self.train], minlength=len(keys)), place

    def sums(self, values):
        """Sums of a value per token over each document."""
        return np.add.reduceat(values, self.first[:-1])


def _word_messages(number, bucket, parts):
    """To each part its slice of the bucket's sorted distinct words; the slice may be empty."""
    bounds = np.searchsorted(part_of(bucket.words, parts), np.arange(parts + 1))
    trained = np.count_nonzero(~bucket.table.column("held_out").to_numpy(zero_copy_only=False))
    for p in range(parts):
        s = slice(bounds[p], bounds[p + 1])
        yield p, pack(np.array([number, trained if p == 0 else 0]), bucket.words[s], narrow(bucket.train_counts[s]))


def _count_words(table, folder):
    """One part of the words: their training counts, back to the buckets in the order of their questions."""
    part = table.column("part")[0].as_py()
    blobs = [unpack(b) for b in table.column("blob").to_pylist()]
    known, place = np.unique(np.concatenate([b[1] for b in blobs]), return_inverse=True)
    counts = np.zeros(len(known), np.int64)
    np.add.at(counts, place, np.concatenate([b[2] for b in blobs]).astype(np.int64))
    # the root level of the model: word keys and their counts
    *root, counts = Mapped([*Sequence.encode(known, 1 << 64), counts], folder).arrays
    root = Sequence(root)
    totals = np.array([part, counts.sum(), np.count_nonzero(counts), sum(int(b[0][1]) for b in blobs)])
    for b in blobs:
        at, _ = root.find(b[1])
        yield int(b[0][0]), pack(totals, narrow(counts[at]))


class _Unigrams:
    """Counts of a bucket's words in the corpus and the unigram estimates that follow."""

    def __init__(self, counts, tokens, distinct, documents):
        self.counts, self.tokens, self.distinct, self.documents = counts.astype(np.int64), int(tokens), int(distinct), int(documents)
        self.log10 = np.log10((self.counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    @classmethod
    def of(cls, replies):
        blobs = sorted((unpack(b) for b in replies), key=lambda b: b[0][0])
        totals = np.sum([b[0][1:] for b in blobs], axis=0)
        return cls(np.concatenate([b[1] for b in blobs]), *totals)

    def packed(self):
        return pack(np.array([self.tokens, self.distinct, self.documents]), narrow(self.counts))

    @classmethod
    def unpacked(cls, blob):
        totals, counts = unpack(blob)
        return cls(counts, *totals)


def _bigram_parts(bucket, unigrams, context, word, parts):
    """(context hash, its count, word key, part) of each bigram of a bucket."""
    keys, counts = np.append(bucket.words, START), np.append(unigrams.counts, unigrams.documents)
    h, total = keys[context], counts[context]
    share = 1 + (total * parts) // max(1, unigrams.tokens)
    spread = (mixed(bucket.words[word]) % share.astype(U)).astype(np.int64)
    return h, total, bucket.words[word] & KEY_BITS, (part_of(mixed(h), parts) + spread) % parts


def _bigram_messages(number, bucket, unigrams, parts):
    context, word, trained, _ = bucket.bigrams()
    h, total, key, part = _bigram_parts(bucket, unigrams, context, word, parts)
    low = _codes(unigrams.log10, UNIGRAM_STEP, 255)[word]
    yield parts + number, unigrams.packed()
    for p, (h, total, key, trained, low) in by_part(part, parts, h, total, key, trained, low):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        yield p, pack(
            np.array([number]), h[first], narrow(total[first]), narrow(np.diff(np.append(first, len(h)))),
            (key & U(0xFFFFFFFF)).astype(np.uint32), (key >> U(32)).astype(np.uint8), narrow(trained), low.astype(np.uint8))


def _trie_of(h, total, key, trained, low, folder):
    """The trie of all bigrams with training counts, and the number of their kinds."""
    order = np.lexsort((key, h))
    h, total, key, trained, low = (x[order] for x in (h, total, key, trained, low))
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (key[1:] != key[:-1])]) if len(h) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    trained = np.add.reduceat(trained, first) if len(first) else trained
    h, total, key, low = h[first], total[first], key[first], low[first]
    seen = trained > 0
    h, total, key, low, trained = h[seen], total[seen], key[seen], low[seen], trained[seen]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    smoothed = (trained + PRIOR * 10.0 ** (-UNIGRAM_STEP * low)) / (total + PRIOR)
    weight = PRIOR / (total[start] + PRIOR)
    return Trie(h[start], np.append(start, len(h)), key, _codes(np.log10(smoothed), STEP, UNSEEN - 1).astype(np.uint16),
                _codes(np.log10(weight), STEP, UNSEEN - 1).astype(np.uint16), folder)


def _answer_bigrams(table, parts, folder):
    """One part of the contexts: (bucket, kind, blob) with a code per bigram of each bucket's question."""
    part = table.column("part")[0].as_py()
    if part >= parts:
        yield part - parts, table.column("blob")[0].as_py(), 0
        return
    asked = []
    for blob in table.column("blob").to_pylist():
        (number,), h, total, runs, low_key, high_key, trained, low = unpack(blob)
        key = low_key.astype(U) | (high_key.astype(U) << U(32))
        asked.append((int(number), np.repeat(h, runs), np.repeat(total.astype(np.int64), runs), key, trained.astype(np.int64), low.astype(np.float64)))
    trie = _trie_of(*(np.concatenate([a[i] for a in asked]) for i in range(1, 6)), folder)
    for number, h, total, key, *_ in asked:
        value, found = trie.look_up(h, key)
        # a context without a successor in this part still has its own weight
        own = _codes(np.log10(PRIOR / (total + PRIOR)), STEP, UNSEEN - 1)
        code = np.where(found, value, np.where(value >= 0, value, own) | UNSEEN)
        yield number, pack(np.array([part]), code.astype(np.uint16)), 1


def _scores(bucket, unigrams, replies, parts):
    """(n_tokens, n_known, train_tokens, base_score, score) per document of a bucket."""
    context, word, _, place = bucket.bigrams()
    part = _bigram_parts(bucket, unigrams, context, word, parts)[3]
    answers = {int(p[0]): code for p, code in map(unpack, replies)}
    log10 = np.empty(len(word))
    for p, (index,) in by_part(part, parts, np.arange(len(word))):
        code = answers[p].astype(np.int64)
        unseen = code >= UNSEEN
        log10[index] = -STEP * (code & (UNSEEN - 1)) + np.where(unseen, unigrams.log10[word[index]], 0)
    known = (unigrams.counts > 0).astype(np.int64)
    return (bucket.counts, bucket.sums(known[bucket.word]), np.full(len(bucket.counts), unigrams.tokens),
            bucket.sums(unigrams.log10[bucket.word]), bucket.sums(log10[place]))


def _rows(found, *names):
    rows, types = list(found), {"blob": pa.binary()}
    return pa.table({name: pa.array([r[i] for r in rows], types.get(name, pa.int32())) for i, name in enumerate(names)})


RESULT = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
          ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def language_scores(docs, id_col="doc_id", text_col="text", folds=5, held_out_fold=1, bucket_bytes=BUCKET_BYTES):
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    buckets = bucket_count(docs, text_col, bucket_bytes)
    parts = buckets
    levels = work_dir(docs.sparkSession, "levels")
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    texts = bucketed(docs, buckets, id_col, text_col, (fold == held_out_fold).alias("held_out"))

    def number(table):
        return table.column("bucket")[0].as_py()

    def ask_words(table):
        return _rows(_word_messages(number(table), _Bucket(table), parts), "part", "blob")

    def count_words(table):
        return _rows(_count_words(table, levels), "bucket", "blob")

    def ask_bigrams(table, mail):
        if not table.num_rows:
            return _rows([], "part", "blob")
        unigrams = _Unigrams.of(mail.column("blob").to_pylist())
        return _rows(_bigram_messages(number(table), _Bucket(table), unigrams, parts), "part", "blob")

    def answer_bigrams(table):
        return _rows(_answer_bigrams(table, parts, levels), "bucket", "blob", "kind")

    def finish(table, mail):
        if not table.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in RESULT})
        bucket, replies = _Bucket(table), {0: [], 1: []}
        for blob, kind in zip(mail.column("blob").to_pylist(), mail.column("kind").to_pylist()):
            replies[kind].append(blob)
        columns = _scores(bucket, _Unigrams.unpacked(replies[0][0]), replies[1], parts)
        return pa.Table.from_arrays([
            bucket.table.column("doc_id"), bucket.table.column("held_out"),
            *[pa.array(c, kind) for c, (_, kind) in zip(columns, RESULT[2:])]], [n for n, _ in RESULT])

    to_part, to_bucket = "part int, blob binary", "bucket int, blob binary"
    grouped = texts.groupBy("bucket")
    counts = grouped.applyInArrow(ask_words, to_part).groupBy("part").applyInArrow(count_words, to_bucket)
    asked = grouped.cogroup(counts.groupBy("bucket")).applyInArrow(ask_bigrams, to_part)
    mail = asked.groupBy("part").applyInArrow(answer_bigrams, to_bucket + ", kind int")
    return grouped.cogroup(mail.groupBy("bucket")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
