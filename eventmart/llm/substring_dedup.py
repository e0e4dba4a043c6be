"""Removal of repeated word sequences by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of BLOCK words, and every run of BLOCK words, at any
place, is a probe. A window of WINDOW = 2 * BLOCK - 1 words that two documents share covers a whole block of
one of them, whatever the alignment, so it shows as a probe of the later document that hits a block
of the earlier one. Blocks and probes meet by hash, as short fingerprints: a false hit costs a look, no result.
Around each hit the exact windows are then compared over all documents by a 64-bit hash and 32 bits of another one, so
that 10**12 windows hold a false pair with a chance of one in 100,000; neighbouring windows that agree join into maximal
repeats, whose words go where an earlier document has the window too.

Buckets of texts send each part of the hash space one blob. Within a bucket a hash that many documents share
is sent once, with the smallest and largest id; the other documents of the bucket know from it that they hit.
So a passage found in a third of all documents costs an entry per bucket.

A window is removed from every document but the one with the smallest id that has it, on the texts as they came in.

Defined results: a null text has no words. A null id counts as larger than all others: such rows lose what any
document with an id has, and nothing to each other. Rows with the same id do not take words from each other. A
text shorter than a window stays whole. An empty table gives an empty result.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventmart.llm.blobs import BUCKET_BYTES, bucket_count, bucketed, by_part, pack, part_of, unpack, word_bucket_count
from eventmart.llm.words import MULTIPLIER, U, Hasher, buffers, mixed, slices

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
CHECK, CHECK_MULTIPLIER = U(0x2545F4914F6CDD1D), U(0xD6E8FEB86659FD93)
NO_ID = np.iinfo(np.int64).max
NOBODY = np.iinfo(np.int64).min
BUCKET_WORDS = 1 << 21  # a bucket's arrays hold several numbers per word, so short words must not make it large


class _Bucket:
    """The texts of a bucket, in a fixed order: windows and probes over one array of words."""

    def __init__(self, table):
        order = np.argsort(table.column("doc_id").fill_null(NO_ID).to_numpy(), kind="stable")
        # equal ids keep no fixed order, so texts settle it
        ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        if len(np.unique(ids)) < len(ids):
            texts = table.column("text").fill_null("").to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])), np.int64)
        self.table = table.take(pa.array(order))
        self.ids = ids[order]
        hasher = Hasher()
        found = [(w.hash, w.counts) for _, _, w in slices(self.table.column("text"), hasher, lower=False)]
        self.hash = np.concatenate([x[0] for x in found]) if found else np.zeros(0, U)
        self.counts = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, size):
        """(hash, place of the first word) of all runs of `size` words inside a document with a window."""
        total = len(self.hash)
        if total < size:
            return np.zeros(0, U), np.zeros(0, np.int64)
        h = np.zeros(total - size + 1, U)
        for i in range(size):
            h = h * MULTIPLIER + self.hash[i:total - size + 1 + i]
        inside = (self.doc[:total - size + 1] == self.doc[size - 1:]) & (self.counts[self.doc[:total - size + 1]] >= WINDOW)
        places = np.flatnonzero(inside)
        return mixed(h[places]), places

    def check(self, places, size):
        """32 bits of another hash of the runs of `size` words that start at places."""
        h = np.zeros(len(places), U)
        for i in range(size):
            h = mixed(h ^ CHECK) * CHECK_MULTIPLIER + self.hash[places + i]
        return (mixed(h) >> U(32)).astype(np.uint32)


def _bounds(*keys):
    """Bounds of equal entries of sorted keys."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys]) if n else False
    return np.append(np.flatnonzero(new), n)


def _grouped(hashes, ids):
    """Order by hash and id, and the bounds of equal hashes in it."""
    order = np.lexsort((ids, hashes))
    return order, _bounds(hashes[order])


def _local(bucket, size, anchored):
    """Runs of a bucket: (hashes, places, in a group of several ids?, the group's smallest and largest id,
    smallest id with an anchored run, is the group's first entry?)."""
    hashes, places = bucket.runs(size)
    ids = bucket.ids[bucket.doc[places]]
    order, bounds = _grouped(hashes, ids)
    hashes, places, ids = hashes[order], places[order], ids[order]
    starts, counts = bounds[:-1], np.diff(bounds)
    low, high = ids[starts], ids[bounds[1:] - 1]
    anchors = np.where(anchored(bucket, places), ids, NO_ID)
    anchor = np.minimum.reduceat(anchors, starts) if len(starts) else anchors
    return hashes, places, ids, starts, counts, low, high, anchor


def _aligned(bucket, places):
    return (places - bucket.first[bucket.doc[places]]) % BLOCK == 0


def _anchor_messages(bucket_number, bucket, parts):
    """To each part of the hash space: entries of this bucket's runs of BLOCK words.

    An entry of one document has its places; one of several has the smallest and largest id alone.
    """
    hashes, places, ids, starts, counts, low, high, anchor = _local(bucket, BLOCK, _aligned)
    several = low < high
    alone = np.repeat(~several, counts)
    single_hash, single_place = hashes[alone], places[alone]
    group_hash = hashes[starts][several]
    single = {p: a for p, a in by_part(part_of(single_hash, parts), parts, single_hash.astype(np.uint32), single_place.astype(np.uint32))}
    group = {p: a for p, a in by_part(part_of(group_hash, parts), parts, group_hash.astype(np.uint32), high[several], anchor[several])}
    none = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)], [np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for p in sorted(set(single) | set(group)):
        h, at = single.get(p, none[0])
        order = np.argsort(at)
        h, at = h[order], at[order]
        doc = np.unique(bucket.doc[at])  # only the documents of these entries are named
        step = np.diff(at, prepend=np.uint32(0))
        step = step.astype(np.uint16) if len(step) == 0 or step.max() < 1 << 16 else step
        yield p, pack(np.array([bucket_number]), bucket.first[doc].astype(np.uint32), bucket.ids[doc], h, step, *group.get(p, none[1]))


def _meet(parts_table):
    """One part of the hash space: which single entries hit, back to their buckets as places."""
    entries = []
    for blob in parts_table.column("blob").to_pylist():
        (number,), first, ids, h, step, group_hash, group_high, group_anchor = unpack(blob)
        at = np.cumsum(step, dtype=np.int64)
        doc = np.searchsorted(first, at, "right") - 1
        aligned = (at - first[doc]) % BLOCK == 0
        entries.append((number, at, h, ids[doc], aligned, group_hash, group_high, group_anchor))
    hashes = np.concatenate([x for e in entries for x in (e[2], e[5])])
    high = np.concatenate([x for e in entries for x in (e[3], e[6])])
    anchor = np.concatenate([x for e in entries for x in (np.where(e[4], e[3], NO_ID), e[7])])
    known, place = np.unique(hashes, return_inverse=True)
    most, least = np.full(len(known), NOBODY), np.full(len(known), NO_ID)
    np.maximum.at(most, place, high)
    np.minimum.at(least, place, anchor)
    at_entry = 0
    for number, at, h, ids, aligned, group_hash, *_ in entries:
        own = place[at_entry:at_entry + len(h)]
        at_entry += len(h) + len(group_hash)
        # a probe with a block in an earlier document, or a block with a probe in a later one
        hit = (least[own] < ids) | (aligned & (most[own] > ids))
        if hit.any():
            yield int(number), pack(at[hit].astype(np.uint32))


def _window_places(bucket, hits):
    """A flag per word: does a window to look at, one that covers a hit run, start there?"""
    _, places, _, _, counts, low, high, _ = _local(bucket, BLOCK, _aligned)
    marked = np.zeros(len(bucket.hash) + 1, np.int64)
    marked[places[np.repeat(low < high, counts)]] = 1
    for blob in hits:
        marked[unpack(blob)[0]] = 1
    covered = np.concatenate([[0], np.cumsum(marked)])
    _, places = bucket.runs(WINDOW)
    flags = np.zeros(len(bucket.hash), bool)
    flags[places[covered[places + WINDOW - BLOCK + 1] > covered[places]]] = True
    return flags


def _window_groups(bucket, flags):
    hashes, places = bucket.runs(WINDOW)
    looked_at = flags[places]
    hashes, places = hashes[looked_at], places[looked_at]
    ids, check = bucket.ids[bucket.doc[places]], bucket.check(places, WINDOW)
    order = np.lexsort((ids, check, hashes))
    hashes, check = hashes[order], check[order]
    return hashes, check, places[order], ids[order], _bounds(hashes, check)


def _window_messages(bucket_number, bucket, hits, parts):
    """To each part: every distinct window of the bucket with its smallest id. To a part of its own, past the
    others: which windows these are."""
    flags = _window_places(bucket, hits)
    yield parts + bucket_number, np.packbits(flags).tobytes()
    hashes, check, _, ids, bounds = _window_groups(bucket, flags)
    starts = bounds[:-1]
    if len(starts):
        number = np.array([bucket_number])
        for p, (h, c, low) in by_part(part_of(hashes[starts], parts), parts, hashes[starts], check[starts], ids[starts]):
            distinct, place = np.unique(low, return_inverse=True)
            yield p, pack(number, h, c, distinct, place.astype(np.uint32 if len(distinct) > 1 << 16 else np.uint16))


def _smallest(parts_table, parts):
    """One part: for each bucket a flag per window it sent, whether an earlier document has it elsewhere.

    (bucket, 1, flags); what a bucket has sent to itself comes back as (bucket, 0, blob)."""
    part = parts_table.column("part")[0].as_py()
    if part >= parts:
        yield part - parts, parts_table.column("blob")[0].as_py(), 0
        return
    blobs = [unpack(b) for b in parts_table.column("blob").to_pylist()]
    hashes, check = (np.concatenate([b[i] for b in blobs]) for i in (1, 2))
    low = np.concatenate([b[3][b[4]] for b in blobs])
    order = np.lexsort((low, check, hashes))
    starts = _bounds(hashes[order], check[order])
    elsewhere, at = np.zeros(len(low), bool), 0
    elsewhere[order] = np.repeat(low[order][starts[:-1]], np.diff(starts)) < low[order]  # the smallest id comes first
    for number, h, *_ in blobs:
        yield int(number[0]), pack(np.array([part]), np.packbits(elsewhere[at:at + len(h)])), 1
        at += len(h)


def _kept(bucket, mine, replies, parts):
    """Per word of the bucket: does it stay?"""
    flags = np.unpackbits(np.frombuffer(mine, np.uint8), count=len(bucket.hash)).astype(bool)
    hashes, _, places, ids, bounds = _window_groups(bucket, flags)
    starts, counts = bounds[:-1], np.diff(bounds)
    elsewhere = np.zeros(len(starts), bool)
    if len(starts):
        flags = {int(number[0]): bits for number, bits in map(unpack, replies)}
        for p, (index,) in by_part(part_of(hashes[starts], parts), parts, np.arange(len(starts))):
            elsewhere[index] = np.unpackbits(flags[p], count=len(index)).astype(bool)
    low = np.repeat(ids[starts], counts)
    gone = places[np.repeat(elsewhere, counts) | (low < ids)]
    edge = np.zeros(len(bucket.hash) + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + WINDOW, -1)
    return np.cumsum(edge)[:-1] == 0


def _messages(found, *names):
    rows, types = list(found), {"blob": pa.binary()}
    return pa.table({name: pa.array([r[i] for r in rows], types.get(name, pa.int32())) for i, name in enumerate(names)})


def _blobs(table, kind=None):
    kinds = [None] * table.num_rows if kind is None else table.column("kind").to_pylist()
    return [b for b, k in zip(table.column("blob").to_pylist(), kinds) if k == kind]


def without_repeats(docs, id_col="doc_id", text_col="text", with_text=False, bucket_bytes=BUCKET_BYTES):
    """Per row: doc_id, n_words, n_removed, kept_sha256, and the kept words as `kept_text` where asked for."""
    buckets = max(bucket_count(docs, text_col, bucket_bytes), word_bucket_count(docs, BUCKET_WORDS, text_col))
    parts = buckets
    texts = bucketed(docs, buckets, id_col, text_col)

    def number(table):
        return table.column("bucket")[0].as_py()

    def probe(table):
        return _messages(_anchor_messages(number(table), _Bucket(table), parts), "part", "blob")

    def meet(table):
        return _messages(_meet(table), "bucket", "blob")

    def extend(table, hits):
        if table.num_rows == 0:
            return _messages([], "part", "blob")
        return _messages(_window_messages(number(table), _Bucket(table), _blobs(hits), parts), "part", "blob")

    def settle(table):
        return _messages(_smallest(table, parts), "bucket", "blob", "kind")

    def finish(table, mail):
        out = []
        if table.num_rows:
            bucket = _Bucket(table)
            kept = _kept(bucket, _blobs(mail, 0)[0], _blobs(mail, 1), parts)
            data, offsets = buffers(bucket.table.column("text"))
            for i, doc_id in enumerate(bucket.table.column("doc_id").to_pylist()):
                words = data[offsets[i]:offsets[i + 1]].tobytes().split()
                mine = kept[bucket.first[i]:bucket.first[i + 1]]
                if not mine.all():
                    words = list(itertools.compress(words, mine))
                text = b" ".join(words)
                out.append((doc_id, len(mine), len(mine) - len(words), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None))
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()] * 2)]
        return pa.Table.from_arrays(columns[:5 if with_text else 4], names[:5 if with_text else 4])

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    to_part, to_bucket = "part int, blob binary", "bucket int, blob binary"
    grouped = texts.groupBy("bucket")
    hits = grouped.applyInArrow(probe, to_part).groupBy("part").applyInArrow(meet, to_bucket)
    windows = grouped.cogroup(hits.groupBy("bucket")).applyInArrow(extend, to_part)
    mail = windows.groupBy("part").applyInArrow(settle, to_bucket + ", kind int")
    return grouped.cogroup(mail.groupBy("bucket")).applyInArrow(finish, schema)
