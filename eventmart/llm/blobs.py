"""Arrays in binary cells: how many small records travel through a shuffle as few rows.

A blob is a number of arrays behind a header. Texts are dealt to buckets by a hash of id and text, of about
BUCKET_BYTES each, so a bucket's texts are the same however a job is split or repeated, and rows that
share an id, or have none, spread over buckets. A bucket is held in memory by one task; larger ones mean fewer blobs,
of which there is one for each bucket and part.
"""

import numpy as np
from pyspark.sql import functions as F

BUCKET_BYTES = 20 << 20


def pack(*arrays):
    head = np.array([len(arrays), *[x for a in arrays for x in (np.dtype(a.dtype).num, len(a))]], "<i8")
    return b"".join([head.tobytes(), *[np.ascontiguousarray(a).tobytes() for a in arrays]])


def narrow(numbers):
    """Numbers from 0 on in the narrowest unsigned type that holds them all."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()) if len(numbers) else 0))


TYPES = {np.dtype(t).num: np.dtype(t) for t in ("u1", "u2", "u4", "u8", "i4", "i8", "f4", "f8")}


def unpack(blob):
    blob = memoryview(blob)
    count = int(np.frombuffer(blob[:8], "<i8")[0])
    head = np.frombuffer(blob[8:8 + 16 * count], "<i8").reshape(-1, 2)
    at, found = 8 + 16 * count, []
    for kind, length in head:
        size = TYPES[int(kind)].itemsize * int(length)
        found.append(np.frombuffer(blob[at:at + size], TYPES[int(kind)]))
        at += size
    return found


def by_part(part, parts, *arrays):
    """(part, arrays of its members) for the parts that have any; the order within a part stays."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    arrays = [a[order] for a in arrays]
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), [a[bounds[p]:bounds[p + 1]] for a in arrays]


def part_of(hashes, parts):
    """A part for each 64-bit hash, by its upper half."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def bucket_count(docs, text_col="text", size=BUCKET_BYTES):
    """How many buckets of about `size` bytes the texts make."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return int(total // size) + 1


def word_bucket_count(docs, words, text_col="text"):
    """How many buckets of at most about `words` words the texts make; words are counted as runs between white
    space, which counts each text's words or one more."""
    total = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t-\r]+")))).first()[0] or 0
    return int(total // words) + 1


def bucketed(docs, buckets, id_col="doc_id", text_col="text", *more):
    """bucket, doc_id, text and the columns `more`."""
    return docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
