"""Harmonic packing of documents into training sequences.

A document's tokens are cut by its length alone: full sequences first, then the largest reciprocal of the
capacity that fits (a half, a third, ... down to 1/FINEST), and again for what is left; a rest below that
stays whole. A piece's class is the number of pieces of its size that fill a sequence, so every
sequence of class k takes exactly k pieces, whichever they are. Workers number their pieces per class; a prefix
sum over workers turns that into sequences and slots, and no piece has to know any other.

What is left of each class, fewer pieces than fill a sequence, is bounded by the number of classes and not by
the data; it is packed by first fit, longest first.

A sequence is padded to the capacity, except where its length is a power of two.

Defined results: a null or empty text is the end id alone. Rows with equal ids are packed each by itself, null
ids too. An empty table gives an empty result.
"""

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import stored
from eventmart.llm.tokens import encoder, row_slices

CAPACITY = 2048
FINEST = 16
CLASS_SHIFT = 1 << 48  # sequence ids: class * CLASS_SHIFT + number; class 0 is the first-fit rest

RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("class", T.IntegerType()), T.StructField("worker", T.IntegerType()), T.StructField("place", T.LongType())])


def cuts(tokens, capacity=CAPACITY, finest=FINEST):
    """(length, class) of the pieces of a document, in order."""
    pieces = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        fraction = -(-capacity // rest)  # the largest reciprocal that is not longer than the rest
        if fraction > finest or capacity // fraction == 0:
            pieces.append((rest, capacity // rest))
            break
        size = capacity // fraction
        pieces.append((size, fraction))
        rest -= size
    return pieces


def pieces(docs, tokenizer_path, end_id, id_col="doc_id", text_col="text", capacity=CAPACITY):
    """One row per piece, with its class and its place among the worker's pieces of the class."""
    def cut(batches):
        codec, worker, counts = encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        for batch in row_slices(batches):
            columns = [[] for _ in PIECES]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = codec.batch([text], end_id)[0]
                tokens, start = len(ids) // 4, 0
                for length, kind in cuts(tokens, capacity):
                    place = counts.get(kind, 0)
                    counts[kind] = place + 1
                    crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    for column, value in zip(columns, (doc_id, start, length, crc, tokens, kind, worker, place)):
                        column.append(value)
                    start += length
            types = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], PIECES.names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def _first_fit(capacity):
    def pack(rows):
        found = sorted(rows.to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"]))
        free = []
        for row in found:
            length = row["length"]
            n = next((i for i, room in enumerate(free) if room >= length), len(free))
            if n == len(free):
                free.append(capacity)
            row["sequence_id"], row["offset"] = n, capacity - free[n]
            free[n] -= length
        return pa.Table.from_pylist(found, pa.schema([(c, pa.int64()) for c in RESULT]))
    return pack


def harmonic_pack(docs, tokenizer_path, end_id, id_col="doc_id", text_col="text", capacity=CAPACITY):
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    # stored: places are numbers within a task, which another run of the task might give in another order
    cut = stored(pieces(docs, tokenizer_path, end_id, id_col, text_col, capacity), "pieces")
    counts = cut.groupBy("worker", "class").agg(F.count("*").alias("pieces"))
    earlier = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "worker", "class", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("base"),
        F.sum("pieces").over(Window.partitionBy("class")).alias("total"))
    number = F.col("base") + F.col("place")
    placed = cut.join(bases, ["worker", "class"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", F.floor(number / F.col("class")).alias("bin"),
        F.pmod(number, F.col("class")).alias("slot"), (F.floor(F.col("total") / F.col("class"))).alias("bins"))
    full = placed.where("bin < bins")
    before = Window.partitionBy("class", "bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    full = full.withColumn("sequence_id", F.col("class") * F.lit(CLASS_SHIFT) + F.col("bin"))
    rest = placed.where("bin >= bins").select(*RESULT[:5])
    # fewer than k pieces of each class k: a few thousand rows at most, whatever the input
    tail = rest.withColumn("rest", F.lit(0)).groupBy("rest").applyInArrow(_first_fit(capacity), ", ".join(f"{c} long" for c in RESULT))
    return full.select(*RESULT).unionByName(tail)
