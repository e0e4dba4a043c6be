"""Token-id files: flat unsigned integers plus 64-bit document offsets, read by memory mapping.

A table is a folder of parts in ascending document order. Part n is
    n.bin   the ids, little-endian, 2 bytes each where the vocabulary allows it, else 4
    n.idx   the documents' offsets in the part, little-endian 64-bit, one more than there are documents
    n.ids   the document ids, little-endian 64-bit
and `manifest` (Parquet, a row per part) has each part's documents, tokens and the number of documents
without an id, which come first. A part's base in the whole table is the sum of the tokens of the parts
before it, so parts are written at once and independently. A part is written under a name of its own and then
renamed, so a task that runs twice leaves one complete part.

Defined results: a null or empty text is the end id alone. Rows with equal ids are separate documents next to
each other. An empty table gives a folder without parts.
"""

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.tokens import encoder, row_slices

MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType()),
    T.StructField("without_id", T.LongType()), T.StructField("id_bytes", T.IntegerType())])
RANGE = 1 << 14  # documents that are read at once
TASKS = 10_000   # that read
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_system(path):
    """(file system, path in it) of a shared folder, whichever store it is in."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Part:
    """Writes the three files of a part."""

    def __init__(self, folder, part, id_bytes):
        self._fs, self._root = file_system(folder)
        self._fs.create_dir(self._root, recursive=True)
        self._names = {kind: (f"{self._root}/.{part}-{uuid.uuid4().hex}.{kind}", f"{self._root}/{part}.{kind}") for kind in ("bin", "idx", "ids")}
        self._out = {kind: self._fs.open_output_stream(names[0]) for kind, names in self._names.items()}
        self._out["idx"].write(np.zeros(1, "<i8").tobytes())
        self._type, self.docs, self.tokens, self.without_id = f"<u{id_bytes}", 0, 0, 0

    def add(self, doc_ids, ids):
        """Documents as lists of ids (or None) and of 32-bit id strings."""
        lengths = np.array([len(x) // 4 for x in ids], "<i8")
        numbers = np.frombuffer(b"".join(ids), "<u4")
        if int(numbers.max(initial=0)) > np.iinfo(self._type).max:
            raise ValueError(f"id {numbers.max()} does not fit into {np.dtype(self._type).itemsize} bytes")
        self._out["bin"].write(numbers.astype(self._type).tobytes())
        self._out["idx"].write((self.tokens + np.cumsum(lengths)).astype("<i8").tobytes())
        self._out["ids"].write(np.array([x or 0 for x in doc_ids], "<i8").tobytes())
        self.docs += len(ids)
        self.tokens += int(lengths.sum())
        self.without_id += sum(x is None for x in doc_ids)

    def close(self):
        for kind, (name, final) in self._names.items():
            self._out[kind].close()
            self._fs.move(name, final)


def write_token_files(docs, folder, tokenizer_path, end_id, id_bytes, id_col="doc_id", text_col="text"):
    """Encode all documents into `folder`; returns the manifest as stored."""
    def write(batches):
        codec, part, file = encoder(tokenizer_path), TaskContext.get().partitionId(), None
        for batch in row_slices(batches):
            file = file or _Part(folder, part, id_bytes)
            file.add(batch.column(0).to_pylist(), codec.batch(batch.column(1).to_pylist(), end_id))
        if file:
            file.close()
            row = [part, file.docs, file.tokens, file.without_id, id_bytes]
            yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST.names, row))], pa.schema(
                [(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.int64()) for f in MANIFEST]))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    spark = docs.sparkSession
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def mapped(folder, name, number, first, upto):
    """Numbers `first` to `upto` of a file: memory-mapped where the store is a mounted file system."""
    fs, root = file_system(folder)
    width = np.dtype(number).itemsize
    path = f"{root}/{name}"
    with pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path) as file:
        file.seek(first * width)
        return np.frombuffer(file.read_buffer((upto - first) * width), number)


def read_part(folder, part, id_bytes, first, upto):
    """(document ids, offsets, token ids) of the documents `first` to `upto` of a part."""
    offsets = mapped(folder, f"{part}.idx", "<i8", first, upto + 1)
    return (mapped(folder, f"{part}.ids", "<i8", first, upto), offsets,
            mapped(folder, f"{part}.bin", f"<u{id_bytes}", int(offsets[0]), int(offsets[-1])))


def read_token_files(spark, folder, step=4096, docs=RANGE):
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. A part is read in ranges of `docs` documents."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    ranges = manifest.agg(F.sum(F.ceil(F.col("docs") / docs))).first()[0] or 1
    # a row per part, so bounded by the number of files
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    # a number of partitions that is given is not coalesced, however small the rows are
    dealt = based.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("docs") - 1, F.lit(docs)))).repartition(int(min(ranges, TASKS)), "part", "first")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                first, upto = row["first"], min(row["first"] + docs, row["docs"])
                doc_ids, offsets, ids = read_part(folder, row["part"], row["id_bytes"], first, upto)
                at = offsets - offsets[0]
                for a in range(0, upto - first, step):
                    b = min(a + step, upto - first)
                    crcs = [zlib.crc32(ids[at[i]:at[i + 1]].astype("<u4")) for i in range(a, b)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[a:b], mask=np.arange(first + a, first + b) < row["without_id"]),
                        pa.array(offsets[a:b] + row["base"]), pa.array(np.diff(offsets[a:b + 1])), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(read, DOCUMENTS)
