"""Search documents into an external index, committed: a Python data source for batch and streaming writes.

Every task sends its rows in batches and reports once, when it has finished, what it has sent. Spark passes the reports of
the attempts that count, one per task, to a single commit, so a task that failed and ran again is counted once and its
first attempt is not published. A micro-batch that runs again commits under the same number. Spark calls commit
and abort in a process of its own, so what should be known afterwards has to be part of the index.
"""

import json
import uuid
from dataclasses import asdict, dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from eventmart.storage.documents import send_with_retry


@dataclass
class Sent(WriterCommitMessage):
    """A task's report. `receipt` is what its session returned at the end."""
    documents: int
    batches: int
    largest: int
    resent: int
    receipt: object = None


class FolderIndex:
    """An index kept as JSON lines in a shared folder, one file per task: the model of what an index has to offer.

    A file counts once a commit names it. `open` gives a session with `send(documents)` and `close()`, whose
    result becomes the receipt; sessions live in the tasks.
    """

    def __init__(self, path):
        self.path = path.rstrip("/")

    def open(self):
        return _FolderSession(self.path)

    def commit(self, batch, reports):
        """Publish a batch: its files, and totals over its tasks. The same batch again replaces itself."""
        totals = {"documents": sum(r.documents for r in reports), "batches": sum(r.batches for r in reports),
                  "largest": max((r.largest for r in reports), default=0), "resent": sum(r.resent for r in reports)}
        text = json.dumps({"batch": batch, **totals, "tasks": [asdict(r) for r in reports]})
        _write(f"{self.path}/commits/{batch}.json", text + "\n")

    def abort(self, batch, reports):
        """Remove what the finished tasks of a failed batch have sent."""
        for report in reports:
            system, path = _system(f"{self.path}/documents/{report.receipt}")
            system.delete_file(path)


class _FolderSession:
    def __init__(self, path):
        self._name = f"{uuid.uuid4().hex}.json"
        self._system, file = _system(f"{path}/documents/{self._name}")
        self._system.create_dir(file.rsplit("/", 1)[0])
        self._out = self._system.open_output_stream(file)

    def send(self, documents):
        self._out.write("".join(json.dumps(d, ensure_ascii=False) + "\n" for d in documents).encode())

    def close(self):
        self._out.close()
        return self._name


def _system(path):
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _write(path, text):
    system, file = _system(path)
    system.create_dir(file.rsplit("/", 1)[0])
    with system.open_output_stream(file + ".tmp") as out:
        out.write(text.encode())
    system.move(file + ".tmp", file)


def committed(spark, path):
    """(batch, documents, batches, largest, resent) of every commit to a folder index."""
    return spark.read.schema("batch string, documents long, batches long, largest long, resent long").json(f"{path}/commits")


def indexed(spark, path, schema):
    """The published documents of a folder index."""
    names = spark.read.schema("tasks array<struct<receipt: string>>").json(f"{path}/commits")
    files = [r.receipt for r in names.selectExpr("inline(tasks)").collect() if r.receipt]  # one per task
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{path}/documents/{name}" for name in files])


def _sender(base, index, batch_size, retries, retry_wait, retry_on):
    """A writer of the given kind for an index."""

    class Writer(base):
        def __init__(self, batch):
            self.batch = batch

        def write(self, iterator):
            session, waiting = index.open(), []
            report = Sent(0, 0, 0, 0)

            def flush():
                attempts = []

                def send(batch):
                    attempts.append(1)
                    return session.send(batch)

                send_with_retry(send, waiting, retries, retry_wait, retry_on)
                report.documents += len(waiting)
                report.batches += 1
                report.largest = max(report.largest, len(waiting))
                report.resent += len(attempts) - 1
                waiting.clear()

            for arrow_batch in iterator:
                for document in arrow_batch.to_pylist():
                    waiting.append(document)
                    if len(waiting) >= batch_size:
                        flush()
            if waiting:
                flush()
            report.receipt = session.close()
            return report

        def commit(self, messages, batch=None):
            index.commit(self.batch if batch is None else str(batch), [m for m in messages if m is not None])

        def abort(self, messages, batch=None):
            index.abort(self.batch if batch is None else str(batch), [m for m in messages if m is not None])

    return Writer


def register_index(spark, index, batch_size=100, retries=1, retry_wait=2.0, retry_on=(ConnectionError,)):
    """Make an index known to the session; returns the format name for `write.format` and `writeStream.format`.

    The option `batch` names a batch write; a streaming write is named by its batch numbers.
    """
    rules = (index, batch_size, retries, retry_wait, retry_on)
    format_name = f"index-{uuid.uuid4().hex}"

    class IndexSource(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def writer(self, schema, overwrite):
            return _sender(DataSourceArrowWriter, *rules)(self.options.get("batch", "batch"))

        def streamWriter(self, schema, overwrite):
            return _sender(DataSourceStreamArrowWriter, *rules)(None)

    spark.dataSource.register(IndexSource)
    return format_name


def write_index(documents, index, batch="batch", **rules):
    """Send all rows as one committed batch."""
    name = register_index(documents.sparkSession, index, **rules)
    documents.write.format(name).mode("append").option("batch", batch).save()
