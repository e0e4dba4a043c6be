"""Sending documents to an external index in batches."""

import time

import pyarrow as pa
from pyspark.sql import functions as F


def root_cause(error):
    """The innermost cause of an exception."""
    while error.__cause__ is not None or (error.__context__ is not None and not error.__suppress_context__):
        error = error.__cause__ or error.__context__
    return error


def send_with_retry(send, batch, retries=1, retry_wait=2.0, retry_on=(ConnectionError,)):
    """Send one batch; a broken connection is tried again after a wait, anything else is raised."""
    for attempt in range(retries + 1):
        try:
            return send(batch)
        except Exception as error:
            if attempt == retries or not isinstance(root_cause(error), retry_on):
                raise
            time.sleep(retry_wait)


def index_documents(documents, send, batch_size=100, retries=1, retry_wait=2.0, retry_on=(ConnectionError,)):
    """Send every row as a dict, `batch_size` at a time within each partition; returns the row count.

    `send` takes a list of dicts, runs on the executors and may see a document again when a task is
    retried, so the index must replace documents by id.
    """

    def index(arrow_batches):
        waiting, sent = [], 0

        def flush():
            nonlocal waiting, sent
            send_with_retry(send, waiting, retries, retry_wait, retry_on)
            sent += len(waiting)
            waiting = []

        for arrow_batch in arrow_batches:
            for document in arrow_batch.to_pylist():
                waiting.append(document)
                if len(waiting) >= batch_size:
                    flush()
        if waiting:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], names=["sent"])

    return documents.mapInArrow(index, "sent long").agg(F.sum("sent").alias("sent")).first()["sent"] or 0
