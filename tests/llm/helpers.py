from pathlib import Path

import pyarrow.parquet as pq
import pytest

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
# Columns of the input that no operator may stumble over.
CLASHING = ["bucket", "class", "component", "copies", "digest", "finish", "key", "kept", "length", "part", "run", "score", "size", "start", "worker"]


def documents(spark, rows, clashing=True):
    """A `documents` table of (doc_id, text[, source]) rows, with columns of clashing names."""
    extra = CLASHING if clashing else []
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *["x"] * len(extra)) for r in rows]
    names = ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + (", " + names if names else ""))


def table_rows(name, *columns):
    return list(zip(*[pq.read_table(f"{SF_DIR}/{name}.parquet").column(c).to_pylist() for c in columns]))


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}
