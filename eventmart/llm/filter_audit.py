"""Audit of how five filters interact, by contractions of contingency tensors.

A document fails or passes each of the filters A to E, so a part of the table is a 2x2x2x2x2 tensor of counts, axis f
being 0 where filter f passes and 1 where it fails. Applying the filters in any order is then linear algebra on 32
numbers: a step contracts every axis with a vector that selects pass, fail or all, and one einsum does so for all
steps of all 120 orders. The corpus is read once to fill the tensors; no order is ever run.

Filters (a document fails): A under 50 words; B fewer than 65 distinct words per 100; C more than 5 capitals A-Z per 100
code points; D a character of #$%&*|; E a text identical to that of a row with a smaller doc_id anywhere in the table.

Whether a text fails A to D depends on the text alone, so identical texts are grouped before anything else is asked
of them: rows are added up by digest within tasks, and only one row per (text, part, labels) is compared with the
smallest id of the text.

Defined results: a null text is empty, a null source is the part ''. Rows without a doc_id come after all others: they
fail E if a row with an id has their text. Rows that share doc_id and text do not fail E because of each other. A
document is good (toxic) if any of its label rows says 1. An empty table gives no parts and so no rows. A part's rows
depend on 96 numbers, whatever its size. Other columns are not looked at.
"""

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmart.llm.common import WORD_PATTERN, stored, whole_text

FILTERS = "ABCDE"
CELLS = 2 ** len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
TEXT_KEY = ["digest", "verifier", "length"]


def _facts(docs, id_col, text_col, part_col):
    """doc_id, part, text key and which of the filters A to D fail, as a number of four binary digits, A first."""
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    # exploding one element keeps the optimizer from repeating the split for each use of its result
    rows = rows.select("*", F.explode(F.array(F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), 1))).alias("words"))
    words, distinct = F.size("words").cast("long"), F.size(F.array_distinct("words")).cast("long")
    tests = [words < 50, 100 * distinct < 65 * words,
             100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 5 * F.length("text").cast("long"), F.col("text").rlike(r"[#$%&*|]")]
    fails = sum((F.when(t, 1 << (3 - i)).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
    return rows.select(
        "doc_id", "part", F.sha2("text", 256).alias("digest"), F.xxhash64("text").alias("verifier"), F.length("text").alias("length"),
        fails.alias("fails"))


def _labelled(rows, labels):
    """Rows with `good` and `toxic`, 0 or 1."""
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    joined = rows.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return joined.select(*rows.columns, F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def pattern_counts(docs, labels, id_col="doc_id", text_col="text", part_col="source"):
    """(part, pattern, n, good, toxic): documents by the filters they fail; the pattern's binary digits are A to E."""
    keys = ["part", *TEXT_KEY, "fails"]
    rows = _facts(docs, id_col, text_col, part_col).groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    rows = _labelled(stored(rows, "audit-facts"), labels)
    groups = rows.groupBy(*keys, "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"))
    first = F.min("least").over(Window.partitionBy(*TEXT_KEY))
    groups = groups.withColumn("first", first)
    passing = F.when(F.col("first").isNull(), F.col("n")).when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(F.lit(0))
    split = groups.withColumn("e", F.explode(F.array(
        F.struct(F.lit(0).alias("bit"), passing.alias("n")), F.struct(F.lit(1).alias("bit"), (F.col("n") - passing).alias("n")))))
    return split.groupBy("part", (F.col("fails") * 2 + F.col("e.bit")).alias("pattern")).agg(
        F.sum("e.n").alias("n"), F.sum(F.col("e.n") * F.col("good")).alias("good"), F.sum(F.col("e.n") * F.col("toxic")).alias("toxic"))


def _selectors(choose):
    """For each axis the selecting vectors of all steps: (orders x steps, 2) arrays. `choose(axis, order, step)`."""
    return [np.array([choose(axis, order, step) for order in ORDERS for step in range(5)]) for axis in FILTERS]


def _before(axis, order, step, here, after):
    place = order.index(axis)
    return PASS if place < step else here if place == step else after


KEPT = _selectors(lambda a, o, s: _before(a, o, s, PASS, ALL))
REMOVED = _selectors(lambda a, o, s: _before(a, o, s, FAIL, ALL))
FAILING = _selectors(lambda a, o, s: FAIL if o[s] == a else ALL)
ALONE = _selectors(lambda a, o, s: FAIL if o[s] == a else PASS)
OWNER = np.array([[o[s] == a for a in FILTERS] for o in ORDERS for s in range(5)]).astype(np.int64)  # (steps, filters)


def _contract(tensors, selectors):
    """(parts, steps) from (parts, 2, 2, 2, 2, 2), exactly, in 64-bit numbers."""
    return np.einsum("pabcde,ka,kb,kc,kd,ke->pk", tensors, *selectors, optimize=["einsum_path", (0, 1), (0, 4), (0, 3), (0, 2), (0, 1)])


def audit_tensors(counts):
    """All measures, {name: (parts, 600)}, from counts (3, parts, 2, 2, 2, 2, 2) of all, good and toxic documents."""
    every, good, toxic = counts
    removed = _contract(every, REMOVED)
    shares = removed @ OWNER  # what each filter removes, summed over all orders
    return {
        "kept": _contract(every, KEPT), "removed": removed, "redundant": _contract(every, FAILING) - removed,
        "unique_fails": _contract(every, ALONE), "good_lost": _contract(good, REMOVED), "toxic_lost": _contract(toxic, REMOVED),
        "shapley": shares @ OWNER.T}


def _audited(batches):
    orders = pa.array(np.repeat(ORDERS, 5))
    steps = pa.array(np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS)))
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            parts = batch.slice(at, 64).to_pydict()
            counts = np.zeros((3, len(parts["part"]), CELLS), np.int64)
            for p, cells in enumerate(parts["cells"]):
                for cell in cells:
                    counts[:, p, cell["pattern"]] = cell["n"], cell["good"], cell["toxic"]
            found = audit_tensors(counts.reshape(3, -1, *[2] * len(FILTERS)))
            for p, part in enumerate(parts["part"]):
                columns = [pa.array([part] * len(orders), pa.string()), orders.cast(pa.string()), steps, *[pa.array(found[m][p]) for m in MEASURES]]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *MEASURES])


def filter_audit(docs, labels, id_col="doc_id", text_col="text", part_col="source"):
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    cells = F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells")  # at most 32 per part
    return pattern_counts(docs, labels, id_col, text_col, part_col).groupBy("part").agg(cells).mapInArrow(_audited, SCHEMA)
