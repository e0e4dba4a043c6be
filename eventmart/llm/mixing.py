"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source is a flow with a target number of words. Its documents queue in a shuffled order, up to
three times over; a copy's virtual finish time is the words its source has served up to and including it,
divided by the target. All copies are range-sorted by finish time, and the mix is what comes
before the total budget is used up. Because a later pass only adds the source's size to the words served,
finish times follow from one running total per document: the sorted table is needed only
to find the last copy that still fits, and every document then compares itself with that copy.

Running totals are split twice: a source into buckets of the shuffle key, and the global order into
the slices of a range partitioning. Both need only the totals of the slices before, so
no task reads a whole source, however large.

Defined results: a null text has size 0; a null source is a source of its own, after all others. Documents
of size 0 take 0 words. Rows that repeat an id are separate documents that share a place in the shuffle.
An empty table gives an empty result.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmart.llm.common import WORD_PATTERN, stored, whole_text

PASSES = 3          # no document is taken more often, no target is larger than so many times its source
WEIGHTS = 3         # sources weigh 1, 2, 3, 1, 2, 3, ...
BUCKET_DIGITS = 3   # hex digits of the shuffle key that split a source: 4096 buckets
ORDER = ["finish", "shuffle_key", "doc_id", "pass"]


def sized_documents(docs, id_col="doc_id", text_col="text", source_col="source"):
    """doc_id, source, size in words and the shuffle key of every document."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(whole_text(text_col), F.lit(WORD_PATTERN)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("shuffle_key"))


def source_targets(totals, passes=PASSES):
    """Words to take from each source: (source, source_size, weight, target).

    Shares by weight with a ceiling of `passes` times the source's size. With the sources ordered by ceiling
    per weight, those at their ceiling come first: the common level is what the budget leaves to
    the others divided by their weights, at the first source whose ceiling lies above it. One row
    per source passes one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", (F.pmod(F.row_number().over(by_name) - 1, F.lit(WEIGHTS)) + 1).cast("long"))
    weighed = weighed.withColumn("ceiling", F.col("source_size") * passes)
    ratio = F.col("ceiling").cast("double") / F.col("weight")
    fill = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.select("*", (left.cast("double") / weights).alias("level"), ratio.alias("ratio"), F.row_number().over(fill).alias("place"))
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(Window.partitionBy())["level"]
    target = F.least(F.col("ceiling").cast("double"), level * F.col("weight"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def _queued(sized):
    """Every document with its source's target and the words served up to the end of its first pass."""
    sized = sized.withColumn("bucket", F.substring("shuffle_key", 1, BUCKET_DIGITS))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    b, t = starts.alias("b"), targets.alias("t")
    starts = b.join(t, F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        F.col("b.source").alias("b_source"), F.col("b.bucket").alias("b_bucket"), "start", "source_size", "target")
    inside = (Window.partitionBy("source", "bucket").orderBy("shuffle_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = sized.withColumn("running", F.sum("size").over(inside))
    same = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))
    return running.join(starts, same).select(
        "doc_id", "source", "size", "shuffle_key", "source_size", "target", (F.col("start") + F.col("running")).alias("served"))


def _finish(number):
    """Virtual finish time of a pass; null in a source without words."""
    served = F.col("served") + F.col("source_size") * number
    return F.when(F.col("target") > 0, served / F.col("target"))


def _last_copy(queued, passes):
    """The last copy before the budget is used up, as (finish, shuffle_key, doc_id, pass), or None."""
    copies = queued.select(
        "shuffle_key", "doc_id", "size",
        F.posexplode(F.array(*[_finish(F.lit(p)) for p in range(passes)])).alias("pass", "finish")).where("finish is not null")
    ordered = copies.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    # stored, because a second range partitioning could cut elsewhere
    ordered = stored(ordered.withColumn("slice", F.spark_partition_id()), "mix-order")
    # one row per slice of the range partitioning, so bounded by the number of partitions
    slices = ordered.groupBy("slice").agg(F.sum("size").alias("words")).orderBy("slice").collect()
    budget = queued.agg(F.sum("size")).first()[0] or 0
    before = 0
    for i, slice_ in enumerate(slices):
        if before + slice_["words"] > budget or i == len(slices) - 1:
            break
        before += slice_["words"]
    else:
        return None
    running = F.sum("size").over(Window.partitionBy("slice").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    fitting = ordered.where(F.col("slice") == slice_["slice"]).withColumn("running", running).where(F.col("running") <= budget - before)
    last = fitting.agg(F.max(F.struct(*ORDER)).alias("last")).first()["last"]
    if last is None and i:
        last = ordered.where(F.col("slice") == slices[i - 1]["slice"]).agg(F.max(F.struct(*ORDER)).alias("last")).first()["last"]
    return last


def fair_mix(docs, id_col="doc_id", text_col="text", source_col="source", passes=PASSES):
    """Per document: doc_id, source, size, source_size, target, copies and taken words."""
    queued = stored(_queued(stored(sized_documents(docs, id_col, text_col, source_col), "mix-sizes")), "mix-queue")
    last = _last_copy(queued, passes)
    copies = F.lit(0)
    if last is not None:
        limit = [F.lit(last["finish"]), F.lit(last["shuffle_key"]), F.lit(last["doc_id"]).cast(queued.schema["doc_id"].dataType), F.lit(last["pass"])]
        for p in range(passes):
            here = [_finish(F.lit(p)), F.col("shuffle_key"), F.col("doc_id"), F.lit(p)]
            fits = F.struct(*[c.alias(n) for c, n in zip(here, ORDER)]) <= F.struct(*[c.alias(n) for c, n in zip(limit, ORDER)])
            copies = copies + F.when(_finish(F.lit(p)).isNotNull() & fits, 1).otherwise(0)
    return queued.withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs, id_col="doc_id", text_col="text", source_col="source", passes=PASSES):
    """The rows of the mix, each as often as it was taken, with the columns of the input."""
    taken = fair_mix(docs, id_col, text_col, source_col, passes)
    # rows that share id, source and size are taken alike
    key = ["doc_id", "source", "size"]
    counts = taken.where("copies > 0").groupBy(*key).agg(F.max("copies").alias("copies")).select(*[F.col(c).alias(f"taken_{c}") for c in key], "copies")
    size = F.regexp_count(whole_text(text_col), F.lit(WORD_PATTERN)).cast("long")
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    match = (F.col("doc_id").eqNullSafe(F.col("taken_doc_id")) & F.col("source").eqNullSafe(F.col("taken_source")) & (F.col("size") == F.col("taken_size")))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return whole.join(counts, match).select("row", copies.alias("copy")).select("row.*")
