"""Exact deduplication by a tree of merges over sorted digest runs (DataFrame functions only).

Every row becomes (run, digest, verifier, id). A run is an even share of the input, sorted by digest, with one
row per text. In each round FAN_IN neighbouring runs are merged into one; to keep all tasks busy they
exchange slices of the digest range while they merge: after k rounds a task holds the digests with one
prefix of k hex digits out of FAN_IN**k runs. There are as many rounds as it takes to keep runs at about RUN_ROWS rows, so
the number of tasks grows with the table in every round. Each merge keeps the smallest id and adds up the copies,
so a text that makes up a third of all rows sends one row per run into the first round and one
per FAN_IN runs into the next. The way back is as narrow: the merged row reaches the runs that hold
the text, and the rows of a run meet it there, so the copies of one text stay spread over all runs.

Texts count as equal when digest (SHA-256) and verifier (a 64-bit hash of another family, and
the length) agree.

Defined results: a null text equals an empty one. A null id comes after all others, and stays only if
no copy has an id. Rows that share id and text are reported as kept alike; `drop_copies` leaves one.
An empty table gives an empty result. Other columns of the input are not looked at.
"""

from pyspark.sql import functions as F

from eventmart.llm.common import SPACE_CLASS, stored, whole_text
from eventmart.session import session_conf

FAN_IN = 16         # runs per merge: one hex digit of the digest per round
RUN_ROWS = 1 << 16  # rows of a run, about
ROUNDS = 2          # at least: 256 runs
TEXT_KEY = ["digest", "verifier", "length"]


def normalised(text="text"):
    """The text with every run of white space as one space."""
    return F.regexp_replace(whole_text(text), f"{SPACE_CLASS}+", " ")


def text_key(text="text"):
    """Columns by which texts are told apart."""
    norm = normalised(text)
    return [F.sha2(norm, 256).alias("digest"), F.xxhash64(norm).alias("verifier"), F.length(norm).alias("length")]


def _merge(runs, level):
    """One row per run and text, sorted: the smallest id and the number of copies."""
    place = ["run", "slice"]
    spread = runs.withColumn("slice", F.substring("digest", 1, level)).repartition(*place)
    merged = (spread.sortWithinPartitions(*place, *TEXT_KEY).groupBy(*place, *TEXT_KEY)
              .agg(F.min("keep_id").alias("keep_id"), F.sum("copies").alias("copies")).drop("slice"))
    # sorted input is merged in order instead of being hashed again
    with session_conf(runs.sparkSession, {"spark.sql.execution.replaceHashWithSortAgg": "true"}):
        return stored(merged, f"dedup-level{level}")


def digest_table(docs, id_col="doc_id", text_col="text", rounds=None):
    """(id, run, text key) of every row, written once, and the rounds of merges that its runs take."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), *text_key(text_col)).withColumn("row", F.monotonically_increasing_id())
    keyed = stored(keyed, "digests")
    rounds = rounds or rounds_for(keyed.count())
    return keyed.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(FAN_IN ** rounds))).drop("row"), rounds


def rounds_for(rows):
    """The least number of rounds, ROUNDS at least, whose runs hold RUN_ROWS rows at most."""
    rounds = ROUNDS
    while FAN_IN ** rounds * RUN_ROWS < rows:
        rounds += 1
    return rounds


def merged_runs(digests, rounds=ROUNDS):
    """The runs before the first merge, and the last: one row per text over all runs."""
    first = _merge(digests.select("run", *TEXT_KEY, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("copies")), 0)
    runs = first
    for level in range(1, rounds + 1):
        runs = _merge(runs.withColumn("run", F.floor(F.col("run") / FAN_IN)), level)
    return first, runs


def _with_copies(digests, rounds):
    """Every row of the digest table with the id that stays and the size of its group."""
    first, last = merged_runs(digests, rounds)
    shared = last.where("copies > 1").select(*TEXT_KEY, F.col("keep_id").alias("group_keep"), F.col("copies").alias("group_copies"))
    by_run = first.join(shared, TEXT_KEY).select("run", *TEXT_KEY, "group_keep", "group_copies")
    joined = digests.join(by_run, ["run", *TEXT_KEY], "left")
    keep = F.when(F.col("group_copies").isNull(), F.col("doc_id")).otherwise(F.col("group_keep"))
    return joined.select(
        "doc_id", *TEXT_KEY, keep.alias("keep_id"), F.coalesce("group_copies", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"))


def exact_copies(docs, id_col="doc_id", text_col="text", rounds=None):
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    found = _with_copies(*digest_table(docs, id_col, text_col, rounds))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(docs, id_col="doc_id", text_col="text", rounds=None):
    """The rows that stay, with all their columns; of rows with the same id and text, one.

    An id that only one row has says which row goes, so texts are neither read again for a digest nor moved to meet one:
    the rows to drop leave by an anti join on the id, whose side Spark broadcasts where it is small. Ids that several
    rows share, and null ids, are told apart by their texts.
    """
    found = _with_copies(*digest_table(docs, id_col, text_col, rounds))
    ids = stored(found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept")), "dedup-ids")
    shared = ids.where("rows > 1 OR doc_id IS NULL")
    leaving = ids.where("doc_id IS NOT NULL AND (rows > 1 OR NOT kept)").select(F.col("doc_id").alias("key"))
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    single = whole.where("key IS NOT NULL").join(leaving, "key", "left_anti").select("row.*")
    if shared.isEmpty():
        return single
    match = F.col("key").eqNullSafe(F.col("shared_id"))
    several = whole.join(shared.select(F.col("doc_id").alias("shared_id")), match, "left_semi").select("row", "key", *text_key())
    keepers = stored(found.where("kept").select(F.col("doc_id").alias("kept_id"), *[F.col(c).alias(f"kept_{c}") for c in TEXT_KEY]).distinct(), "keepers")
    match = F.col("key").eqNullSafe(F.col("kept_id"))
    for c in TEXT_KEY:
        match = match & (F.col(c) == F.col(f"kept_{c}"))
    several = several.join(keepers, match, "left_semi").dropDuplicates(["key", *TEXT_KEY])
    return single.unionByName(several.select("row.*"))
