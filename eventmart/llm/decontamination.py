"""Benchmark decontamination by a positional inverted index (DataFrame functions only).

The index holds a posting (term, document, position) for every training token whose term occurs in the test items,
stored shard by shard, sorted by term; texts are read and cut into words once. A phrase is found from its rarest
terms: the postings of the rarest give places where the phrase could start, the postings of the second rarest, moved
by the distance between both words, leave those where two words agree, and only for these the other terms are looked
up. Consecutive windows of an item share their rarest terms and their places, so what is intersected is an item laid
along a document (an alignment), not each window; runs of agreeing words that are long enough are the occurrences.

Items of equal words are searched once, as a class. Test items are taken in blocks of about BLOCK_WORDS words,
each with its own pass over the texts, so what is broadcast (the terms, words and anchors of a block) has a bound; it is
counted, and joined by shuffling instead where one item alone exceeds it. No posting is
shuffled to meet an anchor, so a word that makes up a third of the corpus stays spread over all shards.

Words are runs of a-z, A-Z (as a-z), 0-9 and all characters beyond ASCII. Defined results: a null or empty text has
no words and is not contaminated; an item without words occurs nowhere; an item without an id marks words but is not
counted or listed; rows that share an item_id are one item, rows that share a doc_id are separate documents. An empty
table of documents gives an empty result, an empty benchmark finds nothing. Other columns are not looked at.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmart.llm.common import stored, whole_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
BLOCK_WORDS = 1_000_000
BROADCAST_BYTES = 64 << 20
END = -1  # the term of a document's end mark, whose position is the number of words + 1


def _between_marks(text="text"):
    """The words of a text between two empty strings; the first word is element 1."""
    whole = whole_text(text)
    # `lower` knows more capitals than A-Z where a text is not plain ASCII
    lowered = F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.split(F.concat(F.lit(" "), lowered, F.lit(" ")), SEPARATORS)


def _bounded(frame, *text):
    """Marked for broadcast if its size, counted, is within BROADCAST_BYTES; otherwise left to Spark."""
    size = F.count("*") * 16 * len(frame.columns)
    for column in text:
        size = size + F.coalesce(F.sum(F.octet_length(column)), F.lit(0))
    return F.broadcast(frame) if frame.agg(size.alias("size")).first()["size"] <= BROADCAST_BYTES else frame


def item_classes(items, id_col="item_id", text_col="text"):
    """(item_id, class, words) of the items with words; items of equal words share a class."""
    marked = _between_marks(text_col)
    rows = items.select(F.col(id_col).alias("item_id"), F.slice(marked, F.lit(2), F.size(marked) - 2).alias("words"))
    rows = stored(rows.where(F.size("words") > 0).withColumn("row", F.monotonically_increasing_id()), "items")
    return rows.join(rows.groupBy("words").agg(F.min("row").alias("class")), "words").select("item_id", "class", "words")


def build_index(docs, words=None, id_col="doc_id", text_col="text"):
    """Postings (term, doc, pos, doc_id), positions counting from 1, written once; and the terms (word, term).

    `words` is a frame of the distinct words to index; None indexes every word. `doc` numbers the rows of `docs`; the
    term END holds one posting per document, with its doc_id.
    """
    # numbered before the words are laid out, in a step of its own: beside the generator, words would be numbered
    numbered = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("doc"))
    tokens = numbered.select("doc_id", "doc", F.posexplode(_between_marks()).alias("pos", "word"))
    if words is None:
        words = tokens.where("word != ''").select("word").distinct()
    terms = stored(words.withColumn("term", F.monotonically_increasing_id()), "terms")
    marks = terms.unionByName(docs.sparkSession.createDataFrame([("", END)], "word string, term long"))
    found = tokens.join(_bounded(marks, "word"), "word").where(f"term != {END} OR pos > 0")
    doc_id = F.when(F.col("term") == END, F.col("doc_id"))
    postings = found.select("term", "doc", "pos", doc_id.alias("doc_id"))
    return stored(postings.sortWithinPartitions("term"), "postings"), terms


def document_lengths(postings):
    """(doc, doc_id, n_words) of every document."""
    return postings.where(F.col("term") == END).select("doc", "doc_id", (F.col("pos") - 1).cast("long").alias("n_words"))


def _class_words(classes, postings, terms):
    """(class, at, term, count) of each word of each class; `count` is how often the corpus holds the term."""
    words = classes.select("class", F.posexplode("words").alias("at", "word")).join(terms, "word")
    counts = postings.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("count"))
    return words.join(counts, "term", "left").select("class", "at", "term", F.coalesce("count", F.lit(0)).alias("count"))


def _anchors(classes, class_words, window):
    """The two rarest words of every window whose words all occur: (class, at1, term1, at2, term2)."""
    sizes = classes.select("class", F.size("words").alias("n"), F.least(F.size("words"), F.lit(window)).alias("size"))
    first, last = F.greatest(F.col("at") - F.col("size") + 1, F.lit(0)), F.least("at", F.col("n") - F.col("size"))
    spread = class_words.join(sizes, "class").select(
        "class", F.explode(F.sequence(first, last)).alias("start"), F.struct("count", "term", "at").alias("word"))
    rarest = spread.groupBy("class", "start").agg(F.sort_array(F.collect_list("word")).alias("ranked"))
    one = F.col("ranked")[0]
    two = F.when(F.size("ranked") > 1, F.get("ranked", F.lit(1))).otherwise(one)
    return rarest.where(one["count"] > 0).select(
        "class", one["at"].alias("at1"), one["term"].alias("term1"), two["at"].alias("at2"), two["term"].alias("term2")).distinct()


def _alignments(postings, anchors):
    """(class, doc, diag) where two rarest words of a window agree; word `at` of the class lies at diag + at, which is before
    the document's start for the first words where a window from inside an item begins a document."""
    starts = postings.join(_bounded(anchors), F.col("term") == F.col("term1"))
    starts = starts.select("class", "doc", (F.col("pos") - F.col("at1")).alias("diag"), "at2", "term2").distinct()
    wanted = starts.select("class", "doc", "diag", F.col("term2").alias("term"), (F.col("diag") + F.col("at2")).alias("pos"))
    seconds = postings.join(_bounded(anchors.select(F.col("term2").alias("term")).distinct()), "term", "left_semi")
    return wanted.join(seconds.select("term", "doc", "pos"), ["term", "doc", "pos"]).select("class", "doc", "diag").distinct()


def _agreeing(postings, alignments, class_words):
    """(class, doc, diag, at) of the words that agree along the alignments."""
    words = class_words.select("class", "at", "term")
    wanted = alignments.join(_bounded(words), "class").select(
        "class", "doc", "diag", "at", "term", (F.col("diag") + F.col("at")).alias("pos"))
    near = postings.where(F.col("term") != END).join(alignments.select("doc").distinct(), "doc", "left_semi")
    return wanted.join(near.select("term", "doc", "pos"), ["term", "doc", "pos"]).select("class", "doc", "diag", "at")


def phrase_matches(postings, terms, classes, window=WINDOW):
    """Exact matches (class, doc, start, end): runs of positions start to end - 1 in which every `window` consecutive
    words are consecutive words of the class. A class of fewer words matches as a whole."""
    class_words = stored(_class_words(classes, postings, terms), "class-words")
    anchors = stored(_anchors(classes, class_words, window), "anchors")
    alignments = stored(_alignments(postings, anchors), "alignments")
    along = Window.partitionBy("doc", "class", "diag").orderBy("at")
    agreeing = _agreeing(postings, alignments, class_words).repartition("doc")
    runs = agreeing.withColumn("run", F.col("at") - F.row_number().over(along)).groupBy("doc", "class", "diag", "run").agg(
        F.min("at").alias("at"), F.count("*").alias("length"))
    sizes = classes.select("class", F.least(F.size("words"), F.lit(window)).alias("least"))
    start = (F.col("diag") + F.col("at")).cast("long")
    return runs.join(_bounded(sizes), "class").where("length >= least").select(
        "class", "doc", start.alias("start"), (start + F.col("length")).alias("end"))


def proximity_matches(postings, terms, classes, slop):
    """Proximity matches (class, doc, pos): places of the class's rarest word around which each of its words lies within
    `slop` positions of where the exact phrase has it. With slop 0 these are exact matches of whole items."""
    class_words = stored(_class_words(classes, postings, terms), "class-words")
    rarest = class_words.groupBy("class").agg(F.min(F.struct("count", "term", "at")).alias("one"))
    rarest = stored(rarest.where("one.count > 0").select("class", "one.term", F.col("one.at").alias("at1")), "rarest")
    places = postings.join(_bounded(rarest), "term").select("class", "doc", "pos", (F.col("pos") - F.col("at1")).alias("diag"))
    # sought in cells of slop + 1 positions, so that a word meets the postings of three cells at most
    cell = slop + 1
    wanted = places.join(_bounded(class_words), "class").select(
        "class", "doc", "pos", "at", "term", (F.col("diag") + F.col("at")).alias("ideal"))
    wanted = wanted.withColumn("cell", F.explode(F.array(*[F.floor(F.col("ideal") / cell) + d for d in (-1, 0, 1)])))
    held = postings.select("term", "doc", F.col("pos").alias("held"), F.floor(F.col("pos") / cell).alias("cell"))
    met = wanted.join(held, ["term", "doc", "cell"]).where(F.abs(F.col("held") - F.col("ideal")) <= slop)
    counted = met.groupBy("class", "doc", "pos").agg(F.count_distinct("at").alias("met"))
    lengths = classes.select("class", F.size("words").alias("n"))
    return counted.join(_bounded(lengths), "class").where("met = n").select("class", "doc", F.col("pos").cast("long").alias("pos"))


def _covered(runs):
    """(doc, n_hit): positions inside any run."""
    before = F.max("end").over(Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    return runs.select("doc", "start", "end").distinct().select("doc", fresh.alias("fresh")).groupBy("doc").agg(F.sum("fresh").alias("n_hit"))


def _listed(runs, members):
    """(doc, n_items, items_sha256). Documents that share a set of classes share one list, however many they are."""
    sets = runs.groupBy("doc").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    classes = sets.select("classes").distinct().withColumn("class", F.explode("classes"))
    names = classes.join(members.select("class", F.col("item_id").cast("string").alias("item_id")), "class")
    lists = names.groupBy("classes").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    lists = lists.select("classes", F.size("ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"))
    return sets.join(lists, "classes").select("doc", "n_items", "items_sha256")


def contamination(docs, benchmark, id_col="doc_id", text_col="text", window=WINDOW, block_words=BLOCK_WORDS):
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    members = stored(item_classes(benchmark), "members")
    classes = members.groupBy("class").agg(F.first("words").alias("words"))
    total = classes.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = int(-(-total // block_words)) or 1
    classes = stored(classes.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks))), "classes")
    runs, lengths = None, None
    for block in range(blocks):
        here = classes.where(F.col("block") == block).drop("block")
        postings, terms = build_index(docs, here.select(F.explode("words").alias("word")).distinct(), id_col, text_col)
        found = phrase_matches(postings, terms, here, window)
        runs = found if runs is None else runs.unionByName(found)
        lengths = document_lengths(postings) if lengths is None else lengths
    runs = stored(runs, "matches")
    result = lengths.join(_covered(runs), "doc", "left").join(_listed(runs, members), "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return result.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
