"""Filter audit, decontamination and hard negatives against plain versions: nulls, empty and very long texts, ties, repeated
rows, empty tables, clashing columns, hot keys, and the bounds of blocks and shards."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import decontamination, filter_audit, hard_negatives
from tests.llm.helpers import documents

LONG = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta"], k=50_000))
MANY = " ".join(f"w{i}" for i in range(60))


# --- filter audit ----------------------------------------------------------------------------------

def audit(docs, labels):
    """The audit by running every order, over (doc_id, text, source) rows and (doc_id, quality, toxic) labels."""
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    judged = []
    for i, t, source in docs:
        t = t or ""
        w = re.findall(r"[^ \t-\r]+", t)
        first = smallest.get(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": first is not None and (i is None or i > first)}
        mine = [(q, x) for d, q, x in labels if d is not None and d == i]
        judged.append((source or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    found = {}
    for part in {p for p, *_ in judged}:
        rows, total = [r for r in judged if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                earlier = sum(r[1][f] for r in rows) - len(gone)
                left = [r for r in left if not r[1][f]]
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in rows)
                found[part, order, step] = [len(left), len(gone), earlier, alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
                total[f] += len(gone)
        for (p, order, step), v in found.items():
            if p == part:
                v.append(total[order[step - 1]])
    return found


DOCS = [
    (1, MANY, "a"), (2, MANY, "b"), (3, MANY, None), (4, None, "a"), (5, "", ""), (6, LONG, "a"), (7, "A B C # d", "b"), (8, MANY.upper(), "a"),
    (9, "x | y", None), (10, "x | y", "b"), (10, "x | y", "b"), (None, MANY, "a"), (None, "only", "a"), (None, "only", "b"), (8, MANY + " ä%", "c")]
LABELS = [(1, 1, 0), (2, 1, 1), (3, None, 1), (6, 0, 1), (7, 1, 0), (7, 0, 1), (10, 1, 1), (None, 1, 1), (99, 1, 1)]


def run_audit(spark, docs, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    rows = filter_audit.filter_audit(documents(spark, docs), frame).collect()
    return {(r.part, r.filter_order, r.step): [r[m] for m in filter_audit.MEASURES] for r in rows}


def test_audit_runs_no_order_and_equals_running_all(spark):
    got = run_audit(spark, DOCS, LABELS)
    assert got == audit(DOCS, LABELS) and len(got) == 600 * len({d[2] or "" for d in DOCS})


def test_audit_of_nothing(spark):
    assert run_audit(spark, [], LABELS) == {} and len(run_audit(spark, DOCS[:1], [])) == 600


def test_audit_adds_up_copies_before_it_compares_them(spark):
    """A text in a third of the rows: one row per part and label is compared with its smallest id."""
    rows = [(i, "same" if i % 3 == 0 else f"text {i}", f"s{i % 2}") for i in range(3000)]
    counts = filter_audit.pattern_counts(documents(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    fails = {(r.part, r.pattern): r.n for r in counts.collect()}
    assert fails["s0", 0b10001] == 499 and fails["s1", 0b10001] == 500 and sum(fails.values()) == 3000


# --- decontamination -------------------------------------------------------------------------------

def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(docs, items, window=10):
    phrases = {}
    for item, text in items:
        w = plain_words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            phrases.setdefault(tuple(w[i:i + size]), set()).add(item)
    found = []
    for doc, text in docs:
        w, hit, names = plain_words(text), set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(w) - size + 1):
                p = tuple(w[i:i + size])
                if p in phrases:
                    hit |= set(range(i, i + size))
                    names |= {str(x) for x in phrases[p] if x is not None}
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(found, key=repr)


PASSAGE = [f"p{i}" for i in range(30)]
ITEMS = [
    (1, " ".join(PASSAGE)), (2, " ".join(PASSAGE)), (10, ", ".join(PASSAGE[5:20]).upper()), (3, "one Two"), (4, None), (5, " .;"), (6, "la " * 14),
    (7, "ÄÖ straße É x y z q r s t u"), (None, "nobody knows"), (8, " ".join(PASSAGE[12:21])), (9, "absent " + " ".join(PASSAGE[:9])), (3, "again three"),
    (11, " ".join(PASSAGE[:10] * 2))]
TEXTS = [
    (1, "x " + " ".join(PASSAGE[3:16]) + " y"), (2, None), (3, ""), (4, "ONE\ttwo one two"), (5, "la " * 40), (6, " ".join(PASSAGE[:9])),
    (7, "ÄÖ Straße É x Y z q r s t u ÄÖ straße É x y z q r s t u"), (8, "äö straße é x y z q r s t u"), (9, "...!"), (10, LONG + " " + " ".join(PASSAGE) + " " + LONG),
    (11, " ".join(PASSAGE + ["gap"] + PASSAGE[:12])), (11, "one two"), (None, "nobody knows one two"), (12, " ".join(PASSAGE[:10] * 5)),
    (13, "three again three"), (14, "p1 p2 x p3 p4"), *[(100 + i, " ".join(PASSAGE[:15])) for i in range(20)]]


def run_contamination(spark, docs, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x")).withColumn("class", F.lit(1))
    rows = decontamination.contamination(documents(spark, docs), benchmark, **options).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("options", [{}, {"block_words": 40}])
def test_contamination(spark, options):
    assert run_contamination(spark, TEXTS, ITEMS, **options) == contaminated(TEXTS, ITEMS)


def test_contamination_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    assert run_contamination(spark, TEXTS, ITEMS) == contaminated(TEXTS, ITEMS)


def test_contamination_of_and_by_nothing(spark):
    assert run_contamination(spark, [], ITEMS) == []
    assert run_contamination(spark, TEXTS, []) == contaminated(TEXTS, [])


def test_contamination_of_random_texts(spark):
    """Few words, so that windows overlap, repeat and share their rarest words."""
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 120)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 16)))) for i in range(40)]
    items += [(100 + i, " ".join(docs[i][1].split()[5:25])) for i in range(10)]
    assert run_contamination(spark, docs, items) == contaminated(docs, items)


def test_postings_are_sorted_by_term_and_hold_every_position(spark):
    postings, terms = decontamination.build_index(documents(spark, [(1, "b A b"), (2, "a")]))
    names = {r.term: r.word for r in terms.collect()}
    found = {(names[r.term], r.doc_id, r.pos) for r in postings.join(decontamination.document_lengths(postings).withColumnRenamed("doc_id", "id"), "doc").
             selectExpr("term", "id AS doc_id", "pos").collect() if r.term != decontamination.END}
    assert found == {("b", 1, 1), ("a", 1, 2), ("b", 1, 3), ("a", 2, 1)}


def test_proximity(spark):
    docs = [(1, "red x green blue"), (2, "red green blue"), (3, "blue green red"), (4, "red x y z green blue"), (5, "green"), (6, None)]
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    classes = decontamination.item_classes(items)
    postings, terms = decontamination.build_index(documents(spark, docs), classes.select(F.explode("words").alias("word")).distinct())
    names = decontamination.document_lengths(postings).select("doc", "doc_id")

    def found(slop):
        return {r.doc_id for r in decontamination.proximity_matches(postings, terms, classes, slop).join(names, "doc").collect()}

    assert [found(n) for n in range(5)] == [{2}, {1, 2}, {1, 2}, {1, 2, 4}, {1, 2, 3, 4}]


# --- hard negatives --------------------------------------------------------------------------------

def mined(rows, positives=5, negatives=5, low=80, every=100):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]) for i, (label, v) in kept.items()]
    found = set()
    for i, label, v in rows:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(s, k) for s, k, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p]
            found |= {(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(fits[:negatives], 1)}
    return found


def run_mining(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("dim", F.lit("x")).withColumn("cluster", F.lit(1))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0, label, **options)
    return [tuple(r) for r in got.collect()]


def vectors(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, dim))
    points = np.round(centers[rng.integers(0, 4, n)] + 0.3 * rng.normal(size=(n, dim)), 2)
    return [(i, [float(x) for x in points[i]], int(rng.integers(0, 4))) for i in range(n)]


ODD = [
    (None, [1.0] * 8, 1), (5000, None, 1), (5100, [1.0] * 8, None), (5200, [None] + [1.0] * 7, 1), (5300, [float("nan")] * 8, 1),
    (5400, [float("inf")] * 8, 1), (5500, [0.0] * 8, 1), (5600, [], 2), (5601, [], 2), (5602, [], 3), (5700, [1.0, 2.0], 1), (5701, [1.0, 2.1], 1),
    (5702, [1.0, 1.9], 2), (5800, [9.0] * 8, 1), (5800, [9.0] * 8, 1), (5800, [8.0] * 8, 0), (-100, [-0.001] * 8, 1)]


@pytest.mark.parametrize("options", [{}, {"shard": 60, "share": 4}])
def test_hard_negatives(spark, options):
    rows = vectors(700) + ODD
    got = run_mining(spark, rows, **options)
    assert len(got) == len(set(got)) and set(got) == mined(rows)


def test_hard_negatives_with_a_third_of_copies(spark):
    rows = [(i, [1.0, 0.5] if i % 3 == 0 else v[:2], label) for i, v, label in vectors(900)]
    got = run_mining(spark, rows, shard=100)
    assert set(got) == mined(rows) and got


def test_hard_negatives_of_nothing_and_of_one(spark):
    assert run_mining(spark, []) == [] and run_mining(spark, [(100, [1.0], 1)]) == []


def test_large_components_are_exact_or_an_error(spark):
    rows = [(i, [float((1 << 20) + i), 3.0], i % 2) for i in range(0, 300)]
    assert set(run_mining(spark, rows)) == mined(rows)
    with pytest.raises(Exception, match="64 bits"):
        run_mining(spark, [(0, [1e12], 1), (1, [1e12], 1)])


def test_a_list_is_left_when_the_bound_certifies(spark):
    """Anchors of one tight cluster look at a small part of a list of widely spread candidates."""
    rng = np.random.default_rng(5)
    candidates = np.round(rng.normal(size=(4000, 3)) * 256)
    members = np.round((np.array([1.0, 1.0, 1.0]) + 0.01 * rng.normal(size=(20, 3))) * 256)
    order, bounds = hard_negatives.shared_list(candidates, np.arange(4000), members)
    best, lengths = hard_negatives.Best(20, 5), np.linalg.norm(members, axis=1)
    exact = members @ candidates.T
    assert (exact[:, order] <= lengths[:, None] * bounds + 1e-9).all() and (np.diff(bounds) <= 0).all()

    def visit(active, part):
        best.add(active, hard_negatives.scores(members[active], candidates[part]), part, np.ones((len(active), len(part)), bool))

    looked = hard_negatives.walk(order, bounds, lengths, lambda a, upper: best.full(a) & (upper < best.score[a, -1]), visit)
    assert looked < 0.3 * exact.size
    assert (best.score == -np.sort(-exact, axis=1)[:, :5]).all()
