"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import chat, exact_dedup, lm, mixing, near_dedup, neighbours, packing, quality, substring_dedup, token_files
from eventmart.session import session_conf, work_dir
from tests.llm import brute
from tests.llm.helpers import by_id, documents

LONG = " ".join(random.Random(1).choices([a + b + c for a in "abcdefg" for b in "hijklm" for c in "nopqrs"], k=60_000))
BASE = [f"w{i}" for i in range(60)]
NEAR = BASE[:30] + ["changed"] + BASE[31:]
ROWS = [
    (1, " ".join(BASE), "b"), (2, " ".join(BASE), None), (3, "  ".join(BASE) + "\n", "a"), (4, " ".join(NEAR), "a"),
    (5, None, None), (6, "", "c"), (7, " \t\n", "a"), (8, "One two", "b"), (9, "one  two", "c"), (10, LONG, "a"),
    (11, "x " + LONG, "d"), (12, "aé中\U0001f600 <|endoftext|> it's 5,000", "e"), (13, "one", None), (14, ".", "b")]
NULL_ID = [(None, " ".join(BASE), "a"), (None, "only here", None)]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pairs(rows=ROWS):
    return [(r[0], r[1]) for r in rows]


def test_exact_copies(spark, docs):
    got = by_id(exact_dedup.exact_copies(docs), "keep_id", "group_size", "kept")
    assert got == {ROWS[i][0]: (k, n, k == ROWS[i][0]) for i, (k, n) in brute.exact(pairs()).items()}
    assert got[3] == (1, 1, True) or got[3][0] == 3  # a final line feed is a space more
    assert {got[i][0] for i in (5, 6)} == {5} and got[7][0] == 7


def test_exact_copies_without_ids_and_repeated(spark):
    rows = ROWS[:2] + ROWS[:1] + NULL_ID + [NULL_ID[1]]
    got = exact_dedup.exact_copies(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == [
        (0, 0, 2, True), (0, 0, 2, True), (0, 1, 4, False), (1, 1, 4, True), (1, 1, 4, True), (2, 1, 4, False)]
    kept = exact_dedup.drop_copies(documents(spark, rows))
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "only here"), (1, " ".join(BASE))]
    assert kept.columns == documents(spark, rows).columns


def test_rounds_follow_the_number_of_rows(spark):
    assert [exact_dedup.rounds_for(n) for n in (0, 1 << 24, (1 << 24) + 1, 10**12)] == [2, 2, 3, 6]
    rows = documents(spark, [(i, f"text {i % 900}") for i in range(2000)], clashing=False).repartition(16)
    digests, rounds = exact_dedup.digest_table(rows, rounds=3)
    assert rounds == 3 and digests.select("run").distinct().count() > 256
    assert exact_dedup.exact_copies(rows, rounds=3).where("kept").count() == 900


def test_stages_keep_columns_of_any_name(spark):
    """Names that the stages use themselves, and used to."""
    names = ["_id", "_label", "_quality_score", "_text", "_source", "_size", "_copies", "_copy", "_keep_id", "_key_digest", "row", "key", "id", "label",
             "carried", "taken_doc_id", "shared_id", "kept_id", "kept_digest", "copy", "rows", "digests", "keep_id", "verifier", "pass", "machine"]
    good = " ".join(f"fine word{i} and" for i in range(30))
    rows = [(i, f"{good} {i}" if i else good, "s") for i in range(6)] + [(6, f"{good} 1", "s"), (None, f"{good} 2", "s"), (None, "alone", "t"), (4, f"{good} 4", "s")]
    docs = documents(spark, rows).withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for n in names})
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int").withColumn("_id", F.lit(1)).withColumn("label", F.lit(1))
    for stage in (lambda d: quality.keep_good(d, labels), exact_dedup.drop_copies, near_dedup.drop_near_duplicates, mixing.mixed_documents):
        kept = stage(docs)
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and all(r[n] == n + ("" if r.doc_id is None else str(r.doc_id)) for r in found for n in names)
    assert sorted((r.doc_id or -1) for r in exact_dedup.drop_copies(docs).collect()) == [-1, -1, 1, 2, 3, 4, 5]
    assert quality.quality_scores(docs, labels).count() == len(rows)


def test_many_copies_take_few_rows_per_run(spark):
    rows = [(i, "the same text") for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 4000)]
    got = exact_dedup.exact_copies(documents(spark, rows, clashing=False))
    assert got.where("kept").count() == 1001 and got.where("group_size = 3000").count() == 3000
    _, last = exact_dedup.merged_runs(*exact_dedup.digest_table(documents(spark, rows, clashing=False)))
    assert last.count() == 1001


def test_mix(spark, docs):
    got = sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixing.fair_mix(docs).collect())
    assert got == sorted(brute.mix([(r[0], r[2], r[1]) for r in ROWS]))
    again = sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixing.fair_mix(docs.repartition(3)).collect())
    assert got == again
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.words(r.text)) for r in mixed.collect()) == sum(x[4] for x in got)


def test_mix_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1500)]
    got = mixing.fair_mix(documents(spark, rows, clashing=False)).collect()
    taken = {}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        s = taken.setdefault(r.source, [0, r.target])
        s[0] += r.taken
    assert all(abs(n - target) <= 80 for n, target in taken.values())


def test_mix_without_words(spark):
    rows = [(1, "", "a"), (2, None, "b"), (3, "w", "b")]
    got = {r.doc_id: (r.taken, r.target) for r in mixing.fair_mix(documents(spark, rows)).collect()}
    assert got == {1: (0, 0.0), 2: (0, 1.0), 3: (1, 1.0)}


def test_near_duplicates(spark, docs):
    got = by_id(near_dedup.near_duplicates(docs), "n_shingles", "component_id")
    assert got == brute.near(pairs())
    assert got[4][1] == 1 and got[5] == (0, 5) and got[9][1] == 8 and got[11][1] == 10
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in brute.near(pairs()).items() if i == c}


def test_near_duplicates_without_ids_and_repeated(spark):
    got = near_dedup.near_duplicates(documents(spark, ROWS[:1] + ROWS[:1] + ROWS[3:4] + NULL_ID)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (4, 1, False)]


@pytest.mark.parametrize("signature_block, set_block, shingle_block", [(2048, 512, 1 << 20), (7, 5, 1 << 20), (2048, 512, 300)])
def test_near_groups_with_chains(spark, monkeypatch, signature_block, set_block, shingle_block):
    """Chains of edits, groups of copies, and texts at and next to the threshold, in one block or in many."""
    monkeypatch.setattr(near_dedup, "SIGNATURE_BLOCK", signature_block)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", set_block)
    monkeypatch.setattr(near_dedup, "SHINGLE_BLOCK", shingle_block)
    rng, rows = random.Random(2), []
    for group in range(12):
        text = [f"g{group}w{i}" for i in range(80)]
        for step in range(12):
            rows.append((len(rows), " ".join(text)))
            at = rng.randrange(80)
            text = text[:at] + [f"e{rng.random()}"] * rng.randint(0, 2) + text[at + 1:]
    shared = [f"p{i}" for i in range(50)]
    rows += [(len(rows) + i, " ".join(shared + [f"t{i}x{j}" for j in range(rng.randint(5, 60))])) for i in range(60)]
    got = by_id(near_dedup.near_duplicates(documents(spark, rows, clashing=False)), "n_shingles", "component_id")
    assert got == brute.near(rows)


def test_long_texts_of_a_family_lie_in_more_blocks(spark):
    rows = [(i, 1, 100) for i in range(600)] + [(i, 2, 3 << 20) for i in range(600, 604)] + [(604, 3, 1)]
    members = spark.createDataFrame(rows, "doc_id long, family long, n_shingles long")
    assert {r.family: r.blocks for r in near_dedup._family_blocks(members).collect()} == {1: 2, 2: 12, 3: 1}


def test_estimate_is_corrected_for_chance(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = []
    for i, share in enumerate((0.2, 0.5, 0.8)):
        both = [f"b{i}x{j}" for j in range(int(2000 * share))]
        alone = (2000 - len(both)) // 2
        rows += [(2 * i, " ".join(both + [f"l{i}x{j}" for j in range(alone)])), (2 * i + 1, " ".join(both + [f"r{i}x{j}" for j in range(alone)]))]
    sketch = near_dedup.sketches(documents(spark, rows, clashing=False))
    a, b = sketch.alias("m"), sketch.alias("t")
    e = near_dedup.estimate([F.col(f"m.{c}") for c in near_dedup.SIGNATURE], [F.col(f"t.{c}") for c in near_dedup.SIGNATURE])
    got = a.join(b, F.expr("m.doc_id + 1 = t.doc_id and m.doc_id % 2 = 0")).select("m.doc_id", e.alias("e")).collect()
    assert all(abs(r.e - (0.2, 0.5, 0.8)[r.doc_id // 2]) < 0.2 for r in got) and len(got) == 3


def test_substring_dedup(spark, docs):
    got = by_id(substring_dedup.without_repeats(docs), "n_words", "n_removed", "kept_sha256")
    assert got == brute.without_repeats(pairs())
    assert got[2][1] == 60 and got[11][1] == 60_000
    texts = by_id(substring_dedup.without_repeats(docs, with_text=True), "kept_text")
    assert texts[11] == ("x",)


def test_substring_dedup_without_ids(spark):
    got = substring_dedup.without_repeats(documents(spark, ROWS[:1] + NULL_ID[:1] + ROWS[:1])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 60), (1, 0), (1, 0)]


def test_substring_alignments_and_buckets(spark, monkeypatch):
    """Passages of 12, 13 and more words at every alignment, over many buckets."""
    monkeypatch.setattr(substring_dedup, "bucket_count", lambda docs, text_col, size: 5)
    rng, rows = random.Random(3), []
    passage = [f"p{i}" for i in range(40)]
    for i in range(80):
        n = rng.choice([11, 12, 13, 14, 20, 40])
        at = rng.randrange(41 - n)
        rows.append((i, " ".join([f"a{i}x{j}" for j in range(rng.randrange(16))] + passage[at:at + n] + [f"b{i}x{j}" for j in range(rng.randrange(9))])))
    got = by_id(substring_dedup.without_repeats(documents(spark, rows, clashing=False)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.without_repeats(rows)


def test_windows_of_equal_hash_are_told_apart(spark, monkeypatch):
    """The first hash of windows takes 16 values only; the second one still keeps different windows apart."""
    plain = substring_dedup._Bucket.runs

    def runs(self, size):
        hashes, places = plain(self, size)
        return (hashes & hashes.dtype.type(15) if size == 13 else hashes), places

    monkeypatch.setattr(substring_dedup._Bucket, "runs", runs)
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(20)]
    rows = [(i, " ".join([f"d{i}w{j}" for j in range(rng.randrange(30))] + (shared if i % 4 == 0 else []) + [f"d{i}v{j}" for j in range(20)])) for i in range(60)]
    got = by_id(substring_dedup.without_repeats(documents(spark, rows, clashing=False)), "n_words", "n_removed", "kept_sha256")
    assert got == brute.without_repeats(rows)


def test_language_scores(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "bucket_count", lambda docs, text_col, size: 3)
    got = by_id(lm.language_scores(docs), "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for i, want in brute.language(pairs(), lm.PRIOR).items():
        assert got[i][:3] == want[:3] and got[i][3] == pytest.approx(want[3], rel=1e-9)
        assert got[i][4] == pytest.approx(want[4], abs=0.02 * want[0])


def test_language_scores_split_hot_contexts(spark, monkeypatch):
    """One context holds most tokens; its successors are spread over parts."""
    monkeypatch.setattr(lm, "bucket_count", lambda docs, text_col, size: 4)
    rng = random.Random(5)
    rows = [(i, " ".join(x for _ in range(50) for x in ("the", f"w{rng.randrange(300)}"))) for i in range(60)]
    got = by_id(lm.language_scores(documents(spark, rows, clashing=False)), "score", "n_tokens")
    for i, want in brute.language(rows, lm.PRIOR).items():
        assert got[i][0] == pytest.approx(want[4], abs=0.02 * want[0])


def test_language_scores_without_ids(spark):
    got = lm.language_scores(documents(spark, NULL_ID)).collect()
    assert len(got) == 2 and all(r.doc_id is None and not r.held_out for r in got)


def test_packing(spark, docs, tokenizer):
    rows = [tuple(r) for r in packing.harmonic_pack(docs.unionByName(docs.limit(1)), tokenizer, 1).collect()]
    by_doc = {}
    for doc_id, start, length, crc, tokens, sequence, offset in rows:
        by_doc.setdefault(doc_id, []).append((start, length, tokens))
    assert set(by_doc) == {r[0] for r in ROWS}
    assert by_doc[5] == [(0, 1, 1)]
    assert sum(n for p in by_doc.values() for _, n, _ in p) == sum(p[0][2] for p in by_doc.values()) + by_doc[1][0][2]


@pytest.mark.parametrize("tokens", [1, 2, 127, 128, 129, 1023, 1024, 1025, 2047, 2048, 2049, 6001])
def test_cuts_cover_a_document(tokens):
    found = packing.cuts(tokens)
    assert sum(n for n, _ in found) == tokens and all(n * k <= packing.CAPACITY for n, k in found)


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from eventmart.llm.tokens import Encoder
    mine = {n: Encoder(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}
    alphabet = st.one_of(st.sampled_from(list(" \n\t.,'’sSé́  ​　\x1c\x85A1_<|>-")), st.characters(exclude_categories=["Cs"]))

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.one_of(st.text(alphabet, max_size=6), st.sampled_from([" ", "  ", "\n", " \n", "word", "Été", "it's", "###", ",", "."])), max_size=12))
    def same(parts):
        text = "".join(parts)
        for encoder in mine.values():
            want = encoder._tokenizer.encode(text, add_special_tokens=False).ids
            assert encoder.ids(text) == b"".join(i.to_bytes(4, "little") for i in want)
    same()


def test_token_files(spark, docs, tokenizer):
    folder = work_dir(spark, "tokens")
    rows = docs.unionByName(documents(spark, NULL_ID))
    token_files.write_token_files(rows, folder, tokenizer, 1, 4)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, *[r[0] for r in ROWS]]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]


def test_token_files_are_read_by_several_tasks(spark, tokenizer):
    folder = work_dir(spark, "tokens")
    rows = documents(spark, [(i, f"one two {i}") for i in range(1000)]).unionByName(documents(spark, NULL_ID))
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        token_files.write_token_files(rows, folder, tokenizer, 1, 4).count()
    got = token_files.read_token_files(spark, folder)
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    whole = sorted(map(tuple, got.collect()), key=str)
    small = token_files.read_token_files(spark, folder, step=3, docs=7)
    assert small.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 20
    assert sorted(map(tuple, small.collect()), key=str) == whole and len(whole) == 1002


def test_quality_of_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, None), (4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs.unionByName(documents(spark, NULL_ID)), labels).collect()
    assert len(got) == len(ROWS) + 2 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (brute.fold(r.doc_id) == 0) for r in got)
    assert quality.keep_good(docs, labels).columns == docs.columns
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_machine_sums_pairs():
    import numpy as np
    rng = np.random.default_rng(0)
    m = quality.Machine()
    m.weights[:] = rng.normal(size=quality.FEATURES)
    feature, value, bounds = rng.integers(0, quality.FEATURES, 30), rng.random(30), np.array([0, 10, 10, 30])
    want = []
    for a, b in zip(bounds, bounds[1:]):
        f, x = feature[a:b], value[a:b]
        want.append(m.bias + float(m.weights[f] @ x) + sum(
            float(m.vectors[f[i]] @ m.vectors[f[j]]) * x[i] * x[j] for i in range(len(f)) for j in range(i)))
    assert m.margins(feature, value, bounds) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_neighbours(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 2.0], 1), (1, [3.0, 0.0], 1), (2, [3.0, 0.0], 2), (3, None, 1), (4, [0.0, 0.0], 1),
            (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [-1.0, 0.0], 1), (40, [1.0, 2.0, 3.0], 1),
            (None, [9.0, 9.0], 1), (1, [3.0, 0.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    got = sorted(tuple(r) for r in neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 3.0), (0, 2, 2, 3.0), (0, 3, 20, 0.0), (0, 4, 8, -1.0),
                   (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0), (20, 4, 8, 0.0)]
    assert neighbours.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_over_shards_with_copies(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[::3] = x[0]  # a third are equal
    vectors = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, shard=250).toPandas()
    score = x.astype(np.float64) @ x.astype(np.float64).T
    found = 0
    for q in range(0, 900, 20):
        s = score[q].copy()
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        found += len(set(best) & set(got[got.query_id == q].vec_id))
    assert found >= 0.95 * 45 * 20 and len(got) == 45 * 20


def test_neighbours_of_very_different_lengths(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1:5] *= np.array([[1e3], [3e3], [1e6], [1e-3]])
    x[20] *= 1e150  # a query of any length
    vectors = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    found = 0
    for q in range(0, 2000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(2000), -s))[:20]
        found += len(set(best) & set(got[got.query_id == q].vec_id))
    assert found >= 0.95 * 100 * 20 and len(got) == 100 * 20


def test_chat(spark):
    said = [(1, 1, "assistant", "a\\b ### </turn>"), (1, 0, "user", None), (2, 0, None, "\\"), (2, None, "assistant", ""),
            (None, 0, "a: b\\", "é\U0001f600\n"), (1, 1, "assistant", "a\\b ### </turn>"), (3, 0, "assistant", "x" * 2_500_000), (3, 1, "assistant", "</turn>\n### assistant: ")]
    talk = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit(1)).withColumn("loss", F.lit(1))
    chunks = chat.formatted(talk)
    assert {r.conv_id: r.n for r in chunks.groupBy("conv_id").agg(F.count("*").alias("n")).collect()}[3] == 2
    for row in chunks.collect():
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in said if r[0] == row.conv_id), key=key)]
        if row.conv_id != 3:
            assert list(chat.turns_of(row.text)) == turns
            assert [chat.unescape(row.text[a:b]) for a, b in row.loss] == [t for r, t in turns if r == "assistant" and t]
    got = {r.conv_id: r for r in chat.digests(chunks).collect()}
    assert got[3].n_turns == 2 and got[3].loss_chars == 2_500_000 + 23 and got[2].loss_chars == 0
    assert chat.digests(chat.formatted(chat.with_probe(talk.limit(0)))).count() == 1


def test_template_language():
    run = lambda source, **context: "".join(t for t, _ in chat.compile_template(source)(context))
    assert run("{% if a and not b %}x{% elif b == 'q' %}y{% else %}z{% endif %}", a=1, b="q") == "y"
    assert run("{% for x in xs %}{{ loop.index }}{{ x['k'] | upper }}{% if loop.first %}!{% endif %}{% endfor %}", xs=[{"k": "a"}, {"k": "b"}]) == "1A!2B"
    assert chat.fold_body(chat.parse('a{{ "b" ~ 1 }}{% if 1 == 2 %}no{% else %}c{% endif %}'), chat.FILTERS) == [("text", "ab1c")]
    assert chat.fold_body(chat.parse('a{{ "b" | upper }}{% if 1 == 2 %}no{% else %}c{% endif %}'), chat.FILTERS) == [("text", "aBc")]
    whole = ('<s>{% for m in messages %}{{ loop.index }}{% if loop.first %}<S>{% endif %}{{ m.text }}{% if not loop.last %};{% endif %}{% endfor %}END')
    assert run(whole, messages=iter([{"text": "a"}, {"text": "b"}])) == "<s>1<S>a;2bEND" and run(whole, messages=iter(())) == "<s>END"
    assert chat.takes_a_stream(whole) and chat.takes_a_stream(chat.TEMPLATE) and chat.takes_a_stream("no turns")
    assert not chat.takes_a_stream("{{ messages[0].text }}") and not chat.takes_a_stream("{% for x in y %}{% for m in messages %}{% endfor %}{% endfor %}")
    assert list(chat.compile_template("a{% generation %}{{ x }}{% endgeneration %}")({"x": "b"})) == [("a", False), ("b", True)]
    assert run("{{ x.__class__ }}{{ x.real }}", x=1) == ""  # lookups see keys only
    for bad in ("{% if a %}", "{% import os %}", "{{ f() }}", "{{ a | nothing }}", "{% endfor %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_empty_tables(spark, empty, tokenizer):
    assert exact_dedup.exact_copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0
    assert mixing.fair_mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_duplicates(empty).count() == 0
    assert substring_dedup.without_repeats(empty).count() == 0 and lm.language_scores(empty).count() == 0
    assert packing.harmonic_pack(empty, tokenizer, 1).count() == 0
    folder = work_dir(spark, "tokens")
    token_files.write_token_files(empty, folder, tokenizer, 1, 4)
    assert token_files.read_token_files(spark, folder).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_scores(empty, labels).count() == 0 and quality.keep_good(empty, labels).count() == 0


def test_pipeline_against_plain_version(spark, tmp_path):
    """Every stage on its own input, against plain versions; the classifier against its own scores."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 120))) for _ in range(120)]
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [(200 + i, texts[i].replace(" ", "  "), "s1") for i in range(10)]
    rows += [(300 + i, texts[20 + i] + " more", "s2") for i in range(20)]
    rows += [(400 + i, "### $$$ %%% *** " * 20, "s3") for i in range(5)] + [(500, None, None), (None, "no id", None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(400 + i, 0, 0) for i in range(5)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(f.columns == docs.columns for f in seen[:5])
    good, exact, near, mixed = [[(r.doc_id, r.text, r.source) for r in f.collect()] for f in seen[1:5]]
    scores = quality.quality_scores(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((r[0] for r in good), key=lambda x: (x is None, x or 0)) == sorted((r.doc_id for r in scores if r.predicted), key=lambda x: (x is None, x or 0))
    want = brute.exact([r[:2] for r in good])
    assert sorted(exact, key=key) == sorted((good[i] for i, (k, _) in want.items() if k == good[i][0]), key=key)
    components = brute.near([r[:2] for r in exact if r[0] is not None])
    assert sorted(near, key=key) == sorted((r for r in exact if r[0] is None or components[r[0]][1] == r[0]), key=key)
    taken = {d: (t // n if n else 0) for d, n, _, _, t in brute.mix([(r[0], r[2], r[1]) for r in near])}
    with_words = [r for r in mixed if brute.words(r[1])]
    assert sorted((r[0] for r in with_words), key=lambda x: (x is None, x or 0)) == sorted(
        (d for d, n in taken.items() for _ in range(n)), key=lambda x: (x is None, x or 0))
    packed = seen[5].collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0)
    assert sum(r.start == 0 for r in packed) == len(mixed)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)


def test_a_conversation_is_rendered_as_one(spark, monkeypatch):
    """Text before and after the turns comes once, turns are counted through chunks, and a template may look at turns twice."""
    monkeypatch.setattr(chat, "CHUNK", 4)
    talk = spark.createDataFrame(
        [(c, t, "user", f"c{c}t{t}") for c in (1, 2) for t in range(5)] + [(3, 0, "user", None)], "conv_id long, turn long, role string, text string")

    def rendered(template):
        rows = sorted(chat.formatted(talk, template).collect(), key=lambda r: (r.conv_id, r.chunk))
        return {c: [r.text for r in rows if r.conv_id == c] for c in (1, 2, 3)}

    streamed = rendered("<{% for m in messages %}{{ loop.index }}{{ m.text }}{% endfor %}>")
    assert streamed[1] == ["<1c1t0", "2c1t1", "3c1t2", "4c1t3", "5c1t4", ">"] and streamed[3] == ["<1>"]
    twice = rendered("{{ messages[0].text }}:{% for m in messages %}{{ m.text }}{% endfor %}")
    assert "".join(twice[2]) == "c2t0:" + "".join(f"c2t{t}" for t in range(5)) and twice[3] == [":"]


def test_an_id_too_wide_is_an_error(spark, tmp_path):
    import public_tokenizers
    with pytest.raises(Exception, match="does not fit"):
        token_files.write_token_files(documents(spark, ROWS[:1]), str(tmp_path), public_tokenizers.path("word_bpe_49k.json"), end_id=2, id_bytes=1)
