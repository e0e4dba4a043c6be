"""The registered queries: against SQL where there is some, else against plain versions."""

import zlib

import duckdb
import numpy as np
import pytest

import check_oracle
from eventmart.llm import lm
from eventmart.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.helpers import SF_DIR, by_id, needs_tables, table_rows

pytestmark = needs_tables


@pytest.fixture(scope="module")
def results(spark):
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, SF_DIR).toPandas()
        return kept[name]
    return run


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for table in check_oracle.TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result, cursor = QUERIES[name](spark, SF_DIR), duck.execute(ORACLES[name])
    assert check_oracle.differing_types(result, cursor.description) == []
    assert check_oracle.normal(result.toPandas()) == check_oracle.normal(cursor.df())


def test_language_scores(results):
    got = results("op1_language_scores").set_index("doc_id")
    want = brute.language(table_rows("documents", "doc_id", "text"), lm.PRIOR)
    assert len(got) == len(want)
    for i, (tokens, known, total, base, score) in want.items():
        row = got.loc[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (brute.fold(i) == 1, tokens, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(score, abs=0.02 * tokens)  # quantised
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_packing(results):
    got = results("op2_harmonic_packing").sort_values(["doc_id", "start"])
    ids = reference_ids("byte_bpe_50k.json", 1)
    assert set(got.doc_id) == set(ids)
    for doc_id, pieces in got.groupby("doc_id"):
        want, at = ids[doc_id], 0
        for p in pieces.itertuples():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(want), zlib.crc32(want[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(want)
    packed = got.sort_values(["sequence_id", "offset"])
    filled = packed.groupby("sequence_id").length
    assert (packed.offset == filled.cumsum() - packed.length).all() and filled.sum().max() <= 2048
    sizes = filled.sum()
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.02 * sizes.sum() + 2048


def reference_ids(name, end):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    rows = table_rows("documents", "doc_id", "text")
    found = tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    return {i: np.array([*e.ids, end], "<u4") for (i, _), e in zip(rows, found)}


def test_token_files(results):
    got, want = results("op6_token_files").set_index("doc_id"), reference_ids("word_bpe_49k.json", 2)
    start = 0
    for i in sorted(want):
        assert tuple(got.loc[i][["start", "n_tokens", "ids_crc32"]]) == (start, len(want[i]), zlib.crc32(want[i].tobytes()))
        start += len(want[i])


def test_substring_dedup(results):
    got = results("op3_substring_dedup").set_index("doc_id")
    want = brute.without_repeats(table_rows("documents", "doc_id", "text"))
    assert {i: tuple(r) for i, r in zip(got.index, got[["n_words", "n_removed", "kept_sha256"]].itertuples(index=False))} == want


def test_near_dedup(results):
    got = results("op5_near_dedup")
    want = brute.near(table_rows("documents", "doc_id", "text"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_neighbours(results):
    got = results("op7_nearest_neighbours")
    rows = table_rows("embeddings", "vec_id", "embedding")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(np.float64)
    found = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        mine = got[got.query_id == ids[i]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and ids[i] not in set(mine.vec_id)
        assert (mine.score.diff().dropna() <= 0).all()
        found, total = found + len(set(ids[best]) & set(mine.vec_id)), total + 20
    assert found >= 0.9 * total
