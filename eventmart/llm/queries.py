"""The named queries of the operators: each applies its operator to a whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from eventmart.llm import (
    chat, decontamination, exact_dedup, filter_audit, hard_negatives, lm, mixing, near_dedup, neighbours, oracles, packing, quality,
    substring_dedup, token_files,
)
from eventmart.llm.common import table
from eventmart.session import work_dir

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


@query("op1_language_scores")
def op1_language_scores(spark, sf_dir):
    return lm.language_scores(table(spark, sf_dir, "documents"))


@query("op2_harmonic_packing")
def op2_harmonic_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.harmonic_pack(table(spark, sf_dir, "documents"), path, end_id=1)


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query("op4_source_mix", oracles.SOURCE_MIX)
def op4_source_mix(spark, sf_dir):
    mix = mixing.fair_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_near_dedup")
def op5_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    folder = work_dir(spark, "token-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, path, end_id=2, id_bytes=2)
    return token_files.read_token_files(spark, folder)


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op8_quality")
def op8_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_exact_dedup", oracles.EXACT_DEDUP)
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


@query("op10_chat_format", oracles.CHAT_FORMAT)
def op10_chat_format(spark, sf_dir):
    return chat.digests(chat.formatted(chat.with_probe(table(spark, sf_dir, "conversations"))))


@query("op11_filter_audit", oracles.FILTER_AUDIT)
def op11_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_decontamination", oracles.DECONTAMINATION)
def op12_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_hard_negatives", oracles.HARD_NEGATIVES)
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
