"""Documents to packed training sequences, in stages that each work on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are written to the shared folder
and read again. All stages but the last return the columns of `documents`. Rows without text pass the filters as
empty texts; rows without an id stay unless a copy with an id exists. An empty table gives an empty result.
"""

import public_tokenizers

from eventmart.llm import exact_dedup, mixing, near_dedup, packing, quality
from eventmart.llm.common import stored, table


def keep_good(spark, docs, sf_dir):
    """Without the documents that the quality classifier rejects; it learns from the labelled ones outside its
    held-out fold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark, docs, sf_dir):
    """Of documents that are equal up to white space, the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of linked documents, the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them, three times at most."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.harmonic_pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality classifier", keep_good), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
    ("source mix", mix_sources), ("packing", pack_sequences)]

ORACLE_SQL = None  # the classifier and the tokenizer are beyond SQL; the tests compare with a brute-force version


def run(spark, sf_dir):
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
