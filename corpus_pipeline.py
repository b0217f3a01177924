"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of documents. ``run`` writes every
stage as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from tessera.llm import exact_dedup, mixing, packing, simhash, toxicity
from tessera.llm.common import stage, table
from tessera.llm.queries import MIX_KEEP, MIX_TARGETS, SEQUENCE, mix_columns, tokenizer_path


def drop_toxic(spark, docs, sf_dir):
    """Documents scored below 0.5 stay; the model is fitted on the labels of ``docs``."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark, docs, sf_dir):
    """One row of each group of equal texts stays."""
    return exact_dedup.deduplicate(docs, exact_dedup.DigestIndex(spark))[0]


def drop_near_copies(spark, docs, sf_dir):
    """One row of each component of near-duplicates stays."""
    return simhash.deduplicate(docs)


def mix(spark, docs, sf_dir):
    """Sampled by calibrated probabilities."""
    dims, words = mix_columns()
    return mixing.sample(docs, dims, MIX_TARGETS, words, MIX_KEEP)


def pack(spark, docs, sf_dir):
    """Placed pieces of at most SEQUENCE tokens."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), 0, SEQUENCE)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies), ("mixing", mix), ("packing", pack)]

# The first stage fits a model, which SQL can't express; tests/llm checks run() against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
