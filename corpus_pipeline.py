"""A training corpus from documents: toxic documents and near-duplicates go, personal data is masked, sources are mixed
to target weights, and what is left is packed into sequences."""

from __future__ import annotations

from sampletide.llm import minhash, mixing, packing, pii, toxicity
from sampletide.llm.common import table, written


def remove_toxic(spark, docs, sf_dir):
    """Documents that the classifier, learned from labels of this stage's documents, finds toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), written)


def remove_near_duplicates(spark, docs, sf_dir):
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return minhash.without_near_duplicates(docs, written)


def mask_personal_data(spark, docs, sf_dir):
    """Personal data is replaced by its kind; every document stays."""
    return pii.redact(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated or dropped as their source's target asks."""
    return mixing.mix(docs, written)


def pack_sequences(spark, docs, sf_dir):
    """Documents in sequences of 2,048 words: one row per piece."""
    return packing.pack(docs, written)


STAGES = [("toxicity", remove_toxic), ("near_duplicates", remove_near_duplicates), ("pii", mask_personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# Learned classifiers and best-fit bins have no SQL form: tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
