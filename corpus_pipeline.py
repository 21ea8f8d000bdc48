"""The corpus pipeline over ``documents``: quality rules, line dedup, SimHash
near-duplicates, benchmark decontamination and packing.

Every stage takes the table that the one before it wrote. All but the last
return the columns of ``documents``; the last returns the pieces of the packed
sequences. The packing needs a tokenizer and the quality rules and fingerprints
whole texts, so no SQL states the rows; tests/llm holds a brute-force version.
"""

from __future__ import annotations

from cinelake.llm import decontam, line_dedup, quality, simhash
from cinelake.llm.common import table, written
from cinelake.llm.queries import packed


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark, docs, sf_dir):
    """Lines that are boilerplate of their host go from every text."""
    return line_dedup.clean_texts(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents contaminated with benchmark passages go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark, docs, sf_dir):
    """The documents left, packed into sequences."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
