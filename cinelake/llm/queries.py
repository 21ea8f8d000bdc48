"""Registered queries of the training-data operators: each applies its operator,
with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinelake.llm import decontam, digest, hardneg, language, lexical, licenses, line_dedup, packing, quality, simhash, tokenfile, toxicity, warc
from cinelake.llm.common import BPE, PIECES, scratch_path, table


def op1_token_file(spark, sf_dir):
    path = scratch_path(spark, "token-file")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, BPE)
    return tokenfile.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark, sf_dir):
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"), PIECES)


def packed(docs):
    """Pieces of packed sequences with the digest of their ids."""
    return packing.pack(docs, BPE).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_decontamination(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).drop("k1", "k2")


def op11_hard_negatives(spark, sf_dir):
    return hardneg.mine(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_digest(spark, sf_dir):
    return digest.compare_neighbours(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_file, op2_warc, op3_line_dedup, op4_toxicity, op5_language, op6_packing, op7_simhash, op8_decontamination, op9_licenses, op10_quality,
    op11_hard_negatives, op12_lexical_search, op13_digest)}
ORACLE_SQL: dict[str, str] = {"op2_warc": warc.ORACLE_SQL, "op3_line_dedup": line_dedup.ORACLE_SQL, "op9_licenses": licenses.ORACLE_SQL,
    "op11_hard_negatives": hardneg.ORACLE_SQL, "op12_lexical_search": lexical.ORACLE_SQL}
