"""A training corpus from documents: quality rules, line dedup, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last return the
columns of docs. Nulls, empty and long texts, repeated rows and other columns: see the operators, which say what they do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkwright.llm import line_dedup, pair_index_bpe, quality_rules, shared, shingle_join, source_mix

#: Near duplicates of a corpus: shingles of five words, Jaccard similarity 0.8. op8_shingle_join has parameters of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that a rule rejects go."""
    return quality_rules.keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go from texts, and with them the rows that are left without a word: all of them stands elsewhere."""
    return line_dedup.dedup_lines(docs, drop_empty=True, whole_runs=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the one with the smallest doc_id stays."""
    return shingle_join.keep_one(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows, in files and order of the mix: by number of the part file and place in it."""
    return source_mix.mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of each text, and its place in the mix: mix_part and mix_row, by which rows sort to the order of the stage before."""
    rows = shared.placed(docs, "mix_part", "mix_row")
    return pair_index_bpe.encode_documents(rows, pair_index_bpe.vocabulary_path(), keep_ids=True, carry=("mix_part", "mix_row")).drop("decoded")


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("shingle_join", near_duplicates), ("source_mix", mixing), ("pair_index_bpe", tokens)]

#: Near duplicates and BPE merges have no SQL form; tests/llm compares stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read by the next."""
    docs = shared.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
