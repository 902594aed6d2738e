"""From raw documents to token ids: five stages, each over all that the stage before kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is written as Parquet to the shared scratch folder and read
back as the next stage's documents, so that a lost executor repeats one stage at most. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadtide.llm import line_rules, mixing, near_dedup, pieces, secrets
from loadtide.llm.registry import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out; drops documents that fail the base rule or are nearly all boilerplate of their host."""
    return line_rules.passing(docs, remove_lines=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group with similarities of 0.8 or more over shingles of five words."""
    return near_dedup.deduplicated(docs, threshold=0.8, size=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; keeps all documents."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that the sources' words come near their target weights."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document in the mix."""
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_duplicates), ("secret scans", secret_scan),
          ("mixing sources to target weights", mix_sources), ("SentencePiece encoding and decoding", encode_pieces)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage{number + 1}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
