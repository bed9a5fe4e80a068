"""From raw documents to token ids, one operator per stage.

Every stage reads all rows that the one before it kept. All but the last return the
columns of documents. Each stage's result is written to the shared folder and read
again, so a failure never reaches back beyond it.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daybook.llm.bpe import encode_and_decode
from daybook.llm.common import stored
from daybook.llm.decontamination import drop_contaminated
from daybook.llm.exact_dedup import drop_exact_copies
from daybook.llm.quality import keep_good
from daybook.llm.queries import VOCABULARY, token_digests
from daybook.llm.simhash import drop_near_duplicates
from daybook.queries.inputs import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts: that with the largest doc_id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group that SimHash links connect: that with the smallest doc_id.

    Shingles of four words and at most four differing bits, as op5_simhash.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, its token ids, their number, and digests of them and of the text decoded again."""
    encoded = encode_and_decode(docs, public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", "ids", *token_digests())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

# A trained classifier and hashes that SQL lacks: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
