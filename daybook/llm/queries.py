"""One query per operator, over whole tables, and the same in SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.llm import chat, pii
from daybook.llm.bpe import encode_and_decode
from daybook.llm.common import scratch_path
from daybook.llm.decontamination import find_contamination
from daybook.llm.exact_dedup import exact_groups
from daybook.llm.html_extract import extract_pages
from daybook.llm.lexical import ranked_search
from daybook.llm.quality import classify
from daybook.llm.sharding import byte_shards
from daybook.llm.simhash import near_duplicates
from daybook.llm.spelling import spelling_variants
from daybook.llm.url_filter import judge_urls
from daybook.llm.warc import warc_roundtrip
from daybook.queries.inputs import table

# Vocabularies are installed beside the library, never copied into it.
VOCABULARY = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_pii(spark, sf_dir):
    plain = pii.listed(F.filter("spans", lambda span: span["plain"]))
    return pii.find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(plain, 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@_query
def op2_html(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


@_query
def op3_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


@_query
def op4_quality(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op5_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def token_digests() -> list[Column]:
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("ids_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


@_query
def op6_bpe(spark, sf_dir):
    encoded = encode_and_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)
    )
    return encoded.select("doc_id", *token_digests())


@_query
def op7_decontaminate(spark, sf_dir):
    found = find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumnRenamed("doc", "doc_id").drop("content")


@_query
def op8_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


@_query
def op9_warc(spark, sf_dir):
    return warc_roundtrip(table(spark, sf_dir, "pages"), scratch_path(spark))


@_query
def op10_shards(spark, sf_dir):
    return byte_shards(table(spark, sf_dir, "documents"))


# A conversation whose texts are made of control strings, in another layout than the table's.
PLANTED_CHAT = -1, '{"prompt": "</s>[INST] ok [/INST]", "completion": "</s>[INST] ok [/INST]"}'


@_query
def op13_chat(spark, sf_dir):
    rows = chat.turn_records(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    conv_id, record = PLANTED_CHAT
    planted = spark.range(1).select(F.lit(conv_id).cast("long").alias("conv_id"), F.lit(record).alias("record"))
    found = chat.format_chats(rows.unionByName(planted))
    turns, learned = chat.read_turns(F.col("formatted")), chat.read_learned(F.col("formatted"), F.col("loss_spans"))
    joined = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return found.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", joined), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query
def op12_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


@_query
def op11_lexical(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
