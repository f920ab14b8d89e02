"""The operators applied to the given tables, whole; see sql.py for what they must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, toxicity
from sluice.llm.common import scratch, written
from sluice.llm.decontaminate import benchmark_hits, words_inside
from sluice.llm.dedup import exact_duplicates
from sluice.llm.filter_audit import METRICS, every_order, mask_cells
from sluice.llm.main_text import extract
from sluice.llm.mixing import by_document, in_training_order, mix
from sluice.llm.packing import pack
from sluice.llm.pii import checked, pseudonymise
from sluice.llm.similarity import similar_components
from sluice.llm.token_files import read_token_files, write_token_files
from sluice.llm.topk import top_k
from sluice.llm.vector_codes import compress

TOKENIZER = "byte_bpe_50k.json"
#: Key of the surrogates in the query; a real run takes a secret one.
DEMO_KEY = b"not a secret: key of the demonstration"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id"), 4) == 2
    found = langid.identify(docs, langid.learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer(), end_id=0, size=1024)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), k=5, percent=75)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = checked(pseudonymise(docs, DEMO_KEY))
    return done.select("doc_id", "text", "n_entities")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id"), 3) == 1
    languages = langid.learn(docs, ~held_out, fast=True)
    classifier = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels"), languages)
    scored = toxicity.classify(docs, classifier)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = write_token_files(docs, scratch(spark, "token-files"), tokenizer(), end_id=2)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = written(mix(table(spark, sf_dir, "documents")), "mix")
    order = written(in_training_order(mixed), "training-order")
    found = by_document(mixed, order)
    return found.select("doc_id", "size", "source_size", "target", "taken", "readings", "first_position")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = words_inside(F.col("spans"))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = mask_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return every_order(cells, "ABCDE").select("part", "filter_order", "step", *METRICS, "shapley")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    digits = F.transform("code", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0"))
    return codes.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_main_text": op3_main_text,
    "op4_ngram_join": op4_ngram_join,
    "op5_pii": op5_pii,
    "op6_topk": op6_topk,
    "op7_toxicity": op7_toxicity,
    "op8_token_files": op8_token_files,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}
