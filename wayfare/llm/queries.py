"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import bpe, classifier, fillmiddle, katz, licenses, linededup, neardup, packing, rules, search, spotsigs, token_files, urls
from wayfare.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_matrices(spark, sf_dir):
    return token_files.packed_matrices(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_bpe_round_trip(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", F.col("n_lines").cast("long"), F.col("n_dropped").cast("long"), digest.alias("text_sha256"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_co_trained_quality(spark, sf_dir):
    scored = classifier.with_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *classifier.SCORES, (F.col("score") >= classifier.KEEP_FROM).alias("kept"))


def op7_host_quality_rules(spark, sf_dir):
    verdicts = rules.judged(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_filters(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_spot_signatures(spark, sf_dir):
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op10_license_scan(spark, sf_dir):
    found = licenses.scanned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("licenses").cast("long").alias("n_licenses"))


def op11_katz_scores(spark, sf_dir):
    return katz.scored(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark, sf_dir):
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark, sf_dir):
    return fillmiddle.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": linededup.SQL, "op7_host_quality_rules": rules.SQL, "op10_license_scan": licenses.SQL,
        "op12_ranked_search": search.SQL, "op13_fill_in_middle": fillmiddle.SQL,
    }
