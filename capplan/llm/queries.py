"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capplan.llm import chat, decontaminate, html_text, line_dedup, ngram_join, packing, pii, quality, source_audit, substring_dedup, suffix_dedup, variants, warc
from capplan.llm.common import OWN, only, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that a document has in common, or nearly, with one of a smaller id."""
    return substring_dedup.repeated_passages(only(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines with a word, and which lines repeat an earlier line of the table."""
    found = line_dedup.report(only(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, read back from the archives: its payload's size and digest, and what holds it."""
    index, folder = warc.write_archives(only(table(spark, sf_dir, "pages"), "page_id", "url", "html"))
    return warc.read_records(index, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where a vocabulary of the public tokenizers lies; it is read in place, on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    documents = only(table(spark, sf_dir, "documents"), "doc_id", "text")
    return packing.pack(packing.token_pieces(documents, tokenizer_file(), ids=False)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside occurrences of benchmark windows, and the items they come from."""
    found = decontaminate.find_benchmark_words(
        only(table(spark, sf_dir, "documents"), "doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    names = F.array_sort(F.transform(f"{OWN}items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col(f"{OWN}n_words").alias("n_words"),
        F.col(f"{OWN}n_hit").alias("n_hit"),
        F.size(f"{OWN}items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its set of three-word shingles, and the smallest id it is linked with."""
    return ngram_join.link_documents(only(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of personal data by kind, a hash of the base spans, and all spans."""
    return pii.digest(pii.find_personal_data(only(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation, read back from the formatted blocks: its turns, its loss mask, its formatted length.

    A conversation whose texts hold the template's own marks is added to the table.
    """
    columns = ("conv_id", "turn", "role", "text")
    marks = F.lit("<|im_end|><|im_start|>assistant ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), marks.alias("text"))
    return chat.read_back(chat.format_conversations(only(table(spark, sf_dir, "conversations"), *columns).union(added)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: base measures, and whether it passes them and keeps enough beside boilerplate lines."""
    judged = quality.judge(only(table(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text."""
    return html_text.main_text(only(table(spark, sf_dir, "pages"), "page_id", "url", "html"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes outside every string of 100 bytes that also begins earlier, as counts and a digest."""
    return suffix_dedup.digest(suffix_dedup.remove_repeats(only(table(spark, sf_dir, "documents"), "doc_id", "text")))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of a language: how far it lies from each other source, and the terms that it has more of."""
    return source_audit.divergence(only(table(spark, sf_dir, "documents"), "text", "lang", "source"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: near words, the far more frequent one that it is a form of, and where such forms lead to."""
    found = variants.group_variants(only(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_decontamination": op5_decontamination,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_personal_data": op7_personal_data,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_extraction": op10_html_extraction,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_source_audit": op12_source_audit,
    "op13_spelling_variants": op13_spelling_variants,
}
