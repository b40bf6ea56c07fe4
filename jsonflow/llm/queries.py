"""Queries of the operators in this folder: ``QUERIES`` and, where SQL can tell, ``ORACLES``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jsonflow.llm import alignment, attention, decontaminate, licenses, line_dedup, minhash, packing, phrases, quality_rules, spellings, toxicity, urls, warc
from jsonflow.llm.common import held_out, ready, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return run

    return register


@query(quality_rules.sql_check())
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts and the verdict of the weakly supervised rules."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept votes".split()
    return judged.select(*names, F.round("p_quality", 4).alias("p_quality"))


@query()
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its near copies."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the chunks of lines that occurred before."""
    return line_dedup.removals(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query()
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of two lines or more that occurred before."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.removals(docs, pieces=line_dedup._windows).select("doc_id", "text", "n_lines", "n_removed")


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document that is within a benchmark item's edit budget."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, scored on its restored text."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives give it back."""
    read = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return read.select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to")
    )


@query()
def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, then by the words of its host and path."""
    judged = urls.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("odds", 4).alias("odds"))


@query()
def op5_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, scored on its attended passages."""
    return attention.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 50 bytes that start in an earlier one."""
    removed = phrases.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(spellings.sql_check())
def op11_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its form, its root and its near words."""
    return spellings.group_spellings(table(spark, sf_dir, "documents"))


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two kinds, aligned, with the corpus-wide counts of its links."""
    made = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(licenses.sql_check())
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licenses that its notices name."""
    return licenses.scan(table(spark, sf_dir, "documents"))
