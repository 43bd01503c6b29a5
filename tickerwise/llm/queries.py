"""The registered queries opN_<name>, one per operator, over whole tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerwise.llm import langid, sql, warc
from tickerwise.llm.chat import chat_digests, format_chats
from tickerwise.llm.collocations import collocations
from tickerwise.llm.common import Workspace, read
from tickerwise.llm.decontaminate import contamination
from tickerwise.llm.jaccard import ngram_jaccard
from tickerwise.llm.lines import line_dedup
from tickerwise.llm.nearest import nearest
from tickerwise.llm.packing import pack
from tickerwise.llm.secrets import scan_secrets
from tickerwise.llm.sharding import shard_by_bytes
from tickerwise.llm.substring import substring_dedup
from tickerwise.llm.trie import ordered_turns, prefix_trie, spliced

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
PROBE = "</s>[INST] ok [/INST]"  # conversation -1 says the template's own control strings


def query(name: str, twin: str | None = None):
    def add(f):
        QUERIES[name] = f
        if twin:
            ORACLE_SQL[name] = twin
        return f
    return add


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (declared language, source as host) and every raw page (html lang, host, suffix)."""
    docs, pages = read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages")
    languages, logp = langid.train(docs.select("text", "lang"))
    items = langid.document_items(docs).unionByName(langid.page_items(pages))
    out = langid.identify(items, languages, logp, Workspace(spark))
    return out.select("key.doc_id", "key.page_id", "language", "posterior", "text_language", "trigrams", langid.accepted().alias("accepted"))


@query("op2_line_dedup", sql.LINES)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more in three documents or more stay in the largest doc_id only."""
    return line_dedup(read(spark, sf_dir, "documents"), min_chars=20, min_docs=3).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op3_decontamination", sql.CONTAMINATION)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document words inside an occurrence of ten consecutive words of a benchmark item."""
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10).drop("spans", "items", "mark")


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4,096 tokens."""
    return pack(read(spark, sf_dir, "documents"), tokenizer_path(), window=4096, end_id=2)


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes, equal texts together."""
    return shard_by_bytes(read(spark, sf_dir, "documents"), shards=24)


@query("op6_warc_derivatives", sql.WARC)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return warc.derivatives(warc.responses(read(spark, sf_dir, "pages"))).drop("record", "date")


@query("op7_chat_format", sql.CHAT)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted, read back and digested."""
    probe = spark.range(2).selectExpr("cast(-1 as bigint) as conv_id", "cast(id as int) as turn", "if(id = 0, 'user', 'assistant') as role",
                                      f"'{PROBE}' as text")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(format_chats(rows.unionByName(probe)))


@query("op8_substring_dedup", sql.SUBSTRING)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows that also start in a document with a smaller doc_id lose their words."""
    return substring_dedup(read(spark, sf_dir, "documents"), window=13, start=7)


@query("op9_nearest")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of every row whose vec_id is divisible by 100."""
    rows = read(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


@query("op10_ngram_jaccard", sql.JACCARD)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of 3-word shingles, similarity >= 90/100, connected components."""
    return ngram_jaccard(read(spark, sf_dir, "documents"), shingle=3, num=90, den=100, lower=True)


@query("op11_collocations", sql.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 most cohesive phrases of two to five words of each language."""
    return collocations(read(spark, sf_dir, "documents"), longest=5, at_least=100, absorb=100, top=2000).drop("left_extensions", "right_extensions")


@query("op12_prefix_trie", sql.TRIE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each begun with turns of the first conversation of its block of five."""
    work = Workspace(spark)
    convs, turns = spliced(ordered_turns(read(spark, sf_dir, "conversations"), work), work, every=5, heads=9)
    return prefix_trie(convs, turns, work).drop("node")


@query("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: fixed patterns and novel strings in a sensitive context."""
    return scan_secrets(read(spark, sf_dir, "documents")).drop("n_novel")
