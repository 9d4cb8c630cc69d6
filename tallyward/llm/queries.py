"""One query for each operator over the whole of its table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import (
    bpe, chat, curriculum, edit_embedding, infill, pieces, prefix_trie, probminhash, quality, spans, suffixes, urls, wrappers)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Place of the public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_quality_rules(spark, sf_dir):
    """Statistics, score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return found.drop("text")


@query
def op2_url_filter(spark, sf_dir):
    """Rule and verdict of every page's URL."""
    return urls.url_filter(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query
def op3_bpe(spark, sf_dir):
    """Digests of the token ids and of the decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


@query
def op4_sentence_spans(spark, sf_dir):
    """Every document without its repeated sentences."""
    return spans.span_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_probminhash(spark, sf_dir):
    """The near-duplicate class of every document."""
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_chat_template(spark, sf_dir):
    """What the formatted conversations hold, read back from them; one more conversation is full of control strings."""
    rows = table(spark, sf_dir, "conversations")
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    both = rows.select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.format_conversations(both))


@query
def op7_html_wrapper(spark, sf_dir):
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query
def op8_edit_fingerprint(spark, sf_dir):
    """Fingerprints of every document and of its edited text, what they have in common, and the class of nearly equal documents."""
    return edit_embedding.with_classes(table(spark, sf_dir, "documents"))


@query
def op9_suffix_buckets(spark, sf_dir):
    """What is left of every document without long repeated strings."""
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_curriculum(spark, sf_dir):
    """Target, words taken and training positions of every document, in training order."""
    mixed = curriculum.curriculum(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return curriculum.in_training_order(mixed.select("doc_id", "size", "source_size", "target", "taken", "positions"))


def piece_model() -> str:
    """Place of the public SentencePiece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_sentencepiece(spark, sf_dir):
    """Digests of the ids and of the decoded text of every document."""
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


@query
def op12_infill(spark, sf_dir):
    """Form, parts and digests of the fill-in-middle output of every document, and of the text read back from it."""
    return infill.digests(infill.fill_in_middle(table(spark, sf_dir, "documents")))


@query
def op13_prefix_trie(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    turns = prefix_trie.paths(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))


ORACLES["op6_chat_template"] = chat.SQL
ORACLES["op9_suffix_buckets"] = suffixes.SQL
ORACLES["op10_curriculum"] = curriculum.SQL
ORACLES["op13_prefix_trie"] = prefix_trie.SQL
ORACLES["op12_infill"] = infill.SQL
