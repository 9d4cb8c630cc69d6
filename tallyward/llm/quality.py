"""Quality rules: text statistics, then a hashed n-gram log-likelihood ratio of trusted text against the corpus.

Every document's words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets are
fitted: the raw one on all documents, the target one on trusted documents. A document's score is the mean over its
n-grams (and ``PRIOR`` neutral ones) of log(target / raw); it is kept if no base rule fails and the score reaches a threshold taken from trusted
documents that took no part in the fit.

Logarithms are rounded to millionths and summed as integers, so that scores do not depend on how rows are dealt out.
NULL and empty texts have no words and fail the base rule. Rows with equal texts get equal results; rows without a key are judged like
others. Without trusted documents, or on an empty table, the base rules decide alone. Other columns stay as they are, but for
columns named like a result, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import Block, blocks, of_row, repeats, table_of
from tallyward.operators.order_stats import quantile_rows
from tallyward.operators.staging import stage

#: Slots of the multinomials. The model is two counts for each, whatever the corpus.
BUCKETS = 1 << 16
#: One trusted document in so many calibrates the threshold instead of training.
HELD_OUT = 4
#: Share of the trusted, held-out documents that pass the base rules which may fall below the threshold, and how far
#: (in nats an n-gram) the threshold lies below that.
TAIL, MARGIN = 0.005, 0.08
#: Scores are divided by the number of n-grams and this many more, so that chance does not reject a short text.
PRIOR = 20
#: Pseudo-count of every bucket.
PSEUDO = 8.0

_MICRO = 1e6
_SYMBOL = table_of(b"#*$%&|<>")
RESULTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def statistics(block: Block, hashes: np.ndarray, words) -> dict[str, np.ndarray]:
    """Counts of the base rules for each text of a block."""
    spaces = block.code_points()
    inside = np.zeros(len(block.data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    lines = block.lines()
    with_word = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    spare, _ = repeats(of_row(lines.hashes()[with_word], lines.row[with_word]))
    at, runs = words.windows(hashes, 5)
    _, shared = repeats(of_row(runs, words.row[at]))
    edge = np.zeros(len(words) + 1, np.int64)
    edge[at[shared]] += 1
    edge[at[shared] + 5] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return {
        "n_words": words.counts,
        "word_chars": block.per_text(spaces & inside),
        "n_symbols": block.per_text(_SYMBOL[block.data]),
        "n_dup_lines": np.bincount(lines.row[with_word][spare], minlength=block.rows),
        "n_repeat_words": np.bincount(words.row[covered], minlength=block.rows),
    }


def _ngrams(words, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each word and of each pair of adjacent words."""
    at, pairs = words.windows(hashes, 2)
    slots = np.concatenate([hashes, pairs]) & np.uint64(buckets - 1)
    return slots.astype(np.int64), np.concatenate([words.row, words.row[at]])


def _counter(buckets: int):
    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part, block in blocks(batches):
            words = block.words()
            slots, row = _ngrams(words, words.hashes(), buckets)
            trusted = part.column("__trusted").to_numpy(zero_copy_only=False)
            raw += np.bincount(slots, minlength=buckets)
            target += np.bincount(slots[trusted[row]], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                         ["bucket", "raw", "target"])

    return count


def _scores(block: Block, words, hashes: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    slots, row = _ngrams(words, hashes, len(ratios))
    total = np.bincount(row, ratios[slots], block.rows)  # whole numbers below 2 ** 53, so the sum is exact
    return total / (np.bincount(row, minlength=block.rows) + PRIOR) / _MICRO


def _judge(ratios: np.ndarray, names: list[str]):
    def judge(batches):
        for part, block in blocks(batches):
            words = block.words()
            hashes = words.hashes()
            found = statistics(block, hashes, words) | {"score": _scores(block, words, hashes, ratios)}
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names] + [pa.array(v) for v in found.values()], names + list(found))

    return judge


def trusted_keys(labels: DataFrame, key: str, trusted: Column) -> DataFrame:
    """Keys of all trusted documents."""
    return labels.where(trusted & F.col(key).isNotNull()).select(F.col(key).alias("__key")).distinct()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", trusted: Column | None = None,
        buckets: int = BUCKETS) -> tuple[np.ndarray, float | None]:
    """Log ratios by bucket in millionths, and the threshold (None without held-out trusted documents)."""
    trusted = (F.col("quality") == 1) & (F.col("toxic") == 0) if trusted is None else trusted
    keys = stage(trusted_keys(labels, key, trusted).withColumn(
        "__trusted", F.pmod(F.xxhash64(F.lit("held"), "__key"), F.lit(HELD_OUT)) != 0), "trusted")
    texts = docs.select(F.col(key).alias("__key"), "text")
    # Keys grow with the corpus, so they are not sent to every executor. Texts without a key are dealt out by a hash.
    spread = texts.withColumn("__spread", F.when(F.col("__key").isNull(), F.xxhash64("text")).otherwise(0))
    flagged = spread.join(keys.withColumn("__spread", F.lit(0).cast("long")).hint("shuffle_hash"), ["__key", "__spread"], "left")
    counted = (flagged.select("text", F.coalesce("__trusted", F.lit(False)).alias("__trusted"))
               .mapInArrow(_counter(buckets), "bucket long, raw long, target long")
               .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, all_of_it, of_target in counted.collect():  # one row a bucket
        raw[bucket], target[bucket] = all_of_it, of_target
    if target.sum() == 0:
        return np.zeros(buckets, np.int64), None
    # Both multinomials at the size of the target sample, with the same pseudo-count, so that buckets with few
    # n-grams say little.
    expected = raw / raw.sum() * target.sum()
    ratios = np.round(np.log((target + PSEUDO) / (expected + PSEUDO)) * _MICRO).astype(np.int64)
    # Scores meet the keys without their texts.
    scores = judged(texts, ratios, None).where(~F.col("base_failed")).select("__key", "score")
    held = stage(scores.join(keys.where(~F.col("__trusted")), "__key").select("score"), "held")
    found = quantile_rows(held, "score", [TAIL]).collect()  # one row or none
    low = found[0]["quantile"] if found else None
    return ratios, None if low is None else low - MARGIN


def judged(docs: DataFrame, ratios: np.ndarray, threshold: float | None) -> DataFrame:
    """``docs`` with the statistics, the score and the verdict."""
    names = [c for c in docs.columns if c not in {*(x.split()[0] for x in RESULTS.split(", ")), "score", "base_failed", "kept"}]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    found = docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(
        _judge(ratios, names), f"{kinds}, {RESULTS}, score double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = F.lit(True) if threshold is None else F.col("score") >= F.lit(threshold)
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes)


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """Fit on the tables given, then judge every row of ``docs``."""
    return judged(docs, *fit(docs, labels, key, **settings))
