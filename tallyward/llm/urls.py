"""URL filter: listed rules first, then the ratio of two character language models.

A rule names a host and the start of a path; it fits the host and its subdomains, and the longest fitting rule decides. URLs that
rules allow and those that they block train one variable-order Markov model each, over the bytes of host and path:
the probability of a byte after up to ``ORDER`` others is smoothed with that after one fewer, down to the uniform one. URLs
without a rule are judged by the difference of both log-likelihoods per byte. The threshold is calibrated on rule-judged URLs that took no
part in training, as the one with the least sum of both error rates.

Counts are kept by the whole (context, byte) in a staged table that grows with the corpus, so that no two strings share one; every
rule-judged URL is counted, a repeated one each time. The probability of a byte depends on it and the ``ORDER`` bytes before it alone, so each
distinct string of that length is joined with the counts once, and blocks of addresses with the strings that they hold. NULL URLs and those without ``://`` have an empty host and path; empty strings
score 0. With no URL of one class the score is 0 and the verdict allow, and without held-out ones the threshold is 0. An empty table gives
an empty result. Other columns stay; columns named like a result are replaced.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import Block, blocks
from tallyward.operators.staging import stage

#: (verdict, rule), a rule being a host and the start of a path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Bytes of context at most; bytes of addresses that are scored together; weight of the shorter context.
ORDER, SLOTS, SHORTER = 4, 1 << 15, 4.0
#: One rule-judged URL in so many calibrates instead of training.
HELD_OUT = 5
#: Scores fall into this many bins of equal width between these limits, in nats a byte, for calibration.
BINS, LIMIT = 4096, 8.0

_TABLES = 2 * (ORDER + 1)  # for each order: contexts, and contexts with the next byte
_BITS = 9  # of a byte, or of the mark before the first one
#: Contexts of at most so many bytes have a bounded number of counts, which go to the driver.
_LOW = 1
_KINDS = ("block", "allow")
RESULTS = ("host", "path", "rule", "verdict", "score")


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict); NULL without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _mask(n: int) -> int:
    return (1 << _BITS * n) - 1


def _grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its text, and a number that holds it in the low bits and the ``ORDER`` bytes before it above, the nearest one lowest."""
    sizes = np.diff(block.offsets)
    row = np.repeat(np.arange(block.rows), sizes)
    at = np.arange(len(block.data)) - block.offsets[row]
    symbol = block.data.astype(np.int64) + 1
    grams = symbol.copy()
    for order in range(1, ORDER + 1):
        before = np.zeros(len(symbol), np.int64)
        before[order:] = symbol[:-order] if len(symbol) > order else symbol[:0]
        before[at < order] = 0
        grams |= before << _BITS * order
    return row, grams


def _keys(grams, order: int):
    """Context and context with byte, for arrays and for columns."""
    mask = _mask(order + 1)
    if isinstance(grams, np.ndarray):
        return (grams & mask) >> _BITS, grams & mask
    with_byte = grams.bitwiseAND(F.lit(mask).cast("long"))
    return F.shiftright(with_byte, _BITS), with_byte


def _slots(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its text, and the number in every table that its key has among those of the block."""
    row, grams = _grams(block)
    keys = [key for order in range(ORDER + 1) for key in _keys(grams, order)]
    return row, np.stack([np.unique(key, return_inverse=True)[1] for key in keys])


def _count(batches):
    for part, block in blocks(batches, "address"):
        row, grams = _grams(block)
        found, which = np.unique(grams, return_inverse=True)
        sums = [np.bincount(which, part.column(kind).to_numpy()[row], len(found)).astype(np.int64) for kind in _KINDS]
        yield pa.RecordBatch.from_arrays([pa.array(found), *map(pa.array, sums)], ["gram", *_KINDS])


def _log_likelihood(counts, slots: np.ndarray) -> np.ndarray:
    """Of each byte given those before it."""
    chance = np.full(slots.shape[1], 1 / 256)
    for order in range(ORDER + 1):
        before, with_byte = counts[2 * order][slots[2 * order]], counts[2 * order + 1][slots[2 * order + 1]]
        chance = (with_byte + SHORTER * chance) / (before + SHORTER)
    return np.log(chance)


def _gain(low: np.ndarray):
    """Log-likelihood of the last byte of each string by the allowed URLs less that by the blocked ones."""
    def gain(batches):
        for batch in batches:
            grams = batch.column("gram").to_numpy()
            slots = np.broadcast_to(np.arange(len(grams)), (_TABLES, len(grams)))
            last, before = grams & _mask(1), grams >> _BITS & _mask(1)
            likelihoods = []
            for kind, pairs in zip(_KINDS, low):
                counts = [np.full(len(grams), pairs.sum()), pairs.sum(axis=0)[last], pairs.sum(axis=1)[before], pairs[before, last]]
                counts += [batch.column(f"{kind}_{name}_{order}").to_numpy() for order in range(_LOW + 1, ORDER + 1) for name in ("before", "with")]
                likelihoods.append(_log_likelihood(counts, slots))
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(likelihoods[1] - likelihoods[0])], ["gram", "gain"])

    return gain


def gains(model: DataFrame, needed: DataFrame) -> DataFrame:
    """(``gram``, ``gain``) for each needed string, by the counts of (``gram``, ``block``, ``allow``)."""
    pairs = model.groupBy(_keys(F.col("gram"), _LOW)[1].alias("pair")).agg(*[F.sum(k).alias(k) for k in _KINDS]).toArrow()
    low = np.zeros((len(_KINDS), 1 << _BITS, 1 << _BITS))  # by class, byte before and byte
    at = pairs.column("pair").to_numpy()
    for i, kind in enumerate(_KINDS):
        low[i, at >> _BITS, at & _mask(1)] = pairs.column(kind).to_numpy()
    listed = []
    for order in range(_LOW + 1, ORDER + 1):
        for name, key in zip(("before", "with"), _keys(F.col("gram"), order)):
            column = f"{name}_{order}"
            sums = model.groupBy(key.alias(column)).agg(*[F.sum(k).cast("double").alias(f"{k}_{column}") for k in _KINDS])
            needed = needed.withColumn(column, key).join(sums, column, "left")
            listed += [f"{k}_{column}" for k in _KINDS]
    found = needed.select("gram", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in listed])
    return found.mapInArrow(_gain(low), "gram long, gain double")


def _pack(batches):
    """A row for each block of addresses, with its distinct strings."""
    number = TaskContext.get().partitionId() << 32
    for part, block in blocks(batches, "address", SLOTS):
        grams = np.unique(_grams(block)[1])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (part.column("address"), pa.array(grams))]
        yield pa.RecordBatch.from_arrays([pa.array([number]), *lists], ["number", "addresses", "grams"])
        number += 1


def _score(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            addresses = batch.column("addresses")[i].values
            block, known = Block(addresses), batch.column("known")[i].values
            found = np.zeros(block.rows)
            if known is not None:
                names, values = (known.field(k).to_numpy() for k in (0, 1))
                order = np.argsort(names)
                row, grams = _grams(block)
                gain = values[order][np.searchsorted(names[order], grams)]
                found = np.bincount(row, gain, block.rows) / np.maximum(np.diff(block.offsets), 1)
            yield pa.RecordBatch.from_arrays([addresses, pa.array(found)], ["address", "score"])


def fit(addresses: DataFrame) -> tuple[DataFrame | None, float]:
    """(``address``, ``score``) and the threshold, from distinct addresses with the numbers of blocked and allowed URLs.

    Without URLs of one class there are no scores.
    """
    held = F.pmod(F.xxhash64(F.lit("held"), "address"), F.lit(HELD_OUT)) == 0
    model = stage(addresses.where(~held & (F.col("block") + F.col("allow") > 0)).mapInArrow(_count, "gram long, block long, allow long")
                  .groupBy("gram").agg(*[F.sum(k).alias(k) for k in _KINDS]), "url-model")
    if not all(model.agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in _KINDS]).first()):
        return None, 0.0
    packed = stage(addresses.select("address").mapInArrow(_pack, "number long, addresses array<string>, grams array<long>"), "url-blocks")
    entries = packed.select("number", F.explode("grams").alias("gram"))
    # A string stands once in each block, and a block holds a bounded number of them.
    known = (entries.join(gains(model, entries.select("gram").distinct()), "gram")
             .groupBy("number").agg(F.collect_list(F.struct("gram", "gain")).alias("known")))
    scores = stage(packed.select("number", "addresses").join(known, "number", "left").mapInArrow(_score, "address string, score double"), "url-scores")
    place = F.least(F.greatest(F.floor((F.col("score") + LIMIT) * (BINS / 2 / LIMIT)), F.lit(0)), F.lit(BINS - 1))
    bins = addresses.where(held).join(scores, "address").groupBy(place.alias("bin")).agg(*[F.sum(k).alias(k) for k in _KINDS]).collect()
    shares = np.zeros((2, BINS))
    for row in bins:
        shares[:, row["bin"]] = [row[k] for k in _KINDS]
    total = shares.sum(axis=1)
    if not total.all():
        return scores, 0.0
    # Errors if all from this bin on are allowed; of equal ones the threshold nearest to 0.
    wrong = np.concatenate([[0], np.cumsum(shares[1])]) / total[1] + 1 - np.concatenate([[0], np.cumsum(shares[0])]) / total[0]
    limits = np.arange(BINS + 1) * (2 * LIMIT / BINS) - LIMIT
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return scores, float(limits[best[np.argmin(np.abs(limits[best]))]])


def url_filter(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score."""
    rows = pages.drop(*[c for c in RESULTS if c != url]).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rows = rows.withColumn("__rule", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("__address", F.concat("host", "path"))
    judged = F.col("__rule.verdict")
    addresses = stage(rows.groupBy(F.col("__address").alias("address")).agg(*[F.count_if(judged == k).alias(k) for k in _KINDS]), "addresses")
    scores, threshold = fit(addresses)
    if scores is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        scored = rows.join(scores.withColumnRenamed("address", "__address"), "__address")
    verdict = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return (scored.withColumn("rule", F.col("__rule.rule"))
            .withColumn("verdict", F.coalesce(F.col("__rule.verdict"), verdict)).drop("__rule", "__address"))
