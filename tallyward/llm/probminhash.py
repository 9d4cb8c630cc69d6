"""Near-duplicates by ProbMinHash signatures of weighted word shingles, banding and exact verification.

A text is the multiset of its runs of five words. Each distinct shingle sends out a Poisson process whose rate is its
count; every arrival hits one of ``REGISTERS`` registers, and a register keeps the shingle of its first arrival. Two texts agree in a
register with the probability Jaccard similarity of their multisets. Arrivals come in slices of time, and a text leaves
once all its registers are hit: later arrivals cannot change them.

Texts with equal words are one node. Bands of ``ROWS`` registers give buckets. In every bucket each text is compared with its centre, the text whose
buckets are the largest; links are pairs whose weighted Jaccard similarity, counted on the texts themselves, is 0.8 or
more. Texts that a bucket holds in another class than its centre are then compared with the other classes' texts in the
bucket, so that no link between classes is lost to the choice of the centre. Of these pairs two kinds are left out: those whose signatures agree in fewer
than ``AGREE`` registers (similar pairs fall short of that once in 1,000,000, less often than they miss all bands), and those that cannot be similar because too many of
their shingles stand in no other of these texts, which is exact. Classes are the connected components.

NULL and empty texts and those without words are a class of their own each. Texts of fewer than five words are one
shingle. Rows that share a key count as one document, and rows with a NULL key have a NULL class. An empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.llm.textblocks import BLOCK_BYTES, Block, blocks, mix, of_row
from tallyward.operators.staging import stage

SHINGLE, SIMILARITY = 5, 0.8
#: At similarity 0.8 a pair shares no band of 24 with a probability of 0.000003.
BANDS, ROWS = 24, 4
#: The first ones make up the bands; all of them estimate the similarity of a pair.
REGISTERS = 256
#: Registers that a pair of the second step agrees in.
AGREE = 173
#: Expected arrivals for each register in the first slice of time; each later slice doubles the time.
ARRIVALS = 6.0

_U = np.uint64


def shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of every distinct shingle."""
    words = block.words()
    at, found = words.windows(words.hashes(), size, shorter=True)
    row = words.row[at]
    keys = of_row(found, row)
    _, index, count = np.unique(keys, return_index=True, return_counts=True)
    return row[index], found[index], count


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)


def signatures(rows: int, row: np.ndarray, hashes: np.ndarray, count: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """For each text the hashes of the shingles that hit its registers first (0 for a text without shingles)."""
    first = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, np.uint64)
    weight = np.bincount(row, count, rows)
    limit = ARRIVALS * registers / np.maximum(weight, 1)
    seed = mix(hashes ^ _U(0xD1B54A32D192ED03))
    # The next arrival of every shingle: its time, and which one it is.
    time = -np.log(_uniform(seed)) / count
    order = np.ones(len(row), np.uint64)
    live = np.arange(len(row))
    while len(live):
        now = live[time[live] < limit[row[live]]]
        while len(now):
            bits = mix(seed[now] + _U(0x9E3779B97F4A7C15) * order[now])
            slot = row[now] * registers + (bits % _U(registers)).astype(np.int64)
            when = time[now]
            np.minimum.at(first, slot, when)
            hit = first[slot] == when
            winner[slot[hit]] = hashes[now[hit]]
            time[now] += -np.log(_uniform(mix(bits))) / count[now]
            order[now] += _U(1)
            now = now[time[now] < limit[row[now]]]
        full = np.isfinite(first.reshape(rows, registers)).all(axis=1)
        live = live[~full[row[live]]]
        limit *= 2
    return winner.reshape(rows, registers)


def similarity(a: Block, b: Block, size: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of each pair of texts."""
    row_a, hash_a, count_a = shingles(a, size)
    row_b, hash_b, count_b = shingles(b, size)
    total = np.bincount(row_a, count_a, a.rows) + np.bincount(row_b, count_b, a.rows)
    key_a, key_b = of_row(hash_a, row_a), of_row(hash_b, row_b)
    _, at_a, at_b = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    shared = np.bincount(row_a[at_a], np.minimum(count_a[at_a], count_b[at_b]), a.rows)
    return shared / np.maximum(total - shared, 1)


def _sign(batches):
    for part, block in blocks(batches):
        row, hashes, count = shingles(block)
        found = signatures(block.rows, row, hashes, count)
        words = block.words()
        own = words.hashes()
        nth = np.arange(len(own)) - words.first[:-1][words.row]
        place = mix(nth.astype(np.uint64) + _U(1))
        totals = []
        for salt in (_U(3), _U(5)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own * salt + place), dtype=np.uint64)])
            totals.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64)).view(np.int64))
        bands = found[:, : BANDS * ROWS].reshape(block.rows, BANDS, ROWS)
        steps = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | _U(1)
        keys = mix((bands * steps).sum(axis=2, dtype=np.uint64)).view(np.int64)
        low = (found & _U(0xFF)).astype(np.uint8).view(np.int8)  # a byte of each; others agree by chance once in 256
        keep = np.flatnonzero(words.counts > 0)
        of_rows = lambda values, width: pa.ListArray.from_arrays(
            pa.array(np.arange(len(keep) + 1, dtype=np.int32) * width), pa.array(values[keep].ravel()))
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(keep)), pa.array(totals[0][keep]), pa.array(totals[1][keep]),
             pa.array(np.bincount(row, count, block.rows)[keep].astype(np.int64)),
             of_rows(keys, BANDS), of_rows(low, REGISTERS)], ["id", "text1", "text2", "shingles", "bands", "registers"])


def _list_shingles(batches):
    for part, block in blocks(batches):
        row, hashes, count = shingles(block)
        yield pa.RecordBatch.from_arrays(
            [part.column("id").take(pa.array(row)), pa.array(hashes.view(np.int64)), pa.array(count)], ["id", "shingle", "n"])


def _verify(batches):
    for batch in batches:
        texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
        sizes = np.concatenate([[0], np.cumsum(pc.add(pc.binary_length(texts_a), pc.binary_length(texts_b)).to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + BLOCK_BYTES, "right")) - 1)
            found = similarity(Block(texts_a.slice(at, end - at)), Block(texts_b.slice(at, end - at)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").slice(at, end - at), batch.column("b").slice(at, end - at), pa.array(found)], ["a", "b", "similarity"])
            at = end


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) that are similar enough. The text of the centre ``a`` joins last and is not shuffled with each pair."""
    side = lambda name: texts.select(F.col("id").alias(name), F.col("text").alias(f"text_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    found = joined.mapInArrow(_verify, "a long, b long, similarity double")
    return found.where(F.col("similarity") >= SIMILARITY).select("a", "b")


def _agreeing(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _first_shared(a: Column, b: Column) -> Column:
    """Number of the first band in which both agree."""
    return F.array_position(F.zip_with(a, b, lambda x, y: x == y), True) - 1


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its key, ``class_id`` (the least key of its class), and whether it is that one.

    Writes signatures, the texts of candidates and links to the shared folder.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    signed = stage(texts.mapInArrow(_sign, "id long, text1 long, text2 long, shingles long, bands array<long>, registers array<byte>"), "signatures")
    # Equal texts become the one of the least key.
    nodes = signed.groupBy("text1", "text2").agg(F.min("id").alias("node"))
    copies = signed.select("id", "text1", "text2").join(nodes, ["text1", "text2"]).select("id", "node")
    own = signed.join(nodes.select("text1", "text2", F.col("node").alias("id")), ["text1", "text2", "id"]).select("id", "shingles", "bands", "registers")
    entries = own.select("id", F.posexplode("bands").alias("band", "bucket"))
    sizes = entries.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(entries.join(sizes, ["band", "bucket"]), "buckets")
    fame = shared.groupBy("id").agg(F.sum("n").alias("fame"))
    placed = shared.join(fame, "id")
    centre = placed.groupBy("band", "bucket").agg(F.max(F.struct("fame", -F.col("id"))).alias("top")).select(
        "band", "bucket", (-F.col("top.col2")).alias("a"))
    pairs = shared.join(centre, ["band", "bucket"]).where("id <> a").select("a", F.col("id").alias("b")).distinct()
    # Texts are dealt by key at every size, as their table has no bound that a broadcast could rely on.
    candidates = stage(texts.join(fame.select("id").hint("shuffle_merge"), "id", "left_semi"), "candidates")
    links = stage(_links(pairs, candidates), "centre-links")
    classes = components(links)
    # What a bucket holds beside its centre's class is compared with the rest of the bucket.
    labelled = (shared.select("id", "band", "bucket").join(classes.withColumnRenamed("node", "id"), "id", "left")
                .withColumn("class", F.coalesce("class", "id")))
    heads = centre.join(classes.select(F.col("node").alias("a"), F.col("class").alias("head")), "a", "left").select(
        "band", "bucket", F.coalesce("head", "a").alias("head"), "a")
    mixed = labelled.join(heads, ["band", "bucket"])
    strays = mixed.where(F.col("class") != F.col("head"))
    strays = stage(strays.select("band", "bucket", "id", "class", "a"), "strays")
    members = stage(labelled.join(strays.select("band", "bucket").distinct(), ["band", "bucket"]), "members")
    # Shingles of each that stand in others too.
    texts_of = candidates.join(members.select("id").distinct(), "id", "left_semi")
    common = (texts_of.mapInArrow(_list_shingles, "id long, shingle long, n long").groupBy("shingle")
              .agg(F.count("*").alias("texts"), F.min("id").alias("id"), F.min("n").alias("n")).where("texts = 1")
              .groupBy("id").agg(F.sum("n").alias("alone")))
    signs = own.join(common, "id", "left").withColumn("common", F.col("shingles") - F.coalesce("alone", F.lit(0))).drop("alone")
    x, y = strays.join(signs, "id").alias("x"), members.join(signs, "id").alias("y")
    most = F.least("x.common", "y.common")
    near = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.bucket") == F.col("y.bucket"))
                  & (F.col("x.class") != F.col("y.class")) & (F.col("y.id") != F.col("x.a"))
                  & (most >= SIMILARITY * (F.col("x.shingles") + F.col("y.shingles") - most) - 1e-6)
                  & (_first_shared(F.col("x.bands"), F.col("y.bands")) == F.col("x.band"))
                  & (_agreeing(F.col("x.registers"), F.col("y.registers")) >= AGREE))
    more = near.select(F.greatest("x.id", "y.id").alias("b"), F.least("x.id", "y.id").alias("a")).distinct()
    # Links of the second step join classes of the first.
    found = _links(more, candidates)
    for end in ("a", "b"):
        found = (found.join(classes.select(F.col("node").alias(end), F.col("class").alias(f"class_{end}")), end, "left")
                 .withColumn(f"class_{end}", F.coalesce(f"class_{end}", end)))
    joined = components(found.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    final = (copies.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node")).drop("node")
             .join(joined.select(F.col("node").alias("class"), F.col("class").alias("whole")), "class", "left"))
    of_id = final.groupBy("id").agg(F.min(F.coalesce("whole", "class")).alias("class_id"))
    return (docs.select(F.col(key)).join(of_id.withColumnRenamed("id", key), key, "left")
            .select(key, F.coalesce(F.col("class_id"), F.col(key).cast("long")).alias("class_id"))
            .withColumn("is_first", F.col("class_id").eqNullSafe(F.col(key).cast("long"))))
