"""Removal of long repeated byte strings by bucket-pointer refinement.

Every byte of a text that lies in a string of ``LENGTH`` bytes which starts anywhere else too, in another text or the same one,
is removed. Positions are not all shuffled. Each window of ``LENGTH`` bytes is put into the bucket of one of its q-grams, the
least by hash, which stands at the same place in an equal window; neighbouring windows mostly share it. One row for each of these anchors
carries the hash of all bytes that its windows span.

* A bucket with one anchor has no repeated window.
* Anchors with the same bytes in one bucket: all their windows are repeated.
* Else the bucket is refined. The positions of its anchors' bytes are ranked by their first eight bytes, and ranks of 16, 32, 64, 128
  and ``LENGTH`` bytes follow by sorting on pairs of ranks, that of a position and that of a later offset; each step
  reuses the ranks of the one before. Windows of equal rank are equal.

A bucket of more than ``LOCAL`` different anchors is not refined in one task: its windows are counted by hash over all tasks.
Equal anchors are counted by partial sums, so that a passage that very many texts share is no single task's work.

NULL and empty texts and those shorter than ``LENGTH`` stay as they are. Rows that are alike in key and text are different places, so all of
them lose what they share. A NULL key is a key like others. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import Block, blocks, mix
from tallyward.operators.staging import stage

LENGTH, GRAM = 200, 32
#: Different anchors of a bucket that one task refines; beyond that their windows are counted by all.
LOCAL = 2_000
#: Bytes of anchors that a task refines together.
TOGETHER = 1 << 20
#: Bytes of text that a task looks at together.
BLOCK_BYTES = 2 << 20

_U = np.uint64
_WINDOW = LENGTH - GRAM + 1
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random number for each byte.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of the base and of its inverse, kept for the longest block so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_powers = Powers()


class Prefixes:
    """Hashes of any byte string of an array in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin] + _U(0x632BE59BD9B4E019) * (end - begin).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def least_in_windows(keys: np.ndarray, size: int) -> np.ndarray:
    """The least key of every ``size`` neighbours, by running minima forwards and backwards within parts of that size."""
    n = len(keys)
    if n < size:
        return keys[:0]
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    parts = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    back = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - size + 1], ahead[size - 1 : n])


def anchors(block: Block) -> dict[str, np.ndarray]:
    """The anchors of a block: text, bucket, hash of their bytes, first and last window (as bytes of the text)."""
    prefixes = Prefixes(block.data)
    grams = prefixes.grams(GRAM)
    # The upper half of the hash decides, then the earlier place.
    least = least_in_windows((grams & _U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), _WINDOW)
    sizes = np.diff(block.offsets)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    row = np.repeat(np.arange(block.rows), windows)
    start = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + block.offsets[row]
    place = (least[start] & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])) if len(place) else place
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    lo, hi, row = start[first], start[last], row[first]
    base = block.offsets[row]
    # Anchors are alike if their bytes are and the q-gram stands at the same place in them.
    span = prefixes.hashes(lo, hi + LENGTH) + mix((place[first] - lo).astype(np.uint64))
    return {"row": row, "bucket": grams[place[first]].view(np.int64), "bytes": mix(span).view(np.int64), "lo": lo - base, "hi": hi - base}


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _find_anchors(batches):
    for part, block in blocks(batches, block_bytes=BLOCK_BYTES):
        found = anchors(block)
        counts = np.bincount(found["row"], minlength=block.rows)
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("digest"), _lists(found["bucket"], counts), _lists(found["bytes"], counts),
             _lists(found["lo"].astype(np.int32), counts), _lists(found["hi"].astype(np.int32), counts)],
            ["id", "digest", "bucket", "bytes", "lo", "hi"])


def _cut_anchors(batches):
    """The bytes of the anchors that a text has to show."""
    for batch in batches:
        ids, digests = batch.column("id"), batch.column("digest")
        rows, buckets, alone, large, lows, values = [], [], [], [], [], []
        for i, (text, wanted) in enumerate(zip(batch.column("text"), batch.column("wanted"))):
            data = text.as_py().encode()
            for one in wanted.as_py():
                rows.append(i)
                buckets.append(one["bucket"])
                alone.append(one["alone"])
                large.append(one["large"])
                lows.append(one["lo"])
                values.append(data[one["lo"] : one["hi"] + LENGTH])
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.take(at), digests.take(at), pa.array(buckets, pa.int64()), pa.array(alone, pa.bool_()), pa.array(large, pa.bool_()),
             pa.array(lows, pa.int32()), pa.array(values, pa.binary())], ["id", "digest", "bucket", "alone", "large", "lo", "span"])


def ranks(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the different ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if len(keys) else np.zeros(0, np.int64)
    made = np.empty(len(keys), np.uint64)
    made[order] = new
    return made


def refine(data: np.ndarray, offsets: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows in spans of bytes that lie end to end, and whether an equal one is in the same bucket.

    Ranks of ever longer strings, from eight bytes on: each by sorting on the ranks of a position and of a later offset. Positions too near to the end of their span
    are not ranked any more.
    """
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(offsets[1:], sizes) - np.arange(len(owner))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))[: len(data)]
    at = np.flatnonzero(left >= 8)
    rank = np.zeros(len(data), np.uint64)
    rank[at] = ranks(view[at])
    # Strings of different buckets are never alike.
    rank[at] = ranks(rank[at] << _U(32) | ranks(bucket.view(np.uint64))[owner[at]])
    size = 8
    while size < LENGTH:
        longer = min(2 * size, LENGTH)
        at = at[left[at] >= longer]
        new = ranks(rank[at] << _U(32) | rank[at + longer - size])
        rank[at] = new
        size = longer
    _, which, count = np.unique(rank[at], return_inverse=True, return_counts=True)
    return at, count[which] > 1


def _refine_buckets(batches):
    """Repeated windows of the anchors that are alone with their bytes, as ranges of bytes."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "id", "digest", "alone", "lo", "span"))):
            if size > TOGETHER and row[0] != held[-1][0]:
                yield _repeated(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    yield _repeated(held)


def _repeated(held: list[tuple]):
    if not held:
        return _ranges([], [], np.zeros(0, np.int64), np.zeros(0, np.int64))
    bucket, ids, digests, alone, lo, spans = zip(*held)
    data = np.frombuffer(b"".join(spans), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
    at, again = refine(data, offsets, np.array(bucket, np.int64))
    owner = np.searchsorted(offsets, at, "right") - 1
    keep = again & np.array(alone)[owner]
    at, owner = at[keep], owner[keep]
    begin = at - offsets[owner] + np.array(lo, np.int64)[owner]
    # Neighbouring windows make one range.
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (begin[1:] != begin[:-1] + 1)]) if len(at) else np.zeros(0, bool)
    last = np.append(first[1:], True) if len(at) else first
    who = owner[first].tolist()
    return _ranges([ids[i] for i in who], [digests[i] for i in who], begin[first], begin[last] + LENGTH)


def _ranges(ids: list, digests: list, begin: np.ndarray, end: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(begin.astype(np.int32)),
                                       pa.array(end.astype(np.int32))], ["id", "digest", "begin", "end"])


def _spread_windows(batches):
    """Each window of anchors in large buckets, by two hashes."""
    for batch in batches:
        spans = batch.column("span").to_pylist()
        if not spans:
            continue
        sizes = np.array([len(s) for s in spans])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(spans), np.uint8)
        counts = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(spans)), counts)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = inside + offsets[:-1][owner]
        one = Prefixes(data).hashes(begin, begin + LENGTH)
        two = Prefixes(255 - data).hashes(begin, begin + LENGTH // 2)
        lo = batch.column("lo").to_numpy(zero_copy_only=False).astype(np.int64)
        at = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(at) for c in ("id", "digest", "alone")]
            + [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array((lo[owner] + inside).astype(np.int32))],
            ["id", "digest", "alone", "one", "two", "begin"])


def _remove(batches):
    for part, block in blocks(batches, block_bytes=BLOCK_BYTES):
        edge = np.zeros(len(block.data) + 1, np.int32)
        row_of = part.column("ranges")
        counts = pc.fill_null(pc.list_value_length(row_of), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = row_of.flatten()
        base = np.repeat(block.offsets[:-1], counts)
        np.add.at(edge, base + flat.field("begin").to_numpy(zero_copy_only=False), 1)
        np.add.at(edge, base + flat.field("end").to_numpy(zero_copy_only=False), -1)
        gone = np.cumsum(edge[:-1]) > 0
        left = block.data[~gone].tobytes()
        kept = block.per_text(~gone)
        limits = np.concatenate([[0], np.cumsum(kept)]).tolist()
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        begins = block.offsets[:-1][np.diff(block.offsets) > 0]
        first[begins] |= gone[begins]
        sizes = np.diff(block.offsets)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes), pa.array(sizes - kept), pa.array(block.per_text(first)),
             pa.array([left[a:b] for a, b in zip(limits, limits[1:])], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of every row.

    Anchors, those in shared buckets and the bytes of those to refine are written to the shared folder.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(-(1 << 63))), "digest": F.xxhash64("text")})
    found = stage(rows.where(F.octet_length("text") >= LENGTH).select("id", "digest", "text").mapInArrow(
        _find_anchors, "id long, digest long, bucket array<long>, bytes array<long>, lo array<int>, hi array<int>"), "anchors")
    each = found.select("id", "digest", F.inline(F.arrays_zip("bucket", "bytes", "lo", "hi")))
    shared = (each.groupBy("bucket").agg(F.count("*").alias("n"), F.min("bytes").alias("least"), F.max("bytes").alias("most"))
              .where("n > 1").select("bucket", (F.col("least") != F.col("most")).alias("mixed")))
    kept = stage(each.join(shared, "bucket"), "shared-anchors")
    alike = kept.where("not mixed").select("id", "digest", F.col("lo").alias("begin"), (F.col("hi") + LENGTH).alias("end"))
    mixed = kept.where("mixed")
    kinds = stage(mixed.groupBy("bucket", "bytes").agg(F.count("*").alias("n"), F.min("id").alias("id")), "kinds")
    several = kinds.where("n > 1").select("bucket", "bytes")
    again = mixed.join(several, ["bucket", "bytes"]).select("id", "digest", F.col("lo").alias("begin"), (F.col("hi") + LENGTH).alias("end"))
    sizes = kinds.groupBy("bucket").agg(F.count("*").alias("kinds")).where("kinds > 1")
    # One anchor stands for all that are alike: the first place in the document of the least key.
    speaker = (mixed.join(kinds.select("bucket", "bytes", "id", (F.col("n") == 1).alias("alone")), ["bucket", "bytes", "id"])
               .groupBy("bucket", "bytes", "id", "alone").agg(F.min(F.struct("digest", "lo", "hi")).alias("at")).join(sizes, "bucket"))
    one = F.struct("bucket", "alone", "at.lo", "at.hi", (F.col("kinds") > LOCAL).alias("large")).alias("one")
    wanted = (speaker.select("id", "at.digest", one).groupBy("id", "digest")
              .agg(F.collect_list("one").alias("wanted")))  # bounded by a text's anchors
    once = rows.where(F.octet_length("text") >= LENGTH).select("id", "digest", "text")
    cut = stage(once.join(wanted, ["id", "digest"]).select("id", "digest", "text", "wanted").mapInArrow(
        _cut_anchors, "id long, digest long, bucket long, alone boolean, large boolean, lo int, span binary"), "spans")
    ranges = "id long, digest long, begin int, end int"
    refined = (cut.where("not large").drop("large").repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(_refine_buckets, ranges))
    # Anchors of one large bucket lie in few files; their windows are many, so they are dealt out evenly first.
    spread = cut.where("large").select("id", "digest", "alone", "lo", "span").hint("rebalance").mapInArrow(
        _spread_windows, "id long, digest long, alone boolean, one long, two long, begin int")
    twice = spread.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1")
    counted = spread.where("alone").join(twice, ["one", "two"]).select("id", "digest", "begin", (F.col("begin") + LENGTH).alias("end"))
    covered = (alike.union(again).union(refined).union(counted).distinct().groupBy("id", "digest")
               .agg(F.collect_list(F.struct("begin", "end")).alias("ranges")))  # bounded by a text's anchors and windows
    return rows.join(covered, ["id", "digest"], "left").select("doc_id", "text", "ranges").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


#: The same of the table ``documents``, with a digest of the kept bytes, by counting every string of 200 bytes.
SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, b[i : i + 199] AS s FROM d, unnest(range(1, octet_length(b) - 198)) AS t (i) WHERE octet_length(b) >= 200),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM again),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM marked),
spans AS (SELECT r, min(i) AS lo, max(i) + 199 AS hi FROM numbered GROUP BY r, span),
pieces AS (
  SELECT r, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY r ORDER BY lo) + 1 AS begin, lo - 1 AS stop FROM spans
  UNION ALL SELECT d.r, NULL, NULL, coalesce(max(hi), 0) + 1, octet_length(any_value(b)) FROM d LEFT JOIN spans ON spans.r = d.r GROUP BY d.r)
SELECT any_value(doc_id) AS doc_id, octet_length(any_value(b)) AS n_bytes, coalesce(sum(hi - lo + 1), 0)::BIGINT AS n_removed,
  count(lo) AS n_spans, sha256(unhex(string_agg(CASE WHEN stop < begin THEN '' ELSE hex(b[begin : stop]) END, '' ORDER BY begin))) AS kept_sha256
FROM pieces JOIN d ON d.r = pieces.r GROUP BY d.r
"""
