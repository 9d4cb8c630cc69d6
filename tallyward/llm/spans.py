"""Substring dedup by sliding sentence spans.

A text is cut into sentences, long ones further into clauses. Every run of several consecutive sentences is hashed: from each
sentence on, the shortest run of ``RUN_SENTENCES`` sentences and ``RUN_WORDS`` words at least. Runs are counted over the whole
table; the first one of equal runs is that of the least key, and within a text the earliest. Sentences covered by any run that is not the
first of its kind are removed, all others stay byte for byte.

Cutting depends only on words nearby, so that a passage that stands in two texts is cut alike in both, but for its
edges. Only the hash and place of a run are shuffled. A run that very many texts share is counted by partial sums; the places of one
run meet its count in one task, 24 bytes each.

NULL texts stay NULL and empty ones empty. Rows that share a key count as one text whose runs are all first among them; a NULL key is the
least key. A row loses only runs that it has itself at that place, by their hash, whatever other rows of its key hold.
An empty table gives an empty result. Other columns stay; columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import Block, Spans, blocks, mix, of_row, table_of

RUN_SENTENCES, RUN_WORDS = 3, 20
#: Clauses end at a comma, or at a word with a hash divisible by ``CUT``, once they have so many words.
CLAUSE_WORDS, CUT = 4, 3

_STRONG, _WEAK = table_of(b".!?"), table_of(b",;:|")
_QUOTES = table_of(b"\"')]}")
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def sentences(block: Block, words: Spans, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the words that begin a sentence or clause, in order."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    last = words.ends - 1
    closed = _QUOTES[block.data[last]] & (words.ends - words.starts > 1)
    mark = block.data[last - closed]
    new_text = np.zeros(n, bool)
    new_text[words.first[:-1][words.counts > 0]] = True
    lines = np.concatenate([[0], np.cumsum(block.data == 10)])
    broken = np.zeros(n, bool)
    broken[:-1] = lines[words.starts[1:]] > lines[words.ends[:-1]]
    strong = _STRONG[mark] | broken
    strong[:-1] |= new_text[1:]
    strong[-1] = True
    weak = strong | _WEAK[mark] | (hashes % _U(CUT) == 0)
    # The last word of the sentence that begins at each word: the next strong end, or a weak one far enough on.
    numbers = np.arange(n)
    next_strong = _next(strong, numbers)
    next_weak = _next(weak, numbers)
    end = np.minimum(next_strong, next_weak[np.minimum(numbers + CLAUSE_WORDS - 1, n - 1)])
    begins = np.zeros(n, bool)
    at = np.flatnonzero(np.concatenate([[True], strong[:-1]]))
    while len(at):  # one more clause of every sentence in each round
        begins[at] = True
        at = end[at] + 1
        at = at[at < n]
        at = at[~begins[at]]
    return np.flatnonzero(begins)


def _next(ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The first true place at or after each place; the last place is true."""
    places = np.flatnonzero(ends)
    return places[np.searchsorted(places, numbers)]


def runs(block: Block) -> tuple[Spans, np.ndarray, dict[str, np.ndarray]]:
    """Words, first words of sentences, and for each run its first and last sentence, text and two hashes."""
    words = block.words()
    hashes = words.hashes()
    begins = sentences(block, words, hashes)
    row = words.row[begins]
    count = np.bincount(row, minlength=block.rows)
    limit = np.cumsum(count)[row]
    first = np.arange(len(begins))
    ends = np.append(begins[1:], len(words)) if len(begins) else begins
    by_words = np.searchsorted(ends, begins + RUN_WORDS)
    last = np.maximum(first + RUN_SENTENCES - 1, by_words)
    kept = last < limit
    # A text's last sentences are in the shortest run that ends with it.
    closing = np.cumsum(count)[count > 0] - 1
    from_end = np.minimum(closing - RUN_SENTENCES + 1, np.searchsorted(begins, ends[closing] - RUN_WORDS, "right") - 1)
    fits = from_end >= closing + 1 - count[count > 0]
    fits[fits] &= last[from_end[fits]] != closing[fits]
    first, last = np.concatenate([first[kept], from_end[fits]]), np.concatenate([last[kept], closing[fits]])
    row = row[first]
    closes = np.arange(len(first)) >= kept.sum()
    begin, end = begins[first], ends[last]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(words)), dtype=np.uint64)])
    value = (sums[end] - sums[begin]) * _powers(_INVERSE, len(words) + 1)[begin]
    size = (end - begin).astype(np.uint64)
    sums2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + _U(7)) * _powers(_BASE, len(words)), dtype=np.uint64)])
    value2 = (sums2[end] - sums2[begin]) * _powers(_INVERSE, len(words) + 1)[begin]
    return words, begins, {"first": first, "last": last, "closes": closes, "row": row, "run": mix(value + size).view(np.int64),
                           "check": (mix(value2 + size) >> _U(32)).astype(np.uint32).view(np.int32)}


def _first_sentence(begins: np.ndarray, words: Spans) -> np.ndarray:
    """The number of the first sentence of each text in the block."""
    return np.searchsorted(begins, words.first[:-1])


def _place(found: dict[str, np.ndarray], base: np.ndarray) -> np.ndarray:
    """Number of each run in its text: a sentence may begin two, of which the odd one ends with the text."""
    return 2 * (found["first"] - base[found["row"]]) + found["closes"]


def _find_runs(batches):
    for part, block in blocks(batches):
        words, begins, found = runs(block)
        keys = part.column("__key").to_numpy(zero_copy_only=False)
        row = found["row"]
        # Of equal runs in one text the earliest speaks for all.
        own = of_row(found["run"].view(np.uint64) ^ found["check"].view(np.uint32).astype(np.uint64), row)
        _, keep = np.unique(own, return_index=True)
        place = _place(found, _first_sentence(begins, words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[row[keep]]), pa.array(found["run"][keep]), pa.array(found["check"][keep]),
             pa.array(place[keep].astype(np.int32))], ["__key", "run", "check", "place"])


def _remove(names: list[str], text: str):
    def remove(batches):
        for part, block in blocks(batches, text):
            words, begins, found = runs(block)
            row = found["row"]
            base = _first_sentence(begins, words)
            own = of_row(found["run"].view(np.uint64) ^ found["check"].view(np.uint32).astype(np.uint64), row)
            # Runs that an earlier text holds too: all of them; runs repeated in this text: all but the earliest.
            _, index, which = np.unique(own, return_index=True, return_inverse=True)
            spare = index[which] != np.arange(len(own))
            places = part.column("__places")
            sizes = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
            listed, check = (places.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("place", "check"))
            of = np.repeat(np.arange(block.rows), sizes)
            # What a row has at its places: the listed run may be that of another row with this key.
            at = _place(found, base) + 2 * base[row]
            held = np.full(2 * len(begins) + 1, 1 << 40, np.int64)
            held[at] = found["check"]
            inside = listed < 2 * np.bincount(words.row[begins], minlength=block.rows)[of]
            listed, check, of = listed[inside], check[inside], of[inside]
            marked = np.zeros(2 * len(begins) + 1, bool)
            listed = 2 * base[of] + listed
            marked[listed[held[listed] == check]] = True
            starts_listed = marked[at]
            known = np.zeros(len(index), bool)
            np.logical_or.at(known, which, starts_listed)
            gone = spare | known[which]
            edge = np.zeros(len(begins) + 1, np.int64)
            edge += np.bincount(found["first"][gone], minlength=len(edge))
            edge -= np.bincount(found["last"][gone] + 1, minlength=len(edge))
            removed = np.cumsum(edge[:-1]) > 0
            out, dropped, total = _texts(block, words, begins, removed)
            given = part.column(text)
            texts = pa.array([None if not v.is_valid else t for v, t in zip(given, out)], pa.string())
            columns = [part.column(c) if c != text else texts for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total), pa.array(dropped)], [*names, "n_sentences", "n_removed"])

    return remove


def _texts(block: Block, words: Spans, begins: np.ndarray, removed: np.ndarray):
    """Texts without the removed sentences, and how many were removed of how many."""
    row = words.row[begins]
    begin = words.starts[begins]
    first = np.zeros(len(begins), bool)
    counts = np.bincount(row, minlength=block.rows)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    begin = np.where(first, block.offsets[:-1][row], begin)
    end = np.append(begin[1:], 0)
    last = np.append(first[1:], True) if len(first) else first
    end = np.where(last, block.offsets[1:][row], end)
    cut = np.zeros(len(block.data) + 1, np.int64)
    cut[begin[removed]] += 1
    cut[end[removed]] -= 1
    keep = np.cumsum(cut[:-1]) == 0
    left = block.data[keep].tobytes()
    limits = np.concatenate([[0], np.cumsum(block.per_text(keep))]).tolist()
    texts = [left[a:b].decode() for a, b in zip(limits, limits[1:])]
    return texts, np.bincount(row[removed], minlength=block.rows), counts


def span_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without repeated sentences, with ``n_sentences`` and ``n_removed``."""
    least = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    places = docs.select(least.alias("__key"), F.col(text).alias("text")).mapInArrow(
        _find_runs, "__key long, run long, check int, place int")
    shared = (places.groupBy("run", "check").agg(F.min("__key").alias("first"), F.count("*").alias("n"))
              .where(F.col("n") > 1).drop("n"))
    again = (places.join(shared, ["run", "check"]).where(F.col("__key") != F.col("first"))
             .groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("place", "check"))).alias("__places")))  # bounded by a text's sentences
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    listed = docs.withColumn("__key", least).join(again, "__key", "left").select(*[F.col(f"`{c}`") for c in names], "__places")
    return listed.mapInArrow(_remove(names, text), f"{kinds}, n_sentences long, n_removed long")
