"""Byte-pair encoding with forced boundaries, and decoding.

A merge can only join two symbols that stand next to each other inside some vocabulary token. Where two adjacent
symbols of a word never do, no merge ever crosses: the word is cut there, its fragments are encoded independently and
their ids are put together again. The result equals that of encoding the whole word.

The tokenizer file is the public JSON format: normalisation to composed, lower-case text, words by a pattern, byte-level
symbols, the last symbol of a word marked as its end. It is read once by the driver and sent to the tasks, where it is a
few megabytes whatever the corpus. Special tokens written out in a text become their ids, as that library does.

NULL and empty texts have no tokens and decode to the empty text. An id that is not in the vocabulary fails the
job. Other columns stay as they are, but for a column named like the result, which is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import blocks

#: Words remembered by a task; beyond that it starts anew.
REMEMBERED = 200_000
#: Words of so many characters of text are looked up together.
GROUP_CHARS = 1_000_000
#: Fragments of more symbols are merged with a heap.
LONG = 48
NO_RANK = (1 << 30) - 1

# The word pattern of the file (a fixed value), and one that finds the same words faster unless the text holds
# separators that only one of both libraries calls white space, numbers other than digits, or characters beyond Latin.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SAME = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_UNUSUAL = re.compile("[\x1c-\x1f\u00b2\u00b3\u00b9\u00bc-\u00be\u0250-\U0010ffff]")


# What the library's Unicode tables know and those of the standard library do not, or the other way round (fixed values): letters and
# numbers that were added later, lower cases that were added later, and marks that the library's composed form takes for plain characters.
_LATER_LETTERS = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3
11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0
"""
_LATER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
_LATER_LOWER = "1C89:1C8A A7CB:264 A7CC:A7CD A7CE:A7CF A7D2:A7D3 A7D4:A7D5 A7DA:A7DB A7DC:19B 10D50-10D65:10D70 16EA0-16EB8:16EBB"
_PLAIN_MARKS = """
7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B
1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE
1E2EC-1E2EF 1E4EC-1E4EF
"""


def _points(listed: str) -> list[int]:
    """The code points of ranges in hexadecimal."""
    ends = [[int(x, 16) for x in part.split("-")] for part in listed.split()]
    return [c for e in ends for c in range(e[0], e[-1] + 1)]


def _class(points) -> str:
    """Code points as the inside of a character class."""
    inside = set(points)
    first = sorted(c for c in inside if c - 1 not in inside)
    last = sorted(c for c in inside if c + 1 not in inside)
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last))


def _lower_table() -> dict[int, int]:
    table = {}
    for pair in _LATER_LOWER.split():
        upper, lower = pair.split(":")
        table.update({c: int(lower, 16) + i for i, c in enumerate(_points(upper))})
    return table


_LOWER = _lower_table()
_HAS_LATER_LOWER = re.compile(f"[{_class(_LOWER)}]")
_PLAIN_MARK = re.compile(f"([{_class(_points(_PLAIN_MARKS))}])")


def members(major: str) -> str:
    """All characters of a major Unicode category, as ranges for a character class."""
    later = {"L": _LATER_LETTERS, "N": _LATER_NUMBERS}.get(major, "")
    return _class([c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == major] + _points(later))


def word_pattern(pattern: str) -> re.Pattern:
    """The file's word pattern for the standard library, with its classes of letters, numbers and white space spelled out."""
    for name, inside in ((r"\p{L}", members("L")), (r"\p{N}", members("N")), (r"\s", "\t-\r\x85" + members("Z"))):
        pattern = pattern.replace(f"[{name}]", f"[{inside}]").replace(name, inside)
    return re.compile(pattern)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or for the others the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PairTable:
    """Rank and result of merges, looked up for whole arrays of pairs of ids below 65,536."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        pairs = np.array(list(merges), np.uint64).reshape(-1, 2)
        self.bits = np.uint64(64 - max(4, (4 * len(merges)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.bits)), -1, np.int64)
        self.ranks = np.full(len(self.keys), NO_RANK, np.int64)
        self.depth = 1
        slots = self._slots(pairs[:, 0], pairs[:, 1])
        for slot, (a, b), (rank, _) in zip(slots.tolist(), merges, merges.values()):
            probes = 1
            while self.keys[slot] >= 0:
                slot, probes = (slot + 1) % len(self.keys), probes + 1
            self.keys[slot], self.ranks[slot] = a << 16 | b, rank
            self.depth = max(self.depth, probes)
        self.result = np.array([new for _, new in merges.values()], np.int64)

    def _slots(self, a, b) -> np.ndarray:
        return ((a.astype(np.uint64) << np.uint64(16) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> self.bits).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, slots = a << 16 | b, self._slots(a, b)
        found = np.where(self.keys[slots] == keys, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((found == NO_RANK) & (self.keys[slots] >= 0))
        for _ in range(self.depth - 1):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            at = slots[open_]
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (self.keys[at] >= 0)]
        return found


class Tokenizer:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, content: bytes, remembered: int = REMEMBERED):
        spec = json.loads(content)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in ids.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.specials.items()})
        self.special = re.compile("(" + "|".join(re.escape(t) for t in self.specials) + ")") if self.specials else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = word_pattern(split["pattern"]["Regex"])
        self.usual = split["pattern"]["Regex"] == _PATTERN
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.merges, self.pairs = merges, PairTable(merges)
        #: Id of each symbol: a byte inside a word, or 256 more for a byte that ends one.
        symbols = byte_symbols()
        self.symbol_ids = np.array([ids[c] for c in symbols] + [ids[c + end] for c in symbols], np.int64)
        self.inside = self._inner_pairs(ids, symbols, end)
        self.remembered = remembered
        self._forget()

    @staticmethod
    def _inner_pairs(ids: dict, symbols: list[str], end: str) -> np.ndarray:
        """True for pairs of adjacent symbols inside some token."""
        number = {c: b for b, c in enumerate(symbols)}
        inside = np.zeros((512, 512), bool)
        for token in ids:
            chars = token.removesuffix(end) if end else token
            row = [number[c] for c in chars if c in number]
            if row and end and token.endswith(end):
                row[-1] += 256
            for pair in zip(row, row[1:]):
                inside[pair] = True
        return inside

    def _forget(self) -> None:
        """Known words by number; the ids of word ``i`` are ``store[bounds[i]:bounds[i + 1]]``."""
        self.known: dict[str, int] = {}
        self.store, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, all at once."""
        coded = [w.encode() for w in words]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(lengths)
        number = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64)
        number[ends - 1] += 256
        cut = np.zeros(len(number), bool)
        cut[1:] = ~self.inside[number[:-1], number[1:]]
        cut[0] = True
        cut[ends[:-1]] = True
        flat, fragment = self._merged(self.symbol_ids[number], np.cumsum(cut) - 1)
        word = np.searchsorted(ends, np.flatnonzero(cut), "right")
        limits = np.searchsorted(word[fragment], np.arange(1, len(words) + 1))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.bounds = np.concatenate([self.bounds, limits + len(self.store)])
        self.store = np.concatenate([self.store, flat.astype(np.int32)])

    def _merged(self, symbols: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and fragment numbers once no pair is left to join.

        Each round joins in every fragment the pair of the least rank, the leftmost of these. Long fragments go through
        a heap instead, as their rounds would be many.
        """
        done = []
        sizes = np.bincount(fragment)
        if (long := np.flatnonzero(sizes > LONG)).size:
            begins = np.searchsorted(fragment, long)
            for f, a in zip(long.tolist(), begins.tolist()):
                out = self._merge_long(symbols[a : a + sizes[f]].tolist())
                done.append((np.array(out, np.int64), np.full(len(out), f)))
            short = (sizes <= LONG)[fragment]
            symbols, fragment = symbols[short], fragment[short]
        while len(symbols):
            rank = np.full(len(symbols), NO_RANK, np.int64)
            same = np.flatnonzero(fragment[1:] == fragment[:-1])
            rank[same] = self.pairs.rank(symbols[same], symbols[same + 1])
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), first)
            joins = best >> 32 < NO_RANK
            open_ = np.repeat(joins, np.diff(np.append(first, len(symbols))))
            if not joins.all():
                done.append((symbols[~open_], fragment[~open_]))
            at = best[joins] & 0xFFFFFFFF
            symbols[at] = self.pairs.result[best[joins] >> 32]
            open_[at + 1] = False
            symbols, fragment = symbols[open_], fragment[open_]
        flat, number = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(number, kind="stable")
        return flat[order], number[order]

    def _merge_long(self, parts: list[int]) -> list[int]:
        merges = self.merges
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = [(merges[pair][0], i, *pair, merges[pair][1]) for i, pair in enumerate(zip(parts, parts[1:])) if pair in merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (found := merges.get((parts[left], parts[right]))):
                    heapq.heappush(heap, (found[0], left, parts[left], parts[right], found[1]))
        return [p for p in parts if p >= 0]

    def _words(self, text: str) -> list[str]:
        text = normalised(text)
        return _SAME.findall(text) if self.usual and not _UNUSUAL.search(text) else self.words.findall(text)

    def _pieces(self, text: str) -> list[list[str] | int]:
        """Lists of words, and ids of special tokens between them."""
        if not self.special or not self.special.search(text):
            return [self._words(text)]
        return [self.specials[p] if p in self.specials else self._words(p) for p in self.special.split(text) if p]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has."""
        flat, counts, size, group = [], [], 0, []
        for text in texts:
            group.append(self._pieces(text))
            size += len(text)
            if size > GROUP_CHARS:
                self._encode_group(group, flat, counts)
                size, group = 0, []
        self._encode_group(group, flat, counts)
        return np.concatenate(flat), np.concatenate(counts)

    def _encode_group(self, group: list, flat: list, counts: list) -> None:
        """Append the ids of a group of texts, and the numbers of ids."""
        words = list(chain.from_iterable(p for pieces in group for p in pieces if isinstance(p, list)))
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > self.remembered:
            self._forget()
            new = list(set(words))
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        begins, sizes = self.bounds[slots], self.bounds[slots + 1] - self.bounds[slots]
        ends = np.cumsum(sizes)
        ids = self.store[np.repeat(begins - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        ends, at, parts, made = np.concatenate([[0], ends]), 0, [], []
        for pieces in group:
            count = 0
            for piece in pieces:
                if isinstance(piece, list):
                    begin, at = at, at + len(piece)
                    count += int(ends[at] - ends[begin])
                else:
                    parts.append((int(ends[at]), piece))
                    count += 1
            made.append(count)
        if parts:
            places, specials = zip(*parts)
            ids = np.insert(ids, places, specials)
        flat.append(ids)
        counts.append(np.array(made, np.int64))

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def composed(text: str) -> str:
    """The composed form, in which the marks that the library does not know are plain characters."""
    if not _PLAIN_MARK.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in _PLAIN_MARK.split(text))


def normalised(text: str) -> str:
    """Composed form, then lower case character by character (a final sigma is not special)."""
    if not text.isascii():
        text = composed(text).replace("Σ", "σ")
        if _HAS_LATER_LOWER.search(text):
            text = text.translate(_LOWER)
    return text.lower()


_LOADED: dict[str, Tokenizer] = {}


def _tokenizer(sent) -> Tokenizer:
    """One tokenizer for each file and worker process."""
    if sent.id not in _LOADED:
        _LOADED.clear()
        _LOADED[sent.id] = Tokenizer(sent.value)
    return _LOADED[sent.id]


class _Sent:
    """The file's bytes as a broadcast, which is bounded by the vocabulary."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.content, self.id = spark.sparkContext.broadcast(content), xxhash.xxh64_hexdigest(content)

    @property
    def value(self) -> bytes:
        return self.content.value


def _mapped(df: DataFrame, names: list[str], fn, results: dict[str, str]) -> DataFrame:
    """``df``'s columns ``names`` with those that ``fn`` gives for each batch."""
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names] + [f"`{c}` {k}" for c, k in results.items()])

    def run(batches):
        for batch in batches:
            for part, made in fn(batch):
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *made], [*names, *results])

    return df.mapInArrow(run, schema)


def _ids_array(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat, pa.int32()))


def _decoded(tokenizer: Tokenizer, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.cumsum(counts)
    return pa.array([tokenizer.decode(flat[e - n : e].tolist()) for e, n in zip(ends.tolist(), counts.tolist())], pa.string())


def encode(df: DataFrame, path: str, text: str = "text", result: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text``, and with the text they decode to if its column is named."""
    sent = _Sent(df.sparkSession, path)

    def parts(batch):
        tokenizer = _tokenizer(sent)
        for part, _ in blocks(iter([batch]), text, GROUP_CHARS):
            flat, counts = tokenizer.encode_all(pc.fill_null(part.column(text), "").to_pylist())
            yield part, [_ids_array(flat, counts), *([_decoded(tokenizer, flat, counts)] if decoded else [])]

    names = [c for c in df.columns if c not in (result, decoded)]
    return _mapped(df, names, parts, {result: "array<int>", **({decoded: "string"} if decoded else {})})


def decode(df: DataFrame, path: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids: the tokens joined by a space, special ones included."""
    sent = _Sent(df.sparkSession, path)

    def parts(batch):
        column = batch.column(ids)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        yield batch, [_decoded(_tokenizer(sent), column.flatten().to_numpy(zero_copy_only=False), counts)]

    return _mapped(df, [c for c in df.columns if c != result], parts, {result: "string"})


def with_digests(coded: DataFrame, *kept: str) -> DataFrame:
    """Number of tokens and digests of the columns ``ids`` and ``decoded``, beside the columns ``kept``."""
    return coded.select(
        *kept, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def digests(df: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, for each row."""
    return with_digests(encode(df.select(key, "text"), path, decoded="decoded"), key)
