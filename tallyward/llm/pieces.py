"""SentencePiece BPE by vectorised merge rounds, and decoding.

Texts are cut into words before each run of spaces, which no piece crosses, and words into fragments wherever no piece holds the
two characters side by side. The distinct words of a block that are not known yet are merged together: flat numpy arrays hold
the symbols of all fragments end to end, a round finds the least rank of a pair in every fragment by a segmented minimum, joins
all its places at once from the left, and compacts the arrays, until no pair is left.

Joining one place may make a pair of an even better rank, which the library would take first. Pieces that can do so are known from the
vocabulary; of their places a round joins those up to the first where it happens, so the result is always that of one merge after the other.

The model file is the public protocol buffer with BPE pieces, byte fallback, no normalisation beyond the space mark and a
space put in front. It is read once by the driver and sent to the tasks, where it is a few megabytes whatever the corpus. A task
holds a block of texts or one text, and a bounded number of known words.

NULL and empty texts have no ids and decode to the empty text. An id that is not in the vocabulary fails the job. Other columns
stay as they are, but for a column named like a result, which is replaced.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from tallyward.llm.textblocks import blocks

SPACE = "▁"
#: Words remembered by a task; beyond that it starts anew.
REMEMBERED = 400_000
#: Bytes of text that are encoded together.
GROUP_BYTES = 4 << 20
NO_RANK = 1 << 40

# Kinds of pieces and numbers of fields in the model file (fixed values of its format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECE_FIELD, TRAINER_FIELD, NORMALIZER_FIELD = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, WHITESPACE_SUFFIX, BPE = 3, 35, 24, 2
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
UNKNOWN_SURFACE = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            value = struct.unpack("<f" if kind == 5 else "<d", data[at : at + size])[0]
            at += size
        yield tag >> 3, value


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, content: bytes, remembered: int = REMEMBERED):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(content):
            if number == PIECE_FIELD:
                found = dict(_fields(value))
                pieces.append((found[PIECE_TEXT].decode(), found.get(PIECE_SCORE, 0.0), found.get(PIECE_KIND, NORMAL)))
            elif number == TRAINER_FIELD:
                trainer = dict(_fields(value))
            elif number == NORMALIZER_FIELD:
                normalizer = dict(_fields(value))
        kinds = {kind for _, _, kind in pieces}
        if (trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK) or trainer.get(WHITESPACE_SUFFIX) or kinds & {USER_DEFINED, UNUSED}
                or normalizer.get(CHARSMAP) or normalizer.get(REMOVE_SPACES, 1) or not normalizer.get(DUMMY_PREFIX, 1) or not normalizer.get(ESCAPE_SPACES, 1)):
            raise ValueError("only BPE models with byte fallback and without normalisation can be read")
        self.size = len(pieces)
        ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self._read_pieces(pieces)
        self._read_merges(ids, [score for _, score, _ in pieces])
        self.remembered = remembered
        self._forget()

    def _read_pieces(self, pieces: list[tuple[str, float, int]]) -> None:
        """What each id decodes to, and the id of each byte and character."""
        self.is_byte = np.array([kind == BYTE for _, _, kind in pieces])
        surfaces = []
        for text, _, kind in pieces:
            if kind == BYTE:
                surfaces.append(bytes([int(text[1:-1], 16)]))
            else:
                surfaces.append({CONTROL: "", UNKNOWN: UNKNOWN_SURFACE}.get(kind, text.replace(SPACE, " ")).encode())
        self.is_control = np.array([kind == CONTROL for _, _, kind in pieces])
        self.lengths = np.array([len(s) for s in surfaces], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(surfaces), np.uint8)
        self.byte_ids = np.zeros(256, np.int64)
        self.byte_ids[[surfaces[i][0] for i in np.flatnonzero(self.is_byte)]] = np.flatnonzero(self.is_byte)
        # A character that is no piece is a symbol of its own beyond the ids until it becomes bytes.
        self.char_ids = np.arange(0x110000, dtype=np.int64) + self.size
        for i, (text, _, kind) in enumerate(pieces):
            if kind == NORMAL and len(text) == 1:
                self.char_ids[ord(text)] = i
        self.char_ids[ord(" ")] = self.char_ids[ord(SPACE)]

    def _read_merges(self, ids: dict[str, int], scores: list[float]) -> None:
        """Pairs of ids that make a piece, with its rank; better scores have lower ranks, and equal ones the same."""
        order = {score: rank for rank, score in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
        pairs, joined, self.step = [], [], len(scores) + 1
        unsafe = np.zeros(len(scores), bool)
        beside = set()
        for text, i in ids.items():
            beside.update(zip(text, text[1:]))
            for k in range(1, len(text)):
                a, b = ids.get(text[:k]), ids.get(text[k:])
                if a is not None and b is not None:
                    pairs.append(a * self.step + b)
                    joined.append(order[scores[i]] << 20 | i)
                    for part in (a, b):
                        unsafe[part] |= scores[part] <= scores[i]
        at = np.argsort(np.array(pairs, np.int64))
        self.pairs, self.joined = np.append(np.array(pairs, np.int64)[at], np.iinfo(np.int64).max), np.append(np.array(joined, np.int64)[at], NO_RANK)
        self.unsafe = unsafe
        self.beside = np.unique(np.array([ord(x) << 21 | ord(y) for x, y in beside], np.int64))
        # The words of a text can be merged apart if spaces stand at the begin of pieces only.
        self.apart = all(SPACE not in text.lstrip(SPACE) for text in ids)
        # Words of spaces are cut to the longest piece of spaces, where the merges do so too and nothing else holds two spaces.
        runs = [len(text) for text in ids if not text.strip(SPACE)]
        self.run = 0
        if runs and not any(SPACE * 2 in text and text.strip(SPACE) for text in ids):
            space, longest = ids.get(SPACE, 0), max(runs)
            whole = [self._merged(np.full(k, space), np.zeros(k, np.int64))[0].tolist() for k in range(1, 3 * longest + 1)]
            worst = {scores[ids[SPACE * k]] for k in runs} == {min(scores)}
            if worst and all(whole[k - 1] == whole[longest - 1] + whole[k - longest - 1] for k in range(longest + 1, 3 * longest + 1)):
                self.run = longest

    def _forget(self) -> None:
        """Known words by number; the ids of word ``i`` are ``store[bounds[i]:bounds[i + 1]]``."""
        self.known: dict[bytes, int] = {}
        self.store, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and id of what pairs of symbols make, in one number."""
        keys = np.where((a < self.size) & (b < self.size), a * self.step + b, -1)
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.joined[at], NO_RANK)

    def _merged(self, symbols: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and fragment numbers once no pair is left to join."""
        done = []
        same = fragment[1:] == fragment[:-1]
        joins = np.full(len(symbols), NO_RANK, np.int64)
        joins[:-1][same] = self._rank(symbols[:-1][same], symbols[1:][same])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(joins, first) >> 20
            ready = least == NO_RANK >> 20
            if ready.any():
                out = np.repeat(ready, sizes)
                done.append((symbols[out], fragment[out]))
                symbols, fragment, joins = symbols[~out], fragment[~out], joins[~out]
                if not len(symbols):
                    break
                sizes, least = sizes[~ready], least[~ready]
            places = np.flatnonzero(joins >> 20 == np.repeat(least, sizes))
            made = joins[places] & 0xFFFFF
            # Of places one after the other every second is joined.
            begins = np.concatenate([[True], np.diff(places) != 1])
            nth = np.arange(len(places))
            keep = (nth - np.maximum.accumulate(np.where(begins, nth, 0))) % 2 == 0
            places, made = places[keep], made[keep]
            keep = self._before_better(symbols, fragment, places, made, joins[places] >> 20)
            places, made = places[keep], made[keep]
            symbols[places] = made
            left = np.ones(len(symbols), bool)
            left[places + 1] = False
            now = places - np.arange(len(places))
            symbols, fragment, joins = symbols[left], fragment[left], joins[left]
            # Pairs with the new symbols.
            changed = np.concatenate([now, now[now > 0] - 1])
            joins[changed] = NO_RANK
            inner = changed[changed < len(symbols) - 1]
            inner = inner[fragment[inner] == fragment[inner + 1]]
            joins[inner] = self._rank(symbols[inner], symbols[inner + 1])
        flat, number = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(number, kind="stable")
        return flat[order], number[order]

    def _before_better(self, symbols, fragment, places, made, rank) -> np.ndarray:
        """True at the places up to the first in each fragment whose new symbol makes a pair of no worse rank with what stands beside it then."""
        if not self.unsafe[made].any():
            return np.ones(len(places), bool)
        before = np.where(np.concatenate([[False], places[1:] == places[:-1] + 2]), np.roll(made, 1), symbols[places - 1])
        after = symbols[np.minimum(places + 2, len(symbols) - 1)]
        better = self.unsafe[made]
        held = np.flatnonzero(better)
        at = places[held]
        left = np.where((at > 0) & (fragment[at - 1] == fragment[at]), self._rank(before[held], made[held]) >> 20, NO_RANK)
        right = np.where((at + 2 < len(symbols)) & (fragment[np.minimum(at + 2, len(symbols) - 1)] == fragment[at]), self._rank(made[held], after[held]) >> 20, NO_RANK)
        better[held] = np.minimum(left, right) <= rank[held]
        # How many such places stand before each one in its fragment.
        passed = np.cumsum(better) - better
        first = np.flatnonzero(np.concatenate([[True], fragment[places[1:]] != fragment[places[:-1]]]))
        return passed == np.repeat(passed[first], np.diff(np.append(first, len(places))))

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not known yet, all at once."""
        points = np.frombuffer(b"".join(words).decode().replace(" ", SPACE).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter((len(w.decode()) for w in words), np.int64, len(words))
        ends = np.cumsum(sizes)
        cut = np.ones(len(points), bool)
        keys = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        cut[1:] = self.beside[at] != keys
        cut[ends[:-1]] = True
        flat, fragment = self._merged(self.char_ids[points], np.cumsum(cut) - 1)
        word = np.searchsorted(ends, np.flatnonzero(cut), "right")[fragment]
        flat, word = self._as_bytes(flat, word)
        limits = np.searchsorted(word, np.arange(1, len(words) + 1))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.bounds = np.concatenate([self.bounds, limits + len(self.store)])
        self.store = np.concatenate([self.store, flat.astype(np.int32)])

    def _as_bytes(self, flat: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no pieces become the ids of their bytes."""
        odd = np.flatnonzero(flat >= self.size)
        if not len(odd):
            return flat, word
        coded = [chr(c).encode() for c in (flat[odd] - self.size).tolist()]
        times = np.ones(len(flat), np.int64)
        times[odd] = [len(c) for c in coded]
        out = np.repeat(flat, times)
        out[np.repeat(flat >= self.size, times)] = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        return out, np.repeat(word, times)

    def _words(self, data: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Where the words of texts in UTF-8 begin."""
        cut = np.zeros(len(data), bool)
        cut[limits[:-1][np.diff(limits) > 0]] = True
        if self.apart:
            space = data == 32
            before = np.concatenate([[False], space[:-1]]) & ~cut
            cut |= space & ~before
            if self.run:
                begins = np.flatnonzero(cut)
                nth = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
                cut |= space & before & (nth % self.run == 0)
        return np.flatnonzero(cut)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no NULLs) end to end, and how many each has."""
        texts = texts.cast(pa.large_string())
        marked = pc.replace_substring(pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))), SPACE, " ")
        _, limits, values = marked.buffers()
        limits = np.frombuffer(limits, np.int64, len(marked) + 1, marked.offset * 8)
        if limits[-1] == limits[0]:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        data = np.frombuffer(values, np.uint8)[limits[0] : limits[-1]]
        begins = self._words(data, limits - limits[0])
        ends = pa.py_buffer(np.append(begins, len(data)))
        coded = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, ends, pa.py_buffer(data)]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.remembered:
            self._forget()
            new = words
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        starts, sizes = self.bounds[slots], self.bounds[slots + 1] - self.bounds[slots]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.store[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(begins, limits - limits[0])])

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.large_string()))[0].tolist()

    def decode_all(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of ids end to end, of which each text has so many."""
        if len(flat) and (flat.min() < 0 or flat.max() >= self.size):
            raise ValueError("an id is not in the vocabulary")
        limits = np.concatenate([[0], np.cumsum(counts)])
        lengths, begins = self.lengths[flat].copy(), self.begins[flat].copy()
        # The space in front of the first piece that is no mark of control.
        shown = np.flatnonzero(~self.is_control[flat])
        at = np.searchsorted(shown, limits[:-1])
        leading = shown[at[at < len(shown)]]
        leading = leading[leading < limits[1:][at < len(shown)]]
        # The unknown piece's surface is no space mark.
        spaced = leading[(lengths[leading] > 0) & ~self.is_byte[flat[leading]] & (flat[leading] != 0)]
        spaced = spaced[self.bytes[begins[spaced]] == 32]
        begins[spaced] += 1
        lengths[spaced] -= 1
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.bytes[np.repeat(begins - total[:-1], lengths) + np.arange(total[-1])]
        ends = total[limits]
        found = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        try:
            data.tobytes().decode()
            if ((data[ends[:-1][ends[:-1] < len(data)]] & 0xC0) != 0x80).all():
                return found.cast(pa.large_string())
        except UnicodeDecodeError:
            pass
        odd = self.is_byte[flat]
        texts = []
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
            texts.append(_replaced(data[total[a] : total[b]].tobytes(), total[a : b + 1] - total[a], odd[a:b]))
        return pa.array(texts, pa.large_string())


def _replaced(data: bytes, limits: np.ndarray, is_byte: np.ndarray) -> str:
    """A text in which each byte of a run of byte pieces that is no UTF-8 becomes U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        edges = np.flatnonzero(np.diff(is_byte.astype(np.int8))) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(is_byte)]):
            part, at = data[limits[a] : limits[b]], 0
            while at < len(part):
                for size in (4, 3, 2, 1):
                    try:
                        out.append(part[at : at + size].decode() if is_byte[a] else part[at:].decode())
                        at = at + size if is_byte[a] else len(part)
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    at += 1
        return "".join(out)


class _Sent:
    """The file's bytes as a broadcast, which is bounded by the vocabulary."""

    loaded: dict[str, Pieces] = {}

    def __init__(self, spark, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.content, self.id = spark.sparkContext.broadcast(content), xxhash.xxh64_hexdigest(content)

    def pieces(self) -> Pieces:
        """One encoder for each file and worker process."""
        if self.id not in self.loaded:
            self.loaded.clear()
            self.loaded[self.id] = Pieces(self.content.value)
        return self.loaded[self.id]


def _mapped(df: DataFrame, names: list[str], fn, results: dict[str, str]) -> DataFrame:
    """``df``'s columns ``names`` with those that ``fn`` gives for each batch."""
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names] + [f"`{c}` {k}" for c, k in results.items()])

    def run(batches):
        for batch in batches:
            for part, made in fn(batch):
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *made], [*names, *results])

    return df.mapInArrow(run, schema)


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat, pa.int32()))


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for part, _ in blocks(iter([batch]), text, GROUP_BYTES):
        yield part, pc.fill_null(part.column(text), "")


def encode(df: DataFrame, path: str, text: str = "text", result: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text``, and with the text they decode to if its column is named."""
    sent = _Sent(df.sparkSession, path)

    def parts(batch):
        pieces = sent.pieces()
        for part, texts in _texts(batch, text):
            flat, counts = pieces.encode_all(texts)
            yield part, [_lists(flat, counts), *([pieces.decode_all(flat, counts).cast(pa.string())] if decoded else [])]

    return _mapped(df, [c for c in df.columns if c not in (result, decoded)], parts, {result: "array<int>", **({decoded: "string"} if decoded else {})})


def decode(df: DataFrame, path: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids."""
    sent = _Sent(df.sparkSession, path)

    def parts(batch):
        column = batch.column(ids)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        yield batch, [sent.pieces().decode_all(column.flatten().to_numpy(zero_copy_only=False), counts).cast(pa.string())]

    return _mapped(df, [c for c in df.columns if c != result], parts, {result: "string"})


def _sha256(values: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(v).hexdigest() for v in values.cast(pa.large_binary()).to_pylist()], pa.string())


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text, for each row."""
    sent = _Sent(df.sparkSession, path)

    def parts(batch):
        pieces = sent.pieces()
        for part, texts in _texts(batch, text):
            flat, counts = pieces.encode_all(texts)
            decimal = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pa.array(flat).cast(pa.string()))
            yield part, [pa.array(counts, pa.int64()), _sha256(pc.binary_join(decimal, ",")), _sha256(pieces.decode_all(flat, counts))]

    return _mapped(df.select(key, text), [key], parts, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
