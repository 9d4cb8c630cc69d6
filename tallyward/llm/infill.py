"""Fill-in-middle over a store of compressed frames that can be read from any place.

A text is stored as independent zstandard frames of about 64 KB, each with the number of units (a run of ASCII letters, or any other
code point) and code points before it. Where a text is cut is found by unit number: only the frames that hold a cut are
decompressed to find its place, all other frames belong to one part as they are. The parts' frames are put in the
order of the output, those of texts of several frames after an exchange by text, and each text's output is made, digested and read back frame by frame: what comes later in the text than in the output
waits compressed. A task holds a block of texts while it stores, then one frame and one text's compressed suffix.

Rows are numbered when they are stored, so rows that share a key, repeated rows and rows without a key stay apart. The
cuts come from the key (NULL: as the empty string) and the number of units, so they are the same on every run. NULL and empty texts
are plain and have no units. Columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.textblocks import blocks, table_of
from tallyward.operators.staging import stage

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes of text in a frame, about.
FRAME_BYTES = 1 << 16
#: Percent of texts that are transformed, and of these the percent whose suffix comes first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Parts of a text, and where each stands in the output of the forms.
PARTS = ("prefix", "middle", "suffix")
PLACES = {"plain": (0, 1, 2), "psm": (0, 2, 1), "spm": (1, 2, 0)}
ROW_STEP = 1 << 33
LEVEL = 1

_STORE = "text_id long, n long, marked boolean, frames int, frame int, units_before long, units long, inside boolean, chars long, payload binary"
_LETTERS = table_of(bytes([*range(65, 91), *range(97, 123)]))


def _unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """True at the bytes that begin a unit; ``starts`` are the first bytes of the texts."""
    letter = _LETTERS[data]
    begin = (data & 0xC0) != 0x80
    follows = np.concatenate([[False], letter[:-1]])
    follows[starts[starts < len(data)]] = False
    return begin & ~(letter & follows)


def _cuts(data: np.ndarray, begin: int, end: int, size: int) -> list[int]:
    """Limits of frames between two bytes, never inside a code point."""
    limits = [begin]
    while end - limits[-1] > size:
        at = limits[-1] + size
        while (data[at] & 0xC0) == 0x80:
            at -= 1
        limits.append(at)
    return [*limits, end]


def _stored(key: str, text: str, size: int, schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        number = TaskContext.get().partitionId() * ROW_STEP
        for part, block in blocks(batches, text):
            starts = _unit_starts(block.data, block.offsets[:-1])
            units = np.concatenate([[0], np.cumsum(starts)])
            points = np.concatenate([[0], np.cumsum(block.code_points())])
            texts = pc.fill_null(part.column(text), "")
            marked = pc.match_substring_regex(texts, "|".join(MARKS)).to_pylist()
            rows, columns = [], [[] for _ in range(10)]
            for i, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist())):
                limits = _cuts(block.data, a, b, size)
                total, before = int(units[b] - units[a]), int(units[a])
                for frame, (lo, hi) in enumerate(zip(limits, limits[1:])):
                    rows.append(i)
                    found = (number, total, marked[i], len(limits) - 1, frame, int(units[lo]) - before, int(units[hi] - units[lo]), hi > lo and not starts[lo],
                             int(points[hi] - points[lo]), packer.compress(block.data[lo:hi].tobytes()))
                    for column, value in zip(columns, found):
                        column.append(value)
                number += 1
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part.column(key).take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]], schema)

    return run


def store(df: DataFrame, key: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The texts as frames in a table: ``key``, number of the row, units of the whole text, and per frame its units and payload.

    ``inside`` is true for a frame that begins within a unit, which counts for the frame before.
    """
    fields = [f.split()[0] for f in _STORE.split(", ")]
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, {_STORE}"
    return stage(df.select(key, text).mapInArrow(_stored(key, text, frame_bytes, [key, *fields]), schema), "frames")


def _number(key: str, nth: int) -> Column:
    """The nth group of eight digits of the key's digest as a number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def forms(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """``stored`` with the form of each text and the units after which its prefix and middle end."""
    one, two = (_number(key, k) % (F.col("n") + 1) for k in (1, 2))
    plain = (F.col("n") == 0) | F.col("marked") | (_number(key, 3) % 100 >= TRANSFORMED)
    form = F.when(plain, "plain").when(_number(key, 4) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    return stored.withColumns({"form": form, "prefix_end": F.least(one, two), "middle_end": F.greatest(one, two)})


def pieces(formed: DataFrame) -> DataFrame:
    """For each part of a text the frames that hold some of it, and between which units of the frame it lies.

    A frame that lies in one part is ``whole`` and is never searched. The pieces of a frame are in the order of the output.
    """
    begin = F.col("units_before") - F.col("inside").cast("int")
    end = F.col("units_before") + F.col("units")
    plain = F.col("form") == "plain"
    limits = [F.lit(0), F.when(plain, F.col("n")).otherwise(F.col("prefix_end")),
              F.when(plain, F.col("n")).otherwise(F.col("middle_end")), F.col("n")]
    made = []
    for part, (lo, hi) in enumerate(zip(limits, limits[1:])):
        place = F.when(F.col("form") == "spm", PLACES["spm"][part]).when(plain, PLACES["plain"][part]).otherwise(PLACES["psm"][part])
        first, last = F.greatest(lo, begin), F.least(hi, end)
        # An empty text has one frame without units, in the first part.
        here = (first < last) | ((F.col("n") == 0) & F.lit(part == 0))
        made.append(F.when(here, F.struct(
            place.alias("place"), F.lit(part).alias("part"), (first - F.col("units_before")).alias("from_unit"), (last - F.col("units_before")).alias("to_unit"),
            ((first == begin) & (last == end)).alias("whole"))))
    return formed.withColumn("_piece", F.explode(F.array_sort(F.filter(F.array(*made), lambda p: p.isNotNull())))).select(
        *[c for c in formed.columns if c not in ("marked", "prefix_end", "middle_end")], "_piece.*")


def in_output_order(parts: DataFrame) -> DataFrame:
    """A text's pieces in one partition, one after the other as the output has them. Texts of one frame are so already."""
    many = parts.where("frames > 1").repartition("text_id").sortWithinPartitions("text_id", "place", "frame")
    return parts.where("frames = 1").unionByName(many)


def _cut_out(data: bytes, begin: int, end: int, inside: bool) -> bytes:
    """What lies from one unit of a frame to another; a unit that began in the frame before has number -1."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return data
    found = _unit_starts(codes, np.zeros(1, np.int64))
    if inside:
        found[0] = False
    places = np.append(np.flatnonzero(found), len(data))
    return data[0 if begin < 0 else places[begin] : places[min(end, len(places) - 1)]]


def _parts(rows) -> Iterator[tuple[int, bytes, int]]:
    """Number of the part, bytes and code points of the pieces of one text."""
    unpacker = zstandard.ZstdDecompressor()
    for row in rows:
        data = unpacker.decompress(row["payload"])
        if row["whole"]:
            yield row["part"], data, row["chars"]
        else:
            data = _cut_out(data, row["from_unit"], row["to_unit"], row["inside"])
            yield row["part"], data, len(data.decode())


def _output(form: str, found: Iterator[tuple[int, bytes, int]], chars: list[int]) -> Iterator[bytes]:
    """The output in pieces; adds up the code points of each part."""
    marks = [b""] * 3 if form == "plain" else [m.encode() for m in (PREFIX, MIDDLE, SUFFIX)]
    order = sorted(range(3), key=PLACES[form].__getitem__)
    at = 0
    yield marks[order[0]]
    for part, data, count in found:
        while order[at] != part:
            at += 1
            yield marks[order[at]]
        chars[part] += count
        yield data
    for part in order[at + 1 :]:
        yield marks[part]


class Restorer:
    """Reads an output piece by piece and gives the text back; the suffix waits in compressed frames.

    Marks are found wherever the pieces are cut.
    """

    def __init__(self, form: str):
        self.form, self.part, self.rest, self.waiting = form, None, b"", []
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.marks = {m.encode(): m for m in MARKS}

    def take(self, data: bytes) -> Iterator[bytes]:
        if self.form == "plain":
            yield data
            return
        data = self.rest + data
        while True:
            at = min((i for i in (data.find(m) for m in self.marks) if i >= 0), default=-1)
            if at < 0:
                break
            yield from self._give(data[:at])
            self.part = self.marks[data[at : at + 3]]
            data = data[at + 3 :]
        keep = next((k for k in (2, 1) if any(m.startswith(data[-k:]) for m in self.marks if data)), 0)
        yield from self._give(data[: len(data) - keep])
        self.rest = data[len(data) - keep :]

    def _give(self, data: bytes) -> Iterator[bytes]:
        if data and self.part == SUFFIX:
            self.waiting.append(self.packer.compress(data))
        elif data:
            yield data

    def end(self) -> Iterator[bytes]:
        yield from self._give(self.rest)
        unpacker = zstandard.ZstdDecompressor()
        for data in self.waiting:
            yield unpacker.decompress(data)


_ROW = ("text_id", "key", "n", "form", "part", "from_unit", "to_unit", "whole", "inside", "chars", "payload")


def _rows(batches, key):
    for batch in batches:
        columns = [batch.column(key if c == "key" else c).to_pylist() for c in _ROW]
        for values in zip(*columns):
            yield dict(zip(_ROW, values))


def _per_text(batches, key):
    """The first row, and the output in pieces with the code points of the parts, of each text."""
    for _, rows in groupby(_rows(batches, key), key=lambda r: r["text_id"]):
        first = next(rows)
        chars = [0, 0, 0]

        def again(first=first, rows=rows):
            yield first
            yield from rows

        yield first, _output(first["form"], _parts(again()), chars), chars


def _digester(key, kind):
    names = [key, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def batch(found):
        columns = list(zip(*found)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches):
        found = []
        for first, output, chars in _per_text(batches, key):
            made, back, restorer = hashlib.sha256(), hashlib.sha256(), Restorer(first["form"])
            for data in output:
                made.update(data)
                for piece in restorer.take(data):
                    back.update(piece)
            for piece in restorer.end():
                back.update(piece)
            plain = first["form"] == "plain"
            found.append((first["key"], first["n"], first["form"], None if plain else chars[0], None if plain else chars[1], made.hexdigest(), back.hexdigest()))
            if len(found) >= 10_000:
                yield batch(found)
                found = []
        yield batch(found)

    return run


def digests(ordered: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per text its form, the code points of prefix and middle, and the digests of the output and of the text read back from it."""
    kind = ordered.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return ordered.mapInArrow(_digester(key, _arrow(kind)), schema)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def outputs(ordered: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per text its key, form and whole output."""
    kind = ordered.schema[key].dataType

    def run(batches):
        for first, output, _ in _per_text(batches, key):
            yield pa.RecordBatch.from_arrays(
                [pa.array([first["key"]], _arrow(kind)), pa.array([first["form"]]), pa.array([b"".join(output).decode()])], [key, "form", "output"])

    return ordered.mapInArrow(run, f"`{key}` {kind.simpleString()}, form string, output string")


def restored(form: Column | str, output: Column | str) -> Column:
    """The text that an output was made from."""
    form, output = (F.col(c) if isinstance(c, str) else c for c in (form, output))
    part = [F.regexp_extract(output, f"(?s){m}(.*?)(?:<[PSM]>|\\z)", 1) for m in (PREFIX, MIDDLE, SUFFIX)]
    return F.when(form == "plain", output).otherwise(F.concat(*part))


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The pieces of all outputs in order, for ``digests`` and ``outputs``."""
    return in_output_order(pieces(forms(store(df, key, text, frame_bytes), key)))


SQL = r"""
WITH cut AS (
  SELECT doc_id, text, n, '0x' || substr(h, 1, 8) AS h1, '0x' || substr(h, 9, 8) AS h2, '0x' || substr(h, 17, 8) AS h3, '0x' || substr(h, 25, 8) AS h4, units
  FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, len(units) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents)),
formed AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3::BIGINT % 100 >= 90 THEN 'plain'
    WHEN h4::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[:least(h1::BIGINT % (n + 1), h2::BIGINT % (n + 1))], '') AS prefix,
    array_to_string(units[least(h1::BIGINT % (n + 1), h2::BIGINT % (n + 1)) + 1:greatest(h1::BIGINT % (n + 1), h2::BIGINT % (n + 1))], '') AS middle,
    array_to_string(units[greatest(h1::BIGINT % (n + 1), h2::BIGINT % (n + 1)) + 1:], '') AS suffix FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM formed
"""
