"""Fill-in-middle against plain Python, with frames of every size; the store's frames, restoring, odd tables."""

import hashlib
import re

import pytest
import zstandard
from brute import odd_documents, rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import infill


def plain_python(key, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in infill.MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(rows):
    made = [(key, text or "", *plain_python(key, text)) for key, text in rows]
    return sorted((str(key), n, form, p, m, sha(output), sha(text)) for key, text, n, form, p, m, output in made)


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
TEXTS = ["", None, "a", "é", "abc", "abc " * 50, "x" * 5_000, "1234567890" * 30, "日本 語😀 mixed Words-and-more" * 20, "with <P> inside", "<S>", "<M" + ">", "< P> <P <S",
         "ends<P", "P>", "a\nb\r\n\tc", "\x00nul", "ab" * 3_000 + "." + "cd" * 3_000]


@pytest.mark.parametrize("size", [4, 7, 64, 1_000, infill.FRAME_BYTES])
def test_frames_of_any_size(spark, size):
    rows = [(i, t) for i, t in enumerate(TEXTS * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    parts = infill.fill_in_middle(docs, frame_bytes=size)
    found = rows_of(infill.digests(parts), *COLUMNS)
    assert sorted((str(r[0]), *r[1:]) for r in found) == wanted(rows)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    outputs = infill.outputs(parts).withColumn("text", infill.restored("form", "output"))
    by_key = dict(rows)
    for key, form, output, text in rows_of(outputs, "doc_id", "form", "output", "text"):
        assert (form, output) == plain_python(key, by_key[key])[1::3] and text == (by_key[key] or "")


def test_the_store(spark):
    """Frames are independent, and their units and code points add up; only frames with a cut are searched."""
    rows = [(i, f"{'word ' * 400}ünï {'z' * 700}") for i in range(20)]
    stored = infill.store(spark.createDataFrame(rows, "doc_id long, text string"), frame_bytes=200)
    texts = {}
    for r in stored.orderBy("text_id", "frame").collect():
        part = zstandard.ZstdDecompressor().decompress(r.payload).decode()
        before = texts.get(r.doc_id, "")
        assert r.units_before == len(re.findall("[A-Za-z]+|[^A-Za-z]", before)) and r.chars == len(part)
        assert r.inside == bool(before and before[-1].isascii() and before[-1].isalpha() and part[0].isascii() and part[0].isalpha())
        texts[r.doc_id] = before + part
    assert texts == dict(rows)
    parts = infill.pieces(infill.forms(stored))
    assert parts.where("not whole").select("doc_id", "frame").distinct().groupBy("doc_id").count().where("count > 2").count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<PSM>ab", max_size=25), st.text(alphabet="<PSM>ab", max_size=25), st.text(alphabet="<PSM>ab", max_size=25), st.integers(1, 9), st.booleans())
def test_reading_back(prefix, middle, suffix, size, psm):
    if any(m in prefix + middle + suffix for m in infill.MARKS):
        return
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if psm else f"<S>{suffix}<P>{prefix}<M>{middle}"
    reader = infill.Restorer("psm" if psm else "spm")
    data = output.encode()
    found = [p for at in range(0, len(data), size) for p in reader.take(data[at : at + size])]
    assert b"".join([*found, *reader.end()]).decode() == prefix + middle + suffix


def test_tables(spark):
    docs = with_clashes(odd_documents(spark))
    clashing = docs.withColumns({c: docs["lang"] for c in ("form", "part", "place", "text_id", "frame", "payload", "units", "chars", "marked", "key", "whole")})
    found = rows_of(infill.digests(infill.fill_in_middle(clashing)), *COLUMNS)
    assert sorted((str(r[0]), *r[1:]) for r in found) == wanted(rows_of(docs, "doc_id", "text"))
    assert infill.digests(infill.fill_in_middle(docs.limit(0))).count() == 0
