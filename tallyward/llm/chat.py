"""Chat formatting: conversations through a compiled template, and back.

The turns of a conversation are rendered in order of turn (ties by role, then text) to pieces of text, each marked as generated or
not. Pieces are rows, so that a conversation of any length is never one value: put together in order of ``piece`` they are the
formatted text. The rows of a conversation are sorted, not gathered; a task holds one turn at a time and digests as it
reads, which for one conversation can only go in order.

Texts and roles are escaped by the template, so that control strings in them cannot end a turn, and ``read_back`` restores them
exactly. NULL roles and texts are empty. Rows that share a conversation and a turn are turns of their own. Rows with a NULL
conversation are one conversation. An empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.template import Template, unescape

OPEN, BETWEEN, CLOSE = "<turn>", "\n", "</turn>\n"
TEMPLATE = (
    "{%- for m in messages -%}"
    "{{ '<turn>' }}{{ m.role|escape|one_line }}{{ '\\n' }}"
    "{%- if m.role == 'assistant' -%}{%- generation -%}{{ m.text|escape }}{%- endgeneration -%}{%- else -%}{{ m.text|escape }}{%- endif -%}"
    "{{ '</turn>\\n' }}"
    "{%- endfor -%}"
)
#: Pieces of so many characters go out together.
FLUSH_CHARS = 1 << 20

_ORDER = ["conv_id", "turn", "role", "text"]


def _rows(batches, columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _rendered(source: str):
    def run(batches):
        template = Template(source)
        convs, numbers, texts, marks, size = [], [], [], [], 0
        for conv, rows in groupby(_rows(batches, _ORDER), key=lambda r: r[0]):
            messages = ({"role": role or "", "text": text or ""} for _, _, role, text in rows)
            for number, (text, marked) in enumerate(template.render(messages=messages)):
                convs.append(conv)
                numbers.append(number)
                texts.append(text)
                marks.append(marked)
                size += len(text) + 32
                if size > FLUSH_CHARS:
                    yield _pieces(convs, numbers, texts, marks)
                    convs, numbers, texts, marks, size = [], [], [], [], 0
        yield _pieces(convs, numbers, texts, marks)

    return run


def _pieces(convs, numbers, texts, marks):
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, pa.int64()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string()), pa.array(marks, pa.bool_())],
        ["conv_id", "piece", "text", "generated"])


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Pieces (``conv_id``, ``piece``, ``text``, ``generated``) of the formatted conversations.

    A partition holds whole conversations, one after the other and in order.
    """
    Template(template)  # fails here rather than in a task
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(_rendered(template), "conv_id long, piece long, text string, generated boolean")


class _Reader:
    """Reads the formatted text of one conversation back, turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.open, self.marked = [], []

    def take(self, text: str, generated: bool) -> None:
        self.chars += len(text)
        if generated:
            self.marked.append(text)
        elif self.marked:
            self._close_mark()
        self.open.append(text)
        if CLOSE in text:
            self._close_turn()

    def _close_mark(self) -> None:
        plain = unescape("".join(self.marked))
        self.loss_chars += len(plain)
        self.loss.update(plain.encode())
        self.marked = []

    def _close_turn(self) -> None:
        whole = "".join(self.open)
        *turns, rest = whole.split(CLOSE)
        for turn in turns:
            if not turn.startswith(OPEN):
                raise ValueError("a turn does not begin with its mark")
            role, _, text = turn[len(OPEN) :].partition(BETWEEN)
            self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            self.n_turns += 1
        self.open = [rest] if rest else []

    def result(self):
        if self.marked:
            self._close_mark()
        if self.open:
            raise ValueError("a turn is not closed")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches):
    found = []
    for conv, rows in groupby(_rows(batches, ["conv_id", "text", "generated"]), key=lambda r: r[0]):
        reader = _Reader()
        for _, text, generated in rows:
            reader.take(text, generated)
        found.append((conv, *reader.result()))
        if len(found) >= 10_000:
            yield _digests(found)
            found = []
    yield _digests(found)


def _digests(found):
    columns = list(zip(*found)) or [[]] * 6
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation the turns and the generated text read back from the pieces, as digests.

    Takes the pieces as ``format_conversations`` gives them, whole conversations in order.
    """
    return pieces.mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: What ``read_back`` gives for the table ``conversations`` and conversation -7, by the template above.
SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v (turn, role))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>' || replace(replace(replace(role, '\', '\\'), '<', '\l'), chr(10), '\n') || chr(10)
    || replace(replace(text, '\', '\\'), '<', '\l') || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
