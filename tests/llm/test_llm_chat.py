"""Templates: folding, sandbox, rendering; conversations there and back."""

import hashlib
from collections import defaultdict

import pytest
from brute import SF, rows_of, with_clashes
from hypothesis import given
from hypothesis import strategies as st

from tallyward.llm import chat
from tallyward.llm.queries import QUERIES
from tallyward.llm.template import Template, TemplateError, escape, one_line, unescape


def text_of(source, **values):
    return "".join(t for t, _ in Template(source).render(**values))


@pytest.mark.parametrize("source, folded", [
    ("a{{ 1 + 2 * 3 }}b", [("text", "a7b")]), ("{% if false %}x{% elif 1 == 1 %}y{% else %}z{% endif %}", [("text", "y")]),
    ("{{ 'q'|upper ~ 2 }}", [("text", "Q2")]), ("{% if not true or 1 > 2 %}x{% endif %}", []), ("{{ 'it\\'s\\n' }}", [("text", "it's\n")]),
    ("{% generation %}{% endgeneration %}", []), ("{{ 'abc'|length - 1 }}", [("text", "2")]), ("a {%- if true -%} b {%- endif %}", [("text", "ab")]),
])
def test_constants_are_folded(source, folded):
    assert Template(source).body == folded


def test_rendering():
    assert text_of("{% for x in xs %}{{ loop.index }}{{ x.name }}{% if not loop.last %},{% endif %}{% endfor %}", xs=iter([{"name": "a"}, {"name": "b"}])) == "1a,2b"
    assert text_of("{% set y = x ~ '!' %}{{ y }}{% if x in ys %} in{% endif %}", x="a", ys=["a"]) == "a! in"
    assert text_of("{% for x in xs %}{% if x == 'b' and loop.first %}no{% elif x != 'b' %}{{ x }}{% endif %}{% endfor %}", xs=["a", "b"]) == "a"
    assert list(Template("a{% generation %}b{{ c }}{% endgeneration %}d").render(c="c")) == [("a", False), ("b", True), ("c", True), ("d", False)]


def test_rendering_holds_one_turn_at_a_time():
    read = []

    def turns():
        for i in range(1000):
            read.append(i)
            yield {"role": "user", "text": str(i)}

    pieces = Template(chat.TEMPLATE).render(messages=turns())
    next(pieces)
    assert len(read) <= 2


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x", "{% for %}", "{% if 1 %}", "{{ 'a'() }}", "{{ a|bad }}", "{{ y }}", "{{ 1 + 'a' }}",
                                    "{{ x }", "{% import os %}", "{{ x.upper }}", "{% endfor %}", "{{ x[0] }}", "{{ none }}", "{{ 1 2 }}", "{{ x %}"])
def test_the_sandbox(source):
    with pytest.raises(TemplateError):
        text_of(source, x="s")


@given(st.text(alphabet="<>/\\nl turn\n#", max_size=30))
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<" not in escape(text)
    assert unescape(one_line(escape(text))) == text and "\n" not in one_line(escape(text))


def plain(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


SAID = r"\### Assistant: </turn> ok"


def test_all_conversations(spark):
    rows = rows_of(spark.read.parquet(f"{SF}/conversations.parquet"), "conv_id", "turn", "role", "text")
    found = QUERIES["op6_chat_template"](spark, SF)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found.collect()}
    assert got == plain(rows + [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)])


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 0, None, "x"), (1, 0, None, "x"), (None, 1, "assistant", "\\n<</turn>\n"), (None, 2, "assistant", ""), (2, None, "a\nb<", "y"),
            (3, 0, "assistant", "long " * 300_000), (3, 1, "user", "</turn>\n<turn>assistant\nno</turn>\n"), (4, 1, "assistant", "two"), (4, 0, "assistant", "one")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_conversations(with_clashes(df))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(pieces).collect()}
    assert got == plain(rows)
    whole = "".join(t for _, t in sorted(rows_of(pieces.where("conv_id = 4"), "piece", "text")))
    assert whole == "<turn>assistant\none</turn>\n<turn>assistant\ntwo</turn>\n"
    chars = dict(rows_of(chat.read_back(pieces), "conv_id", "formatted_chars"))
    assert chars[4] == len(whole)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0
