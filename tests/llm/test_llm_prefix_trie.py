"""The prefix trie against a plain dictionary of prefixes, with blocks of any size; hot prefixes, copies, depth, odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import rows_of, with_clashes

from tallyward.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def name(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def rebuilt(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), name(role or "", text or ""), len((text or "").encode())))
    whole = {c: [x[1:] for x in sorted(turns)] for c, turns in found.items()}
    out = {}
    for c, turns in whole.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = whole.get(head, [])[:h] + turns[h:]
    return out


def plain_python(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * (node[-1][1] if node else 0)
    out = []
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **blocks):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(rows_of(trie.prefix_trie(trie.rebuilt(trie.paths(table)), **blocks), *COLUMNS), key=str)


def random_rows(seed, n, words, depth):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words)) for c in rng.sample(range(-n, 3 * n), n) for t in range(rng.randint(1, depth))]


@pytest.mark.parametrize("blocks", [{"conversations": 1}, {"conversations": 2}, {"conversations": 7}, {"block_turns": 11}, {}])
def test_blocks_of_any_size(spark, blocks):
    rows = random_rows(1, 200, ["a", "b", "é"], 12)
    assert found(spark, rows, **blocks) == plain_python(rebuilt(rows))


def test_hot_prefixes_and_copies(spark):
    """A third of all conversations are copies of one, a third share their first turns, over many blocks."""
    rng = random.Random(2)
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(14)]
    rows += [(c, t, "user", f"same {t}" if t < 11 else rng.choice("xyz")) for c in range(1_000, 1_300) for t in range(rng.randint(9, 15))]
    rows += [(c, t, "user", str(rng.random())) for c in range(2_000, 2_300) for t in range(rng.randint(1, 10))]
    assert found(spark, rows, conversations=20) == plain_python(rebuilt(rows))


def test_long_conversations(spark):
    rows = [(c, t, "user", f"{t}" if t < 700 else f"{c} {t}") for c in (5, 7, 8, 1001) for t in range(900 - c % 9)]
    for blocks in ({}, {"conversations": 1}):
        assert found(spark, rows, **blocks) == plain_python(rebuilt(rows))


def test_odd_rows(spark):
    """NULLs in every column, rows of one turn, repeated rows, empty texts, conversations that are left without a turn, columns with clashing names."""
    rows = [(None, 1, "user", "lost"), (1, None, "user", "first"), (1, 2, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (1, 2, "user", "tie"), (-3, 0, "user", "x"),
            (0, 0, "user", "é" * 70_000), (0, 1, "", ""), *[(c, 0, "user", "one") for c in range(5, 25)], (2**62, 0, "a", "b"), (7, 0, "1:a", "b"), (8, 0, "1", ":ab")]
    assert found(spark, rows) == plain_python(rebuilt(rows))
    assert any(not turns for turns in rebuilt(rows).values())
    table = with_clashes(spark.createDataFrame(rows, SCHEMA))
    for c in ("depth", "key", "block", "turns", "_head", "chain", "n_convs", "path", "name", "bytes"):
        table = table.withColumn(c, table["role"])
    assert sorted(rows_of(trie.prefix_trie(trie.rebuilt(trie.paths(table))), *COLUMNS), key=str) == plain_python(rebuilt(rows))


def test_an_empty_table(spark):
    assert found(spark, []) == []


def test_without_rebuilding(spark):
    rows = random_rows(3, 60, ["a", "b"], 5)
    table = spark.createDataFrame(rows, SCHEMA)
    convs = defaultdict(list)
    for c, t, role, text in sorted(rows):
        convs[c].append((name(role, text), len(text)))
    assert sorted(rows_of(trie.prefix_trie(trie.paths(table)), *COLUMNS), key=str) == plain_python(convs)
