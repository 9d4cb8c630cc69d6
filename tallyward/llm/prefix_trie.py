"""The trie of conversation prefixes, found by truncation peeling.

A node of depth d is a distinct sequence of the first d turns; its members are the conversations that begin with it. The
trie is peeled from the greatest depth on: conversations that end at a depth join the nodes that survive from below, the last
turn is stripped, nodes that are equal then become one, and members, children, leaves and saved bytes are added up on the way.

Conversations are dealt out by ranges of their paths (16 bytes of digest a turn) and ids, so a first turn or a whole
conversation that a third of all rows share is many tasks' work. Each block of a task is peeled by itself. Only the nodes on the
paths of its first and last conversation can go on in other blocks. These open nodes are a row a block, are merged by key,
and get the sums of their subtrees from running sums: in path order a subtree is one range of blocks. The number of jobs
does not depend on the depth, and nothing goes through the driver. What a task holds is one block; one conversation is one row of
16 bytes and a number a turn.

Rows are ordered by turn (NULL first); rows of one turn by the digest of role and text. NULL roles and texts are empty, rows
without a ``conv_id`` belong to no conversation, repeated rows are turns of their own, other columns are not read. An empty
table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.staging import stage

#: Conversations and turns that are peeled together, at most (one conversation at least).
BLOCK_CONVERSATIONS = 10_000
BLOCK_TURNS = 1_000_000
#: Bytes of digest that name a turn.
NAME = 16
#: Numbers of blocks: the partition, then the block in it.
PARTITION_STEP = 1 << 32
NO_ENDS = hashlib.sha256(b"").hexdigest()

_PEELED = {"block": pa.int64(), "is_open": pa.bool_(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(),
           "key": pa.string(), "parent_key": pa.string(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
           "saved_tokens": pa.int64(), "last_bytes": pa.int64(), "on_first": pa.bool_(), "on_last": pa.bool_(), "ends": pa.string()}
_SPARK = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}


def paths(conversations: DataFrame) -> DataFrame:
    """A row for each conversation: ``conv_id`` and its turns in order, as (turn, name, bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.substring(F.unhex(digest), 1, NAME).alias("name"), F.octet_length(text).alias("bytes")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(whole: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Each conversation behind the first h turns of its group's first one, instead of its own first h.

    The group's first one is ``conv_id - conv_id % group``, and h is the CRC-32 of the decimal id modulo ``most + 1``.
    """
    heads = whole.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_head"), F.slice("turns", 1, most).alias("_lead"))
    own = whole.withColumns({"_head": F.col("conv_id") - F.col("conv_id") % group,
                             "_h": (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")})
    lead = F.when(F.col("_lead").isNull() | (F.col("_h") == 0), F.slice("turns", 1, 0)).otherwise(F.expr("slice(_lead, 1, _h)"))
    rest = F.expr(f"slice(turns, _h + 1, {2**31 - 1})")
    return own.join(heads, "_head", "left").select("conv_id", F.concat(lead, rest).alias("turns"))


def _blocks(batches, conversations: int, turns: int):
    """Slices of the batches with the ids, paths and sizes of their conversations."""
    for batch in batches:
        lengths = batch.column("n").to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths), 0
        while at < batch.num_rows:
            before = ends[at] - lengths[at]
            end = min(max(at + 1, int(np.searchsorted(ends, before + turns, "right"))), at + conversations)
            part = batch.slice(at, end - at)
            names = np.frombuffer(b"".join(part.column("path").to_pylist()), np.uint64).reshape(-1, NAME // 8)
            yield (part.column("conv_id").to_numpy(zero_copy_only=False), lengths[at:end], names,
                   part.column("sizes").flatten().to_numpy(zero_copy_only=False))
            at = end


def _shared_turns(lengths: np.ndarray, starts: np.ndarray, names: np.ndarray) -> np.ndarray:
    """How many first turns each conversation has in common with the one before it (the first one: -1)."""
    shared = np.full(len(lengths), -1, np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    shared[1:] = both
    pairs = np.flatnonzero(both) + 1
    if len(pairs):
        sizes = both[pairs - 1]
        first = np.cumsum(sizes) - sizes
        nth = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        same = (names[np.repeat(starts[pairs], sizes) + nth] == names[np.repeat(starts[pairs - 1], sizes) + nth]).all(axis=1)
        shared[pairs] = np.minimum.reduceat(np.where(same, np.repeat(sizes, sizes), nth), first)
    return shared


def _keys(names: np.ndarray) -> list[str]:
    """Digests of all prefixes of one path, the empty one first."""
    running, out = hashlib.sha256(), []
    for name in [b"", *(n.tobytes() for n in names)]:
        running.update(name)
        out.append(running.copy().hexdigest())
    return out


def _peel(convs: np.ndarray, lengths: np.ndarray, names: np.ndarray, sizes: np.ndarray):
    """Columns of all nodes of one block of conversations, which are in the order of their paths.

    A node is met first at one conversation, its head: conversation i is the head of the depths after ``shared[i]``.
    """
    starts = np.cumsum(lengths) - lengths
    shared = _shared_turns(lengths, starts, names)
    counts = lengths - shared
    head = np.repeat(np.arange(len(convs)), counts)
    depth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(shared + 1, counts)
    order = np.lexsort((head, depth))
    head, depth = head[order], depth[order]
    deepest = int(lengths.max())
    level = np.searchsorted(depth, np.arange(deepest + 2))
    ended = np.argsort(lengths, kind="stable")
    ends_at = np.searchsorted(lengths[ended], np.arange(deepest + 2))

    n = len(head)
    members, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
    smallest = np.full(n, np.iinfo(np.int64).max)
    parent = np.full(n, -1, np.int64)
    on_first, on_last = head == 0, np.zeros(n, bool)
    on_last[level[1 : int(lengths[-1]) + 2] - 1] = True
    is_open = on_first | on_last
    last_bytes = np.where(depth > 0, sizes[np.minimum(starts[head] + depth - 1, len(sizes) - 1)], 0) if len(sizes) else np.zeros(n, np.int64)
    for d in range(deepest, -1, -1):
        here = slice(level[d], level[d + 1])
        new = ended[ends_at[d] : ends_at[d + 1]]  # the conversations that end here join the surviving nodes
        if len(new):
            node = level[d] + np.searchsorted(head[here], new, "right") - 1
            np.add.at(members, node, 1)
            np.minimum.at(smallest, node, convs[new])
        leaves[here] += (children[here] == 0) & ~is_open[here]
        saved[here] += np.where(is_open[here], 0, (members[here] - 1) * last_bytes[here])
        if d:  # the last turn goes, and nodes that are equal then are one
            above = level[d - 1] + np.searchsorted(head[level[d - 1] : level[d]], head[here], "right") - 1
            parent[here] = above
            np.add.at(members, above, members[here])
            np.minimum.at(smallest, above, smallest[here])
            done = ~is_open[here]
            np.add.at(children, above[done], 1)
            np.add.at(leaves, above[done], leaves[here][done])
            np.add.at(saved, above[done], saved[here][done])

    begins = np.flatnonzero(np.append(True, (shared[1:] < lengths[1:]) | (lengths[1:] != lengths[:-1])))
    last = dict(zip(begins.tolist(), [*begins[1:].tolist(), len(convs)]))  # where the copies of a conversation end
    ends, key, parent_key = [None] * n, [None] * n, [None] * n
    for i in np.flatnonzero(lengths[head] == depth).tolist():
        ids = ",".join(map(str, convs[head[i] : last[int(head[i])]].tolist()))
        ends[i] = ids if is_open[i] else hashlib.sha256(ids.encode()).hexdigest()
    first_keys = _keys(names[: lengths[0]])
    last_keys = _keys(names[starts[-1] : starts[-1] + lengths[-1]])
    for i in np.flatnonzero(is_open).tolist():
        key[i] = (first_keys if on_first[i] else last_keys)[depth[i]]
    open_parent = (parent >= 0) & is_open[parent]
    for i in np.flatnonzero(open_parent).tolist():
        parent_key[i] = key[parent[i]]
    parent_conv = pa.array(smallest[parent], mask=(parent < 0) | open_parent)
    return [pa.array(is_open), pa.array(smallest), pa.array(depth.astype(np.int64)), parent_conv, pa.array(key, pa.string()),
            pa.array(parent_key, pa.string()), pa.array(members), pa.array(children), pa.array(leaves), pa.array(saved),
            pa.array(last_bytes.astype(np.int64)), pa.array(on_first), pa.array(on_last), pa.array(ends, pa.string())]


def _peeler(conversations: int, turns: int):
    def run(batches):
        block = TaskContext.get().partitionId() * PARTITION_STEP
        for part in _blocks(batches, conversations, turns):
            columns = _peel(*part)
            number = pa.array(np.full(len(columns[0]), block, np.int64))
            yield pa.RecordBatch.from_arrays([number, *columns], list(_PEELED))
            block += 1

    return run


def _end_digests(batches):
    """Digests of the lists of ids, whose pieces come in order, a key after the other."""
    key, running, found = None, None, []
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    found.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256(piece.encode())
            else:
                running.update(b"," + piece.encode())
        yield _pairs(found)
        found = []
    yield _pairs(found if key is None else [*found, (key, running.hexdigest())])


def _pairs(found):
    keys, digests = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "ends_sha256"])


def _subtree_sums(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """``nodes`` with the sums of ``own_leaves`` and ``own_saved`` over their subtrees.

    A block brings two chains of new nodes: those on the path of its first conversation, then those on that of its last. In
    this order a subtree is the rest of the node's chain and the whole chains from there to ``last_chain``.
    """
    down = Window.partitionBy("chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rest = nodes.withColumns({c: F.sum(f"own_{c}").over(down) for c in ("leaves", "saved")})
    totals = rest.groupBy("chain").agg(F.sum("own_leaves").alias("all_leaves"), F.sum("own_saved").alias("all_saved"))
    chains = blocks.select(F.explode(F.array(F.col("block") * 2, F.col("block") * 2 + 1)).alias("chain"))
    part = F.shiftright("chain", 33)
    filled = chains.join(totals, "chain", "left").withColumn("part", part).fillna(0, ["all_leaves", "all_saved"])
    sums = [F.sum(f"all_{c}").alias(f"all_{c}") for c in ("leaves", "saved")]
    # A row a partition; its running sums begin those within the partition.
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = filled.groupBy("part").agg(*sums).select("part", *[F.coalesce(F.sum(f"all_{c}").over(before), F.lit(0)).alias(f"part_{c}") for c in ("leaves", "saved")])
    within = Window.partitionBy("part").orderBy("chain").rowsBetween(Window.unboundedPreceding, 0)
    running = filled.withColumns({f"to_{c}": F.sum(f"all_{c}").over(within) for c in ("leaves", "saved")}).join(parts, "part").select(
        "chain", *[(F.col(f"to_{c}") + F.col(f"part_{c}")).alias(f"to_{c}") for c in ("leaves", "saved")])
    own = running.toDF("chain", "from_leaves", "from_saved")
    to = running.withColumnRenamed("chain", "last_chain")
    return rest.join(own, "chain").join(to, "last_chain").withColumns(
        {c: F.col(c) + F.col(f"to_{c}") - F.col(f"from_{c}") for c in ("leaves", "saved")})


def prefix_trie(turns: DataFrame, conversations: int = BLOCK_CONVERSATIONS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """All nodes of the trie of ``turns``, as ``paths`` or ``rebuilt`` give them.

    Per node the smallest member, the depth, the smallest member of the parent (root: NULL), the numbers of members, children
    and childless nodes in the subtree, the bytes that storing each text of the subtree once saves, and the digest of the ids that end there.
    """
    flat = turns.select("conv_id", F.size("turns").alias("n"), F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["name"])), "")).alias("path"),
                        F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    dealt = flat.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    schema = ", ".join(f"{c} {_SPARK[k]}" for c, k in _PEELED.items())
    peeled = stage(dealt.mapInArrow(_peeler(conversations, block_turns), schema), "peeled")

    pieces = peeled.where("is_open")
    low = F.col("block") * 2 + (~F.col("on_first")).cast("int")
    high = F.col("block") * 2 + F.col("on_last").cast("int")
    merged = stage(pieces.groupBy("key").agg(
        F.first("parent_key", ignorenulls=True).alias("parent_key"), F.first("depth").alias("depth"), F.first("last_bytes").alias("last_bytes"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed"),
        F.sum("n_leaves").alias("hung_leaves"), F.sum("saved_tokens").alias("hung_saved"), F.min(low).alias("chain"), F.max(high).alias("last_chain")), "open-nodes")
    below = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    nodes = merged.join(below, "key", "left").withColumn("n_children", F.col("closed") + F.coalesce("open_children", F.lit(0))).withColumns({
        "own_leaves": F.col("hung_leaves") + (F.col("n_children") == 0).cast("long"),
        "own_saved": F.col("hung_saved") + (F.col("n_convs") - 1) * F.col("last_bytes")})
    summed = _subtree_sums(nodes, pieces.select("block").distinct())
    listed = pieces.where("ends is not null").select("key", "block", "ends").repartition("key").sortWithinPartitions("key", "block")
    ends = listed.mapInArrow(_end_digests, "key string, ends_sha256 string")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    opened = summed.join(ends, "key", "left").join(above, "parent_key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    # Closed nodes below an open one meet it within their block, so the children of a hot node are dealt out.
    local = pieces.select("block", "key").join(merged.select("key", F.col("conv_id").alias("_above")), "key").withColumnRenamed("key", "parent_key")
    closed = peeled.where("not is_open").join(local, ["block", "parent_key"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    return opened.unionByName(closed)


#: The nodes of the rebuilt conversations. CRC-32 goes byte by byte through its usual table.
SQL = r"""
WITH RECURSIVE crc_bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) AS t (i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS steps FROM crc_bits WHERE k = 8),
turns AS (
  SELECT conv_id::BIGINT AS c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
    strlen(coalesce(text, '')) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32), strlen(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS head, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: xor(crc >> 8, steps[(xor(crc, byte) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table),
rebuilt AS (
  SELECT convs.c, 0 AS own, pos, name, bytes FROM convs JOIN turns ON turns.c = convs.head AND pos <= h
  UNION ALL SELECT convs.c, 1, pos, name, bytes FROM convs JOIN turns ON turns.c = convs.c AND pos > h),
steps AS (
  SELECT c, row_number() OVER w AS depth, sha256(string_agg(name, '') OVER w) AS key, bytes FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
path AS (SELECT * FROM steps UNION ALL SELECT c, 0, '', 0 FROM convs),
up AS (SELECT a.*, b.key AS parent FROM path a LEFT JOIN path b ON a.c = b.c AND b.depth = a.depth - 1),
lengths AS (SELECT c, max(depth) AS n FROM path GROUP BY c),
nodes AS (
  SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
  FROM up JOIN lengths USING (c) GROUP BY key, depth),
counted AS (
  SELECT a.*, b.conv_id AS parent_conv_id, coalesce(n_children, 0) AS n_children
  FROM nodes a LEFT JOIN nodes b ON b.key = a.parent AND b.depth = a.depth - 1
    LEFT JOIN (SELECT parent AS above, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1) ON above = a.key),
summed AS (
  SELECT path.key, path.depth, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * d.bytes) AS saved_tokens
  FROM counted d JOIN path ON path.c = d.conv_id AND path.depth <= d.depth GROUP BY path.key, path.depth)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN summed USING (key, depth)
"""
