"""Prefix trie of conversations by truncation peeling (operator 12).

A node is a distinct sequence of first turns; its members are the conversations that
begin with it.  Nodes are found from the deepest level upwards: at each depth the
conversations that end there are merged with the nodes that survive from below,
the merged nodes are complete and leave, and what they stand for goes on with its last
turn stripped, regrouped by the shorter sequence.  Members, smallest member,
children, leaves and saved tokens are added up on the way, so discovery and
aggregation are one pass.

Turns are told by 128 bits of the SHA-256 of role and text, sequences by a chained
128-bit BLAKE2b, so texts never leave the tasks that read them.  An entry carries
the keys of its sequence, 16 bytes a turn.

One round of the peeling takes all depths above a floor at once: entries are dealt
by their key at the floor, and everything deeper is peeled where it lies.
The floor is the least one of 1, 2, 4, ... at which no group has more than GROUP
turns above it; where even the next depth has such a group (a first turn that a third of all
conversations share, say) the round is one level by Spark's own aggregation, which adds up
a group of any size on the map side.  Rounds thus grow with the logarithm of the
depth, and with the number of levels where a single sequence has thousands of continuations.

Defined cases: turns go by turn number, null first, equal numbers by the digest of role and
text; repeated rows are turns of their own; a null role or text is the empty string.  A row
without a conversation id belongs to no conversation.  A conversation without turns
ends at the root.  No conversations, no nodes.  Other columns are not looked at.

Bound: a conversation is one row, some 40 bytes a turn.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import Steps, sent

#: Bytes of a key, turns of a group that one task peels, children from which a node counts as crowded.
KEY, GROUP, CROWDED = 16, 1 << 17, 1024
#: Crowded nodes that a broadcast may hold, some 100 bytes each.
CROWDED_SENT = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_TURNS = "array<struct<turn:bigint,digest:binary,words:bigint>>"
_ENTRY = ("key binary, depth int, path binary, words array<bigint>, n_convs bigint, conv_id bigint, "
          "n_children bigint, n_leaves bigint, saved bigint, ends string")
_OUT = _ENTRY + ", final boolean"
_ARROW = pa.schema([("key", pa.binary()), ("depth", pa.int32()), ("path", pa.binary()), ("words", pa.list_(pa.int64())),
                    *[(n, pa.int64()) for n in ("n_convs", "conv_id", "n_children", "n_leaves", "saved")],
                    ("ends", pa.string()), ("final", pa.bool_())])


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, turn, digest, words) of every row that has a conversation id."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("bigint").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * KEY)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))


def in_order(rows: Column) -> Column:
    """Turns of a conversation sorted by number (null first), then by digest."""
    return F.sort_array(rows).cast(_TURNS)


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) of a table of ``turns``."""
    return rows.groupBy("conv_id").agg(in_order(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns"))


def _paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, key, path, words): the chained keys of a conversation's prefixes, the last one being its own."""
    def run(batches):
        for batch in batches:
            keys, paths = [], []
            for seq in batch.column("digests").to_pylist():
                key, path = b"", []
                for digest in seq:
                    key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
                    path.append(key)
                keys.append(key)
                paths.append(b"".join(path))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(keys, pa.binary()), pa.array(paths, pa.binary()),
                 batch.column("words")], names=["conv_id", "key", "path", "words"])

    t = F.coalesce(F.col("turns"), F.array().cast(_TURNS))
    return sequences.select("conv_id", F.transform(t, lambda x: x["digest"]).alias("digests"),
                            F.transform(t, lambda x: x["words"]).alias("words")).mapInArrow(
        run, "conv_id bigint, key binary, path binary, words array<bigint>")


def _ends(paths: DataFrame) -> DataFrame:
    """Entries of the conversations that end at a sequence, one per distinct sequence."""
    def run(batches):
        at, digest, n, first = None, None, 0, None

        def entry():
            key, path, words = at
            return {"key": key, "depth": len(path) // KEY, "path": path, "words": words, "n_convs": n, "conv_id": first,
                    "n_children": 0, "n_leaves": 0, "saved": 0, "ends": digest.hexdigest(), "final": False}

        for batch in batches:
            done = []
            ids, keys = batch.column("conv_id").to_pylist(), batch.column("key").to_pylist()
            for i, (c, key) in enumerate(zip(ids, keys)):
                if at is None or key != at[0]:
                    if at is not None:
                        done.append(entry())
                    at = (key, batch.column("path")[i].as_py(), batch.column("words")[i].as_py())
                    digest, n, first = hashlib.sha256(str(c).encode()), 1, c
                else:  # sorted by id: one running hash whatever the number of copies
                    digest.update(b",%d" % c)
                    n += 1
            if done:
                yield pa.RecordBatch.from_pylist(done, _ARROW)
        if at is not None:
            yield pa.RecordBatch.from_pylist([entry()], _ARROW)

    return paths.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, _OUT)


class _Level(dict):
    """Entries of one depth by key; entries of the same sequence become one."""

    def add(self, e: list) -> None:
        old = self.setdefault(e[0], e)
        if old is not e:
            old[4] += e[4]
            old[5] = min(old[5], e[5])
            for k in (6, 7, 8):
                old[k] += e[k]
            old[9] = old[9] or e[9]


def _peel_rows(rows: list[list], floor: int) -> list[tuple]:
    """Peel entries deeper than ``floor``; complete nodes and the entries that survive at the floor.

    A complete node keeps its parent's key in place of the path.
    """
    levels: dict[int, _Level] = {}
    for e in rows:
        levels.setdefault(e[1], _Level()).add(e)
    out = []
    for depth in range(max(levels), floor, -1):
        above = levels.setdefault(depth - 1, _Level())
        for key, _, path, words, n, conv, children, leaves, saved, ends in levels.pop(depth, _Level()).values():
            leaves = leaves if children else 1
            saved += (n - 1) * words[depth - 1]
            parent = path[KEY * (depth - 2):KEY * (depth - 1)] if depth > 1 else b""
            out.append((key, depth, parent, None, n, conv, children, leaves, saved, ends, True))
            above.add([parent, depth - 1, path, words, n, conv, 1, leaves, saved, None])
    out.extend((e[0], floor, e[2][:KEY * floor], e[3][:floor], *e[4:], False) for e in levels[floor].values())
    return out


def _key_at(depth: Column) -> Column:
    """The key of an entry's first ``depth`` turns."""
    return F.col("path").substr((depth - 1) * KEY + 1, F.lit(KEY))


def _peel_groups(entries: DataFrame, floor: int) -> DataFrame:
    """Peel down to ``floor`` inside the groups of equal keys there, a run of whole groups at a time."""
    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for at, *e in zip(cols[-1], *cols[:-1]):
                if at != last and size > GROUP:
                    yield table(held)
                    held, size = [], 0
                last = at
                held.append(list(e))
                size += e[1] - floor
        if held:
            yield table(held)

    def table(rows):
        cols = list(zip(*_peel_rows(rows, floor)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)

    dealt = entries.withColumn("at", _key_at(F.lit(floor)))
    return dealt.repartition("at").sortWithinPartitions("at").mapInArrow(run, _OUT)


def _merged(entries: DataFrame) -> DataFrame:
    """Entries of one depth, those of the same sequence added up: complete nodes."""
    m = entries.groupBy("key", "depth").agg(
        F.min("path").alias("path"), F.min("words").alias("words"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
    own = (F.col("n_convs") - 1) * F.coalesce(F.try_element_at("words", F.lit(-1)), F.lit(0))
    leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("bigint")).otherwise(F.col("n_leaves"))
    return m.withColumn("n_leaves", leaves).withColumn("saved", F.col("saved") + own)


def _peel_level(entries: DataFrame, depth: int) -> DataFrame:
    """Peel one depth by aggregation; groups may have any size."""
    nodes = _merged(entries)
    up = F.lit(depth - 1)
    parent = _key_at(up) if depth > 1 else F.lit(b"")
    both = F.array(F.lit(True), F.lit(False))  # the node itself, and what goes on without its last turn
    n = nodes.withColumn("parent", parent).withColumn("final", F.explode(both))
    f = F.col("final")

    def pick(node, on):
        return F.when(f, node).otherwise(on)

    one = F.lit(1).cast("bigint")
    return n.select(
        pick(F.col("key"), F.col("parent")).alias("key"), pick(F.lit(depth), up).alias("depth"),
        pick(F.col("parent"), F.col("path").substr(F.lit(1), up * KEY)).alias("path"),
        pick(F.lit(None), F.slice("words", F.lit(1), up)).alias("words"), "n_convs", "conv_id",
        pick(F.col("n_children"), one).alias("n_children"), "n_leaves", "saved",
        pick(F.col("ends"), F.lit(None)).alias("ends"), "final")


def _floor(entries: DataFrame, depth: int, group: int) -> int | None:
    """The least floor of 1, 2, 4, ... above which no group has more than ``group`` turns."""
    floors = [1 << k for k in range(depth.bit_length()) if 1 << k < depth]
    if not floors:
        return None
    # a floor's groups count as a column each, so the entries are read once; floors are about ten
    dealt = entries.select("depth", "path", F.explode(F.array(*map(F.lit, floors))).alias("floor")).filter(
        F.col("depth") > F.col("floor"))
    most = (dealt.groupBy("floor", _key_at(F.col("floor")).alias("at")).agg(F.sum(F.col("depth") - F.col("floor")).alias("n"))
            .groupBy("floor").agg(F.max("n").alias("n")).collect())  # one row per floor
    return min((r["floor"] for r in most if r["n"] <= group), default=None)


def trie(sequences: DataFrame, group: int = GROUP) -> DataFrame:
    """All nodes of the trie of a table (conv_id, turns).

    Returns key, depth, parent_key, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the comma-joined ids of the conversations that end there).
    """
    steps = Steps(sequences.sparkSession, "conversation-trie")
    ends = steps.land(_ends(_paths(sequences)), "ends").drop("final")
    depth = ends.agg(F.max("depth")).first()[0] or 0
    survivors, nodes = None, []
    while depth > 0:
        def newly(floor):
            e = ends.filter((F.col("depth") > floor) & (F.col("depth") <= depth))
            return e if survivors is None else e.unionByName(survivors)

        floor = _floor(newly(0), depth, group)
        peeled = _peel_level(newly(depth - 1), depth) if floor is None else _peel_groups(newly(floor), floor)
        done = steps.land(peeled, f"depth{depth}")
        nodes.append(done.filter("final").drop("final"))
        survivors, depth = done.filter(~F.col("final")).drop("final"), depth - 1 if floor is None else floor
    top = ends.filter(F.col("depth") == 0)
    root = _merged(top if survivors is None else top.unionByName(survivors)).select(*top.columns)
    found = steps.land(reduce(DataFrame.unionByName, nodes + [root]).select(
        "key", "depth", F.col("path").alias("parent_key"), "conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")), "nodes")
    return _with_parents(found)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add the parent's smallest member; the children of crowded nodes do not meet in one task."""
    def as_parent(n):
        return n.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))

    crowded = F.col("n_children") > CROWDED
    below = nodes.filter(F.col("depth") > 0).join(sent(as_parent(nodes.filter(crowded)), CROWDED_SENT), "parent_key", "left")
    others = (below.filter(F.col("parent_conv_id").isNull()).drop("parent_conv_id")
              .join(as_parent(nodes.filter(~crowded)), "parent_key"))
    root = nodes.filter(F.col("depth") == 0).withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    return below.filter(F.col("parent_conv_id").isNotNull()).unionByName(others).unionByName(
        root.withColumn("parent_key", F.lit(None).cast("binary")))
