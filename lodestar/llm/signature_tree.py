"""Exact Jaccard join of word shingles with signature trees (operator 4).

Sets of equal content form a class (keyed by a 64-bit hash of the sorted set);
everything below works on classes, so copies cost a row each and no more.

*Buckets.*  Two linked sets of sizes a and b differ in at most
``(a+b)(den-num)/(den+num)`` shingles.  Shingles are dealt by hash into a few more groups than
that bound for the larger size's level, so a linked pair agrees on whole
groups; a class's entry is (hash of group content, class).  Levels are size
ranges by powers of num/den: a set enters its own level and the next.  Empty
groups agree by chance: a level's spare groups make up for them, some more than the smallest set of the level
leaves empty, and a set with more empty groups than that enters those too.  No pair above the threshold shares no bucket.
Buckets with the same members are one.

*First links.*  Each class is compared on the full sets with the least of the first
classes of its buckets; that joins nearly all copies that differ a little, in one comparison each.
Members and first classes of a bucket that are still apart are compared next.

*Trees.*  What is left is buckets with three or more members in more than one
component.  Their members are leaves of a signature tree: a node holds the OR of its token
bitmaps, its size range and the component if all its leaves share one.  A
traversal of the tree against itself drops node pairs whose largest possible
overlap is below what their least sizes need, and pairs within one component,
which need no further link.  A first pass hands on a spanning forest of the surviving leaf pairs only, the most similar
first, so fewer than there are members; they are compared on the full sets and join components.
A second pass hands on every pair of the components that are still apart, so no link is lost.
A large bucket is cut into tiles; every pair of tiles is a task of its own.
Long texts that are alike share hundreds of buckets: each class carries its ``LEAD`` least ones, and a pair is handed on
only by the least that both carry, or by every shared one if they carry none in common.

Full sets are larger than the texts, so none is stored: pairs that their bitmaps allow have theirs made from the texts again.

Defined cases: a null text, or one without words, has the empty set and is
linked with nothing; repeated rows get the same result each; a null doc_id is
never the least id of a component unless all its ids are null.  Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import Steps, land, map_texts
from lodestar.llm.components import components

#: Least spare groups of a level.
SLACK = 3
#: Least bits of a token bitmap, children of a tree node, members of a tile, node pairs looked at together.
BITS, FANOUT, TILE, FRONT = 2048, 8, 2048, 1 << 16
#: Least buckets that a class carries to the trees.
LEAD = 16
#: Ids that a broadcast bit filter may mark, and its 64-bit words (some 20 MB as a join table).
FILTER_IDS, FILTER_WORDS = 1 << 20, 1 << 18
#: Pairs (two longs each) that are broadcast, some 30 MB as a join table.
PAIRS_SENT = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_CLASSES_SEEN = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, all texts of a slice together.

    A word is hashed eight bytes at a time, a longer one than ``LONG`` bytes by xxhash; words of at most eight bytes and
    equal length never meet.
    """

    #: Bytes between the texts' words, and masks of the first 0 to 8 bytes.
    _space = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    _mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    LONG = 64

    def __init__(self, width: int):
        self.width = width
        self.odd = mix(np.arange(1, width + 1, dtype=np.uint64) * _ODD[0]) | np.uint64(1)

    def _hashes(self, raw: bytes, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes of the words at ``start``; at least eight bytes follow the last one."""
        block = np.ndarray(len(raw) - 7, "S8", raw, strides=(1,))  # the eight bytes from each place on

        def bytes_at(at, most):
            return block[at].view("<u8") & self._mask[np.minimum(most, 8)]
        h = mix(bytes_at(start, n) + n.astype(np.uint64) * _ODD[0])
        more = np.flatnonzero((n > 8) & (n <= self.LONG))
        done = 8
        while len(more):
            h[more] = mix(h[more] ^ bytes_at(start[more] + done, n[more] - done))
            done += 8
            more = more[n[more] > done]
        for k in np.flatnonzero(n > self.LONG).tolist():
            h[k] = xxhash.xxh3_64_intdigest(raw[start[k]:start[k] + n[k]])
        return h

    def _mixed(self, w: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the runs of ``k`` words."""
        total = np.full(len(w) - k + 1, k, np.uint64) * _ODD[1]
        for i in range(k):
            total += w[i:len(w) - k + 1 + i] * self.odd[i]
        return mix(total)

    def __call__(self, texts: list) -> list[np.ndarray]:
        parts = [(t or "").encode() for t in texts]
        raw = b" ".join([b"", *parts, b" " * 8]).lower()  # of bytes: ASCII letters and white space only
        space = self._space[np.frombuffer(raw, np.uint8)]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, n = edge[::2], edge[1::2] - edge[::2]
        w = self._hashes(raw, start, n)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        cut = [0, *np.searchsorted(start, np.cumsum(size + 1)).tolist()]
        every = self._mixed(w, self.width) if len(w) >= self.width else w[:0]
        out = []
        for a, b in zip(cut, cut[1:]):
            if b - a >= self.width:
                s = np.sort(every[a:b - self.width + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            else:
                out.append(self._mixed(w[a:b], b - a) if b > a else w[:0])
        return out


class Levels:
    """Size levels of a threshold num/den and the number of groups of each, the ``spare`` ones among them."""

    def __init__(self, num: int, den: int):
        edge = [1]
        while edge[-1] < 1 << 40:
            edge.append(edge[-1] * den // num + 1)
        self.edge = np.array(edge)
        self.differ = [2 * (b - 1) * (den - num) // (den + num) for b in edge[1:]]
        self.spare = [self._spare(d, edge[max(0, k - 1)]) for k, d in enumerate(self.differ)]

    @staticmethod
    def _spare(differ: int, least: int) -> int:
        """Three deviations more than the groups that ``least`` shingles, the fewest that enter the level, leave empty.

        Sets with more empty groups meet all others that leave the same ones empty, linked or not, so they should be
        few.  A quarter of the bound at most: short sets would have a group for each shingle.
        """
        spare = SLACK
        while spare < differ // 4:
            k = differ + 1 + spare
            empty = k * (1 - 1 / k) ** least
            if spare >= empty + 3 * empty ** 0.5:
                break
            spare += 1 + spare // 16
        return min(spare, max(SLACK, differ // 4))

    def entries(self, s: np.ndarray) -> np.ndarray:
        """Bucket hashes of a sorted set, 48 bits each: the few that meet by chance are compared like all others."""
        own = int(np.searchsorted(self.edge, len(s), side="right")) - 1
        out = []
        value = mix(s ^ _ODD[2])
        for level in (own, own + 1):
            if not self.differ[level]:
                continue  # linked sets of this level are equal
            spare = self.spare[level]
            k = self.differ[level] + 1 + spare
            group = ((mix(s + np.uint64(int(_ODD[3]) * level % (1 << 64))) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(
                np.uint16 if k <= 1 << 16 else np.int64)  # few bits are sorted by counting
            order = np.argsort(group, kind="stable")
            g = group[order]
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            content, at = np.add.reduceat(value[order], cut), g[cut]
            if k - len(at) > spare:
                full = np.zeros(k, np.uint64)
                full[at] = content
                content, at = full, np.arange(k)
            out.append(mix(content * _ODD[0] + mix(at.astype(np.uint64) + np.uint64(level << 40))) >> np.uint64(16))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _fingerprint(s: np.ndarray) -> int | None:
    h = xxhash.xxh3_64_intdigest(s.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _bitmap(s: np.ndarray) -> bytes:
    """A power of two of bits, at least ``BITS`` and twice the set, so that it is never crowded."""
    n = max(BITS, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(n, np.uint8)
    bits[(s & np.uint64(n - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _matrix(bitmaps: list[bytes], width: int | None = None) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, longer ones folded to the shortest (a bit's place is a remainder)."""
    width = width or min(map(len, bitmaps))
    out = np.empty((len(bitmaps), width // 8), np.uint64)
    for k, b in enumerate(bitmaps):
        x = np.frombuffer(b, np.uint64)
        out[k] = x if len(b) == width else np.bitwise_or.reduce(x.reshape(-1, width // 8), 0)
    return out


def _sets(width: int):
    def make():
        shingle = Shingler(width)

        def run(texts):
            sets = shingle(texts)
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.int64())]
        return run
    return make


def _entries(width: int, num: int, den: int):
    def make():
        shingle, levels, seen = Shingler(width), Levels(num, den), set()

        def run(texts):
            cls, out = [], []
            for s in shingle(texts):
                f = _fingerprint(s) if len(s) else None
                if f is None or f in seen:  # a copy within this task has the same entries
                    cls.append(None)
                    out.append(None)
                    continue
                if len(seen) < _CLASSES_SEEN:
                    seen.add(f)
                cls.append(f)
                out.append(levels.entries(s).view(np.int64))
            return [pa.array(cls, pa.int64()), pa.array(out, pa.list_(pa.int64()))]
        return run
    return make


def _one_of_each(width: int, columns):
    """Class, size and ``columns(sets)`` of texts; the class is null for copies within a task and texts without words."""
    def make():
        shingle, seen = Shingler(width), set()

        def run(texts):
            cls, sets = [], []
            for s in shingle(texts):
                f = _fingerprint(s) if len(s) else None
                if f is None or f in seen:
                    cls.append(None)
                    sets.append(s[:0])
                    continue
                if len(seen) < _CLASSES_SEEN:
                    seen.add(f)
                cls.append(f)
                sets.append(s)
            return [pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), columns(sets)]
        return run
    return make


def _bitmaps(sets):
    return pa.array([_bitmap(s) if len(s) else None for s in sets], pa.binary())


def _shingles(sets):
    return pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))


# -- signature tree ----------------------------------------------------------------------------
class Tree:
    """Levels from the leaves up: OR bitmaps, size ranges, token excess and component of each node.

    ``excess`` is the most tokens of a leaf beyond its set bits: an overlap has at
    most the common bits plus that many tokens.
    """

    def __init__(self, ids, sizes, bitmaps, comps):
        order = np.lexsort((bitmaps[:, 0], comps, sizes))
        self.ids, bits, comp = ids[order], bitmaps[order], comps[order]
        size = sizes[order]
        excess = size - np.bitwise_count(bits).sum(1, dtype=np.int64)
        same = np.ones(len(size), bool)
        self.levels = [(bits, size, size, excess, comp, same)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, excess, comp, same = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                np.maximum.reduceat(excess, cut), comp[cut], np.logical_and.reduceat(same, cut)
                & (np.minimum.reduceat(comp, cut) == np.maximum.reduceat(comp, cut))))


def traverse(p: Tree, q: Tree, num: int, den: int, scored: bool = False):
    """Leaf pairs (i, j) of two trees, or of one with itself, that may reach the threshold; ``scored``: and the
    largest share of their sizes that their overlap may have."""
    one = p is q
    top = max(len(p.levels), len(q.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > FRONT:
            half = len(i) // 2
            stack += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
            continue
        lp, lq = min(level, len(p.levels) - 1), min(level, len(q.levels) - 1)
        pb, plow, phigh, pex, pc, ps = (x[i] for x in p.levels[lp])
        qb, qlow, qhigh, qex, qc, qs = (x[j] for x in q.levels[lq])
        need = -(-num * (plow + qlow) // (den + num))
        ok = (den * phigh >= num * qlow) & (den * qhigh >= num * plow) & ~(ps & qs & (pc == qc))
        if level == 0:
            common = np.minimum(plow - np.bitwise_count(pb & ~qb).sum(1, dtype=np.int64),
                                qlow - np.bitwise_count(qb & ~pb).sum(1, dtype=np.int64))
            if one:
                ok &= i < j
            ok &= common >= need
            yield (i[ok], j[ok], (common / (plow + qlow))[ok]) if scored else (i[ok], j[ok])
            continue
        common = np.bitwise_count(pb & qb).sum(1, dtype=np.int64) + np.minimum(pex, qex)
        ok &= common >= need
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        # the children of either side; a side whose tree is lower stays where it is
        def kids(tree, at, here):
            below = min(level - 1, len(tree.levels) - 1)
            if below == here:
                return at[:, None], np.ones((len(at), 1), bool)
            c = at[:, None] * FANOUT + np.arange(FANOUT)
            return c, c < len(tree.levels[below][1])
        ci, oi = kids(p, i, lp)
        cj, oj = kids(q, j, lq)
        a = np.repeat(ci, cj.shape[1], 1)
        b = np.tile(cj, (1, ci.shape[1]))
        good = np.repeat(oi, cj.shape[1], 1) & np.tile(oj, (1, ci.shape[1]))
        if one:
            good &= a <= b
        stack.append((level - 1, a[good], b[good]))


class Forest:
    """Union-find over rows."""

    def __init__(self, labels: np.ndarray):
        first: dict = {}
        self.up = [first.setdefault(c, k) for k, c in enumerate(labels.tolist())]

    def find(self, k: int) -> int:
        up = self.up
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def _leads(column: pa.ChunkedArray, bucket: int) -> np.ndarray:
    """The buckets before ``bucket`` that each row's class carries, a row each, filled up with ``bucket``."""
    lists = column.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    out = np.full((len(n), max(1, int(n.max(initial=0)))), bucket)
    out[np.arange(out.shape[1]) < n[:, None]] = lists.flatten().to_numpy()
    return np.minimum(out, bucket)


def _tree_pairs(num: int, den: int, spanning: bool):
    """Candidate pairs of each (bucket, tile pair) in a partition sorted by those.

    A pair whose classes both carry an earlier bucket (``lead``, if the rows have it) is left to that one.
    ``spanning``: of all candidates only a spanning forest of the components, the pairs of the largest possible overlap
    first, so fewer than there are members.
    """
    def pairs_of(group: pa.Table):
        ids = group["cls"].to_numpy()
        size = group["n"].to_numpy()
        comp = group["comp"].to_numpy()
        tile, ti, tj = (group[c].to_numpy() for c in ("tile", "ti", "tj"))
        if not (np.any(tile == ti[0]) and np.any(tile == tj[0])):
            return
        bits = _matrix(group["bitmap"].to_pylist())

        def tree(k):
            at = np.flatnonzero(tile == k)
            return Tree(at, size[at], bits[at], comp[at])
        p = tree(ti[0])
        q = p if ti[0] == tj[0] else tree(tj[0])
        bucket = group["bucket"][0].as_py()
        lead = _leads(group["lead"], bucket) if "lead" in group.column_names else np.full((len(ids), 1), bucket)

        def own(a, b):
            """The pairs of rows that no earlier bucket hands on."""
            out = np.ones(len(a), bool)
            for k in range(0, len(a), FRONT):
                x, y = lead[a[k:k + FRONT]], lead[b[k:k + FRONT]]
                for c in range(x.shape[1]):
                    out[k:k + FRONT] &= ~((x[:, c:c + 1] == y) & (y != bucket)).any(1)
            return out
        if not spanning:
            for i, j in traverse(p, q, num, den):
                a, b = p.ids[i], q.ids[j]
                mine = own(a, b)
                if mine.any():
                    yield pairs(ids[a[mine]], ids[b[mine]])
            return
        found = [(p.ids[i], q.ids[j], s) for i, j, s in traverse(p, q, num, den, True) if len(i)]
        if not found:
            return
        a, b, score = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(-score, kind="stable")
        forest, kept = Forest(comp), []
        for k, x, y in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
            if forest.find(x) != forest.find(y):
                forest.join(x, y)
                kept.append(k)
        a, b = a[kept], b[kept]
        mine = own(a, b)
        yield pairs(ids[a[mine]], ids[b[mine]])

    def pairs(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            if not t.num_rows:
                continue
            key = np.stack([t[c].to_numpy() for c in ("bucket", "ti", "tj")], 1)
            cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()]
            for a, b in zip(cut, cut[1:]):
                yield from pairs_of(t.slice(a, b - a))
            held = t.slice(cut[-1])
        if held is not None and held.num_rows:
            yield from pairs_of(held)
    return run


def _verified(pairs: DataFrame, n: int, sets_of, num: int, den: int) -> DataFrame:
    """The ``n`` pairs (a stored table) whose full sets, made by ``sets_of(classes)``, reach the threshold.

    Sets are large and pairs narrow: up to ``PAIRS_SENT`` pairs are broadcast, so that a set moves once for
    each pair that it is the second of and once if it is a first; more pairs are joined by shuffles.
    """
    a, b = (sets_of(pairs.select(F.col(x).alias("cls"))).toDF(x, f"n{x}", f"s{x}") for x in ("a", "b"))
    if n <= PAIRS_SENT:
        both = b.join(F.broadcast(pairs), "b").join(a.join(F.broadcast(pairs.select("a").distinct()), "a"), "a")
    else:
        both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return (both.filter((den + num) * common >= num * (F.col("na") + F.col("nb"))).select("a", "b").distinct())


def _possible(pairs: DataFrame, n: int, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The ``n`` pairs (a stored table) that their bitmaps allow to reach the threshold; only those move full sets."""
    def common(batch):
        na, nb = (batch[c].to_numpy() for c in ("na", "nb"))
        most = np.zeros(len(na), np.int64)
        a, b = batch["ma"].to_pylist(), batch["mb"].to_pylist()
        width = np.fromiter((min(len(x), len(y)) for x, y in zip(a, b)), np.int64, len(a))
        for w in set(width.tolist()):
            at = np.flatnonzero(width == w)
            for part in np.array_split(at, 1 + len(at) * w // (1 << 24)):
                x, y = (_matrix([m[k] for k in part.tolist()], w) for m in (a, b))
                most[part] = np.minimum(na[part] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64),
                                        nb[part] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
        return (den + num) * most >= num * (na + nb)

    def run(batches):
        for batch in batches:
            ok = pa.array(common(batch))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(ok), batch["b"].filter(ok)], ["a", "b"])

    facts = sets.select("cls", "n", "bitmap")
    a, b = facts.toDF("a", "na", "ma"), facts.toDF("b", "nb", "mb")
    if n <= PAIRS_SENT:
        both = b.join(F.broadcast(pairs), "b").join(a.join(F.broadcast(pairs.select("a").distinct()), "a"), "a")
    else:
        both = pairs.join(a, "a").join(b, "b")
    return both.select("a", "b", "na", "nb", "ma", "mb").mapInArrow(run, "a bigint, b bigint")


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs that are not in one component yet."""
    ca, cb = (comp.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in ("a", "b"))
    return pairs.join(ca, "a", "left").join(cb, "b", "left").filter(
        F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _texts_of(named: DataFrame, member: DataFrame, docs: DataFrame, step: Steps) -> DataFrame:
    """The texts of the classes in ``member``; some of further classes may be among them.

    One document of each class is wanted.  Up to ``FILTER_IDS`` of them are marked in a
    bit filter, a table of at most ``FILTER_WORDS`` words that is broadcast, so that no
    text is shuffled; beyond that a join picks them.
    """
    ids = step.land(named.join(member.select("cls").distinct(), "cls", "left_semi").groupBy("cls")
               .agg(F.min(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("id")).select("id").distinct(),
               "set-ids")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    n = ids.count()
    if n <= FILTER_IDS:
        words = 1 << max(4, min(FILTER_WORDS, n // 4 + 1).bit_length())

        def marked(df):
            h = F.xxhash64("id")
            return df.withColumn("w", F.pmod(h, F.lit(words))).withColumn(
                "bit", F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(xxhash64(id), 32), 64) as int))"))
        bits = marked(ids).groupBy("w").agg(F.bit_or("bit").alias("bits"))
        texts = marked(texts).join(F.broadcast(bits), "w").filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    else:
        texts = texts.join(ids, "id", "left_semi")
    return texts.select("text")


def text_hash(text):
    """What tells rows of one doc_id apart; null and empty texts are the same."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
         num: int = 85, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(per document, links).

    Per document, one row each: doc_id, text_hash, n_shingles, cls (null: no
    shingles), component_id, the least doc_id it reaches, and root, the least class it reaches.  Only
    root names a component: ids may be null or shared by unlinked texts.  Links: pairs (a, b) of classes
    above the threshold that were compared; they span every component.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hashed = d.withColumn("text_hash", text_hash(F.col("text")))
    named = land(map_texts(hashed, "text", ["doc_id", "text_hash"], "n_shingles bigint, cls bigint", _sets(width)), "sets")

    entries = (map_texts(d.select("text"), "text", [], "cls bigint, sigs array<bigint>", _entries(width, num, den))
               .filter(F.col("cls").isNotNull()).select("cls", F.explode("sigs").alias("sig")))
    from pyspark.sql import Window

    w = Window.partitionBy("sig")
    # one row per (entry, class): copies in other tasks; both steps use the one shuffle by entry
    member = (entries.repartition("sig").groupBy("sig", "cls").agg(F.lit(1).alias("one"))
              .select("cls", F.count(F.lit(1)).over(w).alias("m"), F.min("cls").over(w).alias("first"),
                      F.sum(F.xxhash64("cls").cast("decimal(38,0)")).over(w).alias("all"))
              .filter(F.col("m") > 1)
              .select(F.xxhash64("m", "first", "all").alias("bucket"), "m", "first", "cls").distinct())
    step = Steps(docs.sparkSession, "neardup")
    member = step.land(member, "buckets")

    def sets_of(classes, column, columns):
        return map_texts(_texts_of(named, classes, d, step), "text", [], f"cls bigint, n bigint, {column}",
                         _one_of_each(width, columns)).filter(F.col("cls").isNotNull())

    sets = step.land(sets_of(member, "bitmap binary", _bitmaps), "bitmaps")

    found, comp = [], docs.sparkSession.createDataFrame([], "node bigint, root bigint")

    def link(pairs):
        """Adds the links among the pairs (a stored table), if there are any, and joins their components."""
        nonlocal comp
        if not (n := pairs.count()):
            return
        pairs = step.land(_possible(pairs, n, sets, num, den).distinct(), "possible-pairs")
        if not (n := pairs.count()):
            return
        links = step.land(_verified(pairs, n, lambda classes: sets_of(classes, "shingles array<bigint>", _shingles),
                                    num, den), "links")
        if links.isEmpty():
            return
        found.append(links)
        # the components so far are stars: what is new joins them in few rounds
        comp = components(comp.toDF("a", "b").unionByName(links), step.land)

    # each class against the least of its buckets' first classes; then the first classes still apart
    first = member.filter(F.col("cls") != F.col("first")).select(F.col("first").alias("a"), F.col("cls").alias("b"))
    one = step.land(first.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    link(one)
    link(step.land(_apart(first.distinct().join(one, ["a", "b"], "left_anti"), comp), "other-pairs"))

    def tree_pairs(spanning):
        rest = member.filter(F.col("m") > 2).join(
            comp.select(F.col("node").alias("cls"), F.col("root").alias("comp")), "cls", "left").withColumn(
            "comp", F.coalesce("comp", "cls"))
        mixed = rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
            F.col("lo") != F.col("hi")).select("bucket")
        tiles = F.ceil(F.col("m") / TILE).cast("int")
        # a row for each class, with all its buckets in order
        rows = (rest.join(mixed, "bucket", "left_semi").groupBy("cls").agg(
                    F.min("comp").alias("comp"), F.array_sort(F.collect_list(F.struct("bucket", "m"))).alias("within"))
                .join(sets.select("cls", "n", "bitmap").distinct(), "cls")
                .select("cls", "n", "comp", "bitmap", F.slice("within.bucket", 1, LEAD).alias("lead"), F.inline("within"))
                .withColumn("tile", F.pmod(F.xxhash64("cls"), tiles).cast("int"))
                .withColumn("o", F.explode(F.sequence(F.lit(0), tiles - 1)))
                .select("bucket", F.least("tile", "o").alias("ti"), F.greatest("tile", "o").alias("tj"), "tile", "cls",
                        "n", "comp", "bitmap", "lead"))
        rows = rows.repartition("bucket", "ti", "tj").sortWithinPartitions("bucket", "ti", "tj")
        return step.land(rows.mapInArrow(_tree_pairs(num, den, spanning), "a bigint, b bigint").distinct(), "tree-pairs")

    # the likeliest pair of each two components first; what is still apart then is compared in full
    link(tree_pairs(True))
    link(tree_pairs(False))
    links = land(reduce(DataFrame.unionByName, found, docs.sparkSession.createDataFrame([], "a bigint, b bigint")),
                 "near-duplicate-links")

    least = named.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("least"))
    rooted = least.join(comp.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = land(rooted.join(of_root, "root").select("cls", "component_id", "root"), "class-components")
    step.drop()  # what is returned reads the sets' names, the class table and the links only
    none = named.filter(F.col("cls").isNull()).withColumn("component_id", F.col("doc_id")).withColumn(
        "root", F.lit(None).cast("bigint"))
    out = named.filter(F.col("cls").isNotNull()).join(by_class, "cls", "left").select(
        *named.columns, "component_id", "root")
    return out.unionByName(none), links
