"""Signature-tree join against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from lodestar.llm import q_neardup, signature_tree
from lodestar.llm.components import components
from tests.conftest import SF_SMALL
from tests.llm.edge import documents, folder


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, width=4, num=85):
    """doc_id -> least doc_id reachable; rows (doc_id, text) with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b:
                both = len(a & b)
                if 100 * both >= num * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(per_doc):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in per_doc.collect()}


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(q_neardup.op4_ngram_jaccard_join(spark, SF_SMALL)) == brute(rows)


def families(seed, n_bases=6, per=14, size=(5, 160)):
    """Families of copies with more and less change, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(n_bases):
        base = [rng.choice(vocab) for _ in range(rng.randint(*size))]
        for _ in range(per):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                p = rng.randrange(len(t))
                if rng.random() < 0.6:
                    t[p] = rng.choice(vocab)
                elif rng.random() < 0.5:
                    t.insert(p, rng.choice(vocab))
                else:
                    del t[p]
                    t = t or ["w"]
            rows.append(" ".join(t))
    rng.shuffle(rows)
    return [(k * 3 + 1, t) for k, t in enumerate(rows)]


def test_families_on_both_sides_of_the_threshold(spark):
    for seed in (1, 2):
        rows = families(seed)
        per_doc, links = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"))
        want = brute(rows)
        assert got(per_doc) == want
        assert links.count() > 0


def test_chain_needs_trees(spark):
    """Each text links with the next only, so the first comparisons of a bucket leave work for the trees."""
    rng = random.Random(5)
    words = [f"u{k}" for k in range(120)]
    rows, t = [], list(words)
    for k in range(30):
        rows.append((k, " ".join(t)))
        t[(k * 17) % 120] = f"new{k}"
        if k % 2:
            t[(k * 29 + 7) % 120] = f"other{rng.random()}"
    per_doc, _ = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(per_doc) == brute(rows)


def test_traversal_finds_all_pairs():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 62, rng.integers(20, 300)).astype(np.uint64)
        for _ in range(12):
            s = base.copy()
            k = rng.integers(0, 1 + len(s) // 8)
            s[rng.choice(len(s), k, replace=False)] = rng.integers(0, 1 << 62, k)
            sets.append(np.unique(s))
    ids = np.arange(len(sets))
    size = np.array([len(s) for s in sets])
    bits = signature_tree._matrix([signature_tree._bitmap(s) for s in sets])
    comp = np.where(ids < 24, 7, ids + 100)
    near = {(a, b) for a in ids for b in ids[:a] for i in [len(np.intersect1d(sets[a], sets[b]))]
            if 185 * i >= 85 * (size[a] + size[b]) and comp[a] != comp[b]}
    near = {(b, a) for a, b in near}
    tree = signature_tree.Tree(ids, size, bits, comp)
    found = {tuple(sorted((int(tree.ids[a]), int(tree.ids[b])))) for i, j in signature_tree.traverse(
        tree, tree, 85, 100) for a, b in zip(i, j)}
    assert near <= found and len(found) < len(ids) * (len(ids) - 1) / 4
    half = ids % 2 == 0
    p, q = (signature_tree.Tree(ids[h], size[h], bits[h], comp[h]) for h in (half, ~half))
    found = {tuple(sorted((int(p.ids[a]), int(q.ids[b])))) for i, j in signature_tree.traverse(p, q, 85, 100)
             for a, b in zip(i, j)}
    assert {x for x in near if (x[0] + x[1]) % 2} <= found


def test_tiles_give_the_same(spark, monkeypatch):
    rows = families(9, n_bases=2, per=30, size=(60, 90))
    monkeypatch.setattr(signature_tree, "TILE", 5)
    monkeypatch.setattr(signature_tree, "FILTER_IDS", -1)   # and the joins that take over beyond the bounds
    monkeypatch.setattr(signature_tree, "PAIRS_SENT", -1)
    per_doc, _ = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(per_doc) == brute(rows)


def test_other_widths_and_thresholds(spark):
    rows = families(11, n_bases=5, per=12)
    per_doc, _ = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"), width=5, num=80)
    assert got(per_doc) == brute(rows, 5, 80)


def tile(sets, comp, tiles=1):
    """Rows of one bucket as a task of the tree join sees them, for each pair of tiles."""
    ids = np.arange(len(sets)) + 1000
    at = ids % tiles
    for ti in range(tiles):
        for tj in range(ti, tiles):
            use = [k for k in range(len(sets)) if at[k] in (ti, tj)]
            yield pa.RecordBatch.from_pydict({
                "bucket": [1] * len(use), "ti": [ti] * len(use), "tj": [tj] * len(use), "tile": at[use].tolist(),
                "cls": ids[use].tolist(), "comp": [comp[k] for k in use], "n": [len(sets[k]) for k in use],
                "shingles": pa.array([sets[k].view(np.int64) for k in use], pa.list_(pa.int64())),
                "bitmap": [signature_tree._bitmap(sets[k]) for k in use]})


def test_a_spanning_pass_gives_fewer_pairs_than_members_and_most_links():
    """Edits that overlap each other in pairs: the first pass stays below the members, the second one has all links."""
    rng = np.random.default_rng(8)
    for n, tiles in ((60, 1), (240, 1), (240, 3)):
        base = rng.integers(0, 1 << 62, 200).astype(np.uint64)
        sets = []
        for _ in range(n):
            s = base.copy()
            s[rng.choice(200, rng.integers(0, 22), replace=False)] = rng.integers(0, 1 << 62)
            sets.append(np.unique(s))
        comp = [7, 7] + list(range(100, 98 + n))
        near = {(b, a) for a in range(n) for b in range(a) if comp[a] != comp[b] and 185 * len(
            np.intersect1d(sets[a], sets[b])) >= 85 * (len(sets[a]) + len(sets[b]))}
        few, every = set(), set()
        for batch in tile(sets, comp, tiles):
            for spanning, out in ((True, few), (False, every)):
                got = [(int(a) - 1000, int(b) - 1000) for r in signature_tree._tree_pairs(85, 100, spanning)([batch])
                       for a, b in zip(r["a"].to_numpy(), r["b"].to_numpy())]
                assert not spanning or len(got) < batch.num_rows
                out.update(got)
        assert near <= every and few <= every

        def classes(links):
            root = list(range(n))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a, b in [(0, 1), *links]:
                root[find(a)] = find(b)
            return [find(x) for x in range(n)]
        a, b = classes(near & few), classes(near)
        assert len(set(a)) - len(set(b)) <= n // 20


def test_unrelated_sets_share_no_bucket_and_linked_ones_do():
    """Empty groups are as many as the sizes make likely; a pair at the bound still agrees on a group with something in it."""
    rng = np.random.default_rng(3)
    for num, den in ((80, 100), (85, 100)):
        levels = signature_tree.Levels(num, den)
        apart = [levels.entries(np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)))
                 for n in rng.integers(100, 3000, 120)]
        every = np.concatenate(apart)
        assert len(every) - len(np.unique(every)) <= len(every) // 1000
        for n in [*range(5, 60), 300, 900, 2500]:
            both = rng.integers(0, 1 << 62, n).astype(np.uint64)
            extra = n * (den - num) // num   # the most tokens that the larger set may add
            larger = np.concatenate([both, rng.integers(0, 1 << 62, extra).astype(np.uint64)])
            a, b = (set(levels.entries(np.unique(x)).tolist()) for x in (both, larger))
            assert a & b or not extra
            half = extra // 2
            a, b = (set(levels.entries(np.unique(x)).tolist()) for x in (larger[:n + half], np.delete(
                larger, np.arange(n, n + half))))
            assert a & b or not extra


def test_no_full_set_is_stored(spark, monkeypatch):
    """Sets take more bytes than the texts: what the steps store has none of them."""
    stored, old = [], signature_tree.Steps.land

    def land(self, df, name):
        stored.append((name, df.schema.simpleString()))
        return old(self, df, name)
    monkeypatch.setattr(signature_tree.Steps, "land", land)
    rows = families(21, n_bases=3, per=10)
    per_doc, _ = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(per_doc) == brute(rows)
    assert {"buckets", "links"} <= {n for n, _ in stored} and not [x for x in stored if "array" in x[1]]


def test_sets_of_a_slice_are_those_of_its_texts(monkeypatch):
    """Words of any length and white space of any kind, all texts together; only long words are hashed one by one."""
    calls, one = [], signature_tree.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(signature_tree.xxhash, "xxh3_64_intdigest", lambda b: calls.append(bytes(b)) or one(b))
    rng = random.Random(8)
    words = [rng.choice("abXY") * k + e for k in [*range(1, 40), 63, 64] for e in ("", "z", "\0", "É", "\x1c", "\u2003")]
    long = ["q" * 64 + "R", "q" * 64 + "s", "y" * 5000]
    texts = ["", None, " ", "\n\t\x0b\x0c\r", "one", " Two  words\n", "two words", "a b c", "a b c d", "ab c d"] + [
        "".join(w + rng.choice([" ", "\n", "\r\n", "\t ", "\x0b", "\x0c"]) for w in rng.choices(words, k=rng.randint(0, 60)))
        for _ in range(150)] + [" ".join(long), "x " * 300]
    words_of = [len((t or "").encode().lower().split()) for t in texts]
    for width in (1, 4, 5):
        del calls[:]
        sets = signature_tree.Shingler(width)(texts)
        assert len(calls) <= sum(len(w) > 64 for t in texts for w in (t or "").encode().split()) < sum(words_of) // 10
        want = [shingles(t, width) for t in texts]
        assert [len(s) for s in sets] == [len(x) for x in want]
        assert all((s[1:] > s[:-1]).all() for s in sets)
        for a in range(len(texts)):
            for b in range(a):
                assert len(np.intersect1d(sets[a], sets[b])) == len(want[a] & want[b])
        for t, s in zip(texts, sets):
            assert np.array_equal(signature_tree.Shingler(width)([t])[0], s)
    assert signature_tree.Shingler(4)([]) == []


def test_awkward_rows(spark, tmp_path):
    d = folder(spark, tmp_path)
    rows = q_neardup.op4_ngram_jaccard_join(spark, d).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert len(by[5]) == 2 and by[5][0][1] == 0 and by[0][0][1] == 0
    assert by[9] == [(1, 8)] and by[8] == [(1, 8)]
    assert by[None][0][1] is None and by[4][0][0] == 6
    assert len(rows) == 16
    empty = documents(spark, [])
    assert signature_tree.join(empty)[0].count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(300, 200), (200, 300)]
    edges += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nb = defaultdict(set)
    for a, b in edges:
        if a != b:
            nb[a].add(b)
            nb[b].add(a)
    for n in nb:
        seen, todo = {n}, [n]
        while todo:
            for m in nb[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[n] == min(seen)
    assert set(got) == set(nb)


def test_pairs_that_share_many_buckets_are_handed_on_about_once():
    """Long texts that are alike share hundreds of buckets; each of their pairs is one row, not one for each bucket."""
    rng = np.random.default_rng(12)
    levels, num, den, sets = signature_tree.Levels(80, 100), 80, 100, []
    for size in (1500, 1500, 300):
        base = rng.integers(0, 1 << 62, size).astype(np.uint64)
        for _ in range(8):
            s = base.copy()
            s[rng.choice(size, size // 18, replace=False)] = rng.integers(0, 1 << 62, size // 18)
            sets.append(np.unique(s))
    members = defaultdict(list)
    for k, s in enumerate(sets):
        for e in np.unique(levels.entries(s)).tolist():
            members[e].append(k)
    members = {e: ks for e, ks in members.items() if len(ks) > 2}
    within = {k: sorted(e for e, ks in members.items() if k in ks) for k in range(len(sets))}
    assert min(map(len, within.values())) > 3 * signature_tree.LEAD
    batches = [pa.RecordBatch.from_pydict({
        "bucket": [e] * len(ks), "ti": [0] * len(ks), "tj": [0] * len(ks), "tile": [0] * len(ks), "cls": ks, "comp": ks,
        "n": [len(sets[k]) for k in ks], "bitmap": [signature_tree._bitmap(sets[k]) for k in ks],
        "lead": pa.array([within[k][:signature_tree.LEAD] for k in ks], pa.list_(pa.int64()))}) for e, ks in sorted(members.items())]
    near = {(a, b) for b in range(len(sets)) for a in range(b)
            if (num + den) * len(np.intersect1d(sets[a], sets[b])) >= num * (len(sets[a]) + len(sets[b]))}
    for spanning in (True, False):
        got = [(a, b) for r in signature_tree._tree_pairs(num, den, spanning)(batches)
               for a, b in zip(r["a"].to_pylist(), r["b"].to_pylist())]
        assert len(got) <= 2 * len(set(got)) and len(got) < len(members) // 4
        assert spanning or near <= set(got)


def test_few_leading_buckets_lose_no_link(spark, monkeypatch):
    """Pairs that carry no leading bucket in common are handed on by every bucket."""
    rows = families(31, n_bases=3, per=25, size=(60, 200))
    for lead in (1, 2):
        monkeypatch.setattr(signature_tree, "LEAD", lead)
        per_doc, _ = signature_tree.join(spark.createDataFrame(rows, "doc_id long, text string"))
        assert got(per_doc) == brute(rows)


def test_stars_need_no_rounds(spark):
    """Links that are stars already are told by one look, and so are those of a round that made all of them stars."""
    for edges, rounds in (([(5, 1), (6, 1), (9, 2)], 0), ([(5, 1), (5, 2)], 1), ([], 0)):
        stored = []

        def land(df, name):
            stored.append(name)
            return df.localCheckpoint()
        comp = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), land).collect()}
        assert comp == {n: 1 if (5, 2) in edges or n != 2 and n != 9 else 2 for e in edges for n in e}
        assert stored.count("large-star") == rounds
