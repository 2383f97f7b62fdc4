"""Operators 12 and 13 against brute force, awkward rows included."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestar.llm import conversation_trie, divergence, q_conversations, q_divergence
from lodestar.llm.registry import load_all
from tests.conftest import SF_MID
from tests.llm.edge import ROWS, documents

WORD, TERM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def oracle(name, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(load_all()[1][name]).fetchall()


# ---- conversations


def brute_trie(seqs):
    """seqs: [(conv_id, ((role, text), ...))] -> Counter of result rows."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seqs:
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        own = (len(members[s]) - 1) * len(re.findall(WORD, s[-1][1])) if s else 0
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = own + sum(saved[k] for k in kids[s])
    return Counter((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), leaves[s], saved[s],
                    hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())
                   for s, m in members.items())


def rebuilt(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            by[c].append((turn is not None, turn or 0, told, (role, text)))
    turns = {c: [x[3] for x in sorted(t)] for c, t in by.items()}
    out = []
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out.append((c, tuple(turns.get(c - c % 20, [])[:h] + own[h:])))
    return out


AWKWARD = ([(1, None, None, None), (1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 1, None, "c"), (None, 0, "user", "x"),
            (2, 5, "user", ""), (2, 7, "assistant", None), (0, 0, "user", "hi  there\x85you"), (0, 1, "assistant", "é 日本"),
            (0, 2, "user", "w " * 5000), (21, None, "user", "only")]
           + [(40 + k, t, "user", f"t{t}") for k in range(12) for t in range(k)]
           + [(60, t, "user", f"t{t}") for t in range(40)])
CONV = "conv_id long, turn long, role string, text string, depth string, key int, path string, ends string, head int"


def conversations(spark, tmp_path, rows):
    d = str(tmp_path)
    spark.createDataFrame([(*r, "x", 1, "x", "x", 2) for r in rows], CONV).coalesce(1).write.parquet(
        f"{d}/conversations.parquet")
    return d


def rows_of(df):
    return Counter(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                        "saved_tokens", "ends_sha256")) for r in df.collect())


def test_trie_awkward_rows(spark, tmp_path):
    d = conversations(spark, tmp_path / "a", AWKWARD)
    got = rows_of(q_conversations.op12_conversation_trie(spark, d))
    assert got == brute_trie(rebuilt(AWKWARD)) and max(got.values()) == 1
    assert q_conversations.op12_conversation_trie(spark, conversations(spark, tmp_path / "b", [])).count() == 0


@pytest.mark.parametrize("group", [0, 30, 1 << 17])
def test_trie_does_not_depend_on_the_rounds(spark, group):
    """Group bound 0 peels every depth by aggregation, 30 mixes both ways; deep chains, copies and a common opening."""
    rng = random.Random(3)
    seqs = []
    for c in range(160):
        s = ["open"] * (c % 3 > 0) * 2 + [rng.choice("ab") for _ in range(rng.randint(0, 4))]
        seqs.append((c, tuple(("r", t) for t in (s if c % 7 else ["open", "open", "a"]))))
    seqs += [(200 + k, tuple(("r", f"deep {t}") for t in range(k))) for k in (3, 9, 10)] + [(300, ())]
    rows = spark.createDataFrame([(c, i, r, t) for c, s in seqs for i, (r, t) in enumerate(s)],
                                 "conv_id long, turn long, role string, text string")
    table = conversation_trie.conversations_of(conversation_trie.turns(rows))
    empty = spark.createDataFrame([(c,) for c, s in seqs if not s], "conv_id long").withColumn(
        "turns", F.lit(None).cast(conversation_trie._TURNS))
    nodes = conversation_trie.trie(table.unionByName(empty), group=group)
    assert rows_of(nodes) == brute_trie(seqs)


def test_trie_children_of_crowded_nodes(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CROWDED", 3)
    seqs = [(c, (("r", "all"), ("r", f"{c % 9}"), ("r", f"{c % 2}"))) for c in range(40)]
    rows = spark.createDataFrame([(c, i, r, t) for c, s in seqs for i, (r, t) in enumerate(s)],
                                 "conv_id long, turn long, role string, text string")
    nodes = conversation_trie.trie(conversation_trie.conversations_of(conversation_trie.turns(rows)))
    assert rows_of(nodes) == brute_trie(seqs)


def test_trie_equals_sql(spark):
    got = rows_of(q_conversations.op12_conversation_trie(spark, SF_MID))
    assert got == Counter(oracle("op12_conversation_trie", SF_MID))


# ---- sources


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_audit(docs, min_docs=10, top=10):
    docs = [(lang or "", source or "", re.findall(TERM, lower(t or ""))) for t, lang, source in docs]
    df, n, all_n = Counter(), Counter(), Counter()
    for lang, source, words in docs:
        df.update({(lang, w) for w in words})
        n.update((lang, source, w) for w in words)
        all_n.update((lang, w) for w in words)
    kept = defaultdict(list)
    for (lang, w), k in df.items():
        if k >= min_docs:
            kept[lang].append(w)
    groups = sorted({d[:2] for d in docs})

    def p(count, total, v):
        return 1 + 1_000_000_000 * (count + 2) // (total + 2 * v)

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    share = {}
    for lang, source in groups:
        ws = kept[lang]
        total = sum(n[lang, source, w] for w in ws)
        share[lang, source] = {w: p(n[lang, source, w], total, len(ws)) for w in ws}
    out = []
    for lang, source in groups:
        ws = kept[lang]
        total = sum(all_n[lang, w] for w in ws)
        pairs = [(o, sum(f(share[lang, source][w], share[lang, o][w]) for w in ws)) for la, o in groups
                 if la == lang and o != source]
        terms = [(w, f(a, q)) for w in ws for a, q in [(share[lang, source][w], p(all_n[lang, w], total, len(ws)))]
                 if n[lang, source, w] and a > q]
        for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
            rows.sort(key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(rows[:most])]
    return Counter(out)


def audited(df):
    assert df.dtypes[-2:] == [("value", "bigint"), ("rank", "int")]
    return Counter(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def test_divergence_awkward_rows(spark):
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma-delta", "ÉTÉ", "été", "日本", "x1y2", "aa", "AA", "zz"]
    rows = [(None, " ".join(rng.choices(words[:3 + k % 7], k=rng.randint(0, 30))), rng.choice(["en", "de", None]),
             rng.choice(["a", "b", "c", None])) for k in range(150)]
    rows += [(1, "one copy of many é", "en", "hot")] * 80 + [(2, "one copy of many é", "en", "b")] * 3
    rows += [*ROWS, (3, None, "xx", "s"), (4, "rare", "xx", "t"), (5, "", "xx", None)]
    docs = documents(spark, rows)
    assert audited(divergence.audit(docs.repartition(5))) == brute_audit([r[1:] for r in rows])
    assert audited(divergence.audit(docs, min_docs=2, top=3)) == brute_audit([r[1:] for r in rows], 2, 3)
    assert divergence.audit(documents(spark, [])).count() == 0


def test_divergence_in_small_pieces(spark, monkeypatch):
    """Counts handed on early and pairs looked at few at a time give the same sums."""
    def tiny(rows):
        def f(batches):
            import lodestar.llm.divergence as d
            d.FLUSH, d.PAIRS_AT_ONCE = 20, 7
            yield from rows(batches)
        return f
    import lodestar.llm.divergence as d
    rng = random.Random(6)
    rows = [(k, " ".join(f"w{chr(97 + rng.randint(0, 25))}" for _ in range(40)), "en", f"s{rng.randint(0, 6)}")
            for k in range(60)]
    texts = divergence.collapse(documents(spark, rows)).collect()
    counts = d._Counts()
    for t in texts:
        counts.add(t["lang"], divergence.terms_of(t["text"]), [c.asDict() for c in t["copies"]])
    got = Counter()
    for b in counts.batches():
        for r in b.to_pylist():
            got[r["source"], r["term"]] += r["n"]
    assert got == Counter((s, w) for _, t, _, s in rows for w in t.split())
    monkeypatch.setattr(d, "FLUSH", 20)
    monkeypatch.setattr(d, "PAIRS_AT_ONCE", 7)
    real = type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, s: real(self, tiny(f), s))
    assert audited(d.audit(documents(spark, rows))) == brute_audit([r[1:] for r in rows])


def test_copies_are_cut_into_terms_once(spark):
    rows = [(k, "the same text", "en", f"s{k % 3}") for k in range(30)] + [(99, "another", "en", "s0")]
    got = {r["text"]: {c["source"]: c["n"] for c in r["copies"]} for r in divergence.collapse(documents(spark, rows)).collect()}
    assert got == {"the same text": {"s0": 10, "s1": 10, "s2": 10}, "another": {"s0": 1}}


def test_divergence_equals_sql(spark):
    got = audited(q_divergence.op13_source_divergence(spark, SF_MID))
    assert got == Counter(oracle("op13_source_divergence", SF_MID))
