"""Operators 3, 6 and 9: held-out quality, exact base columns and awkward rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from lodestar.llm import byte_cnn, logbilinear, outliers, q_language, q_quality, q_scoring
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.edge import ROWS, documents, folder

LETTER = re.compile(r"[^\W\d_]")


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def test_language_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = q_language.op3_language_id(spark, SF_MID).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_awkward_rows(spark, tmp_path):
    rows = q_language.op3_language_id(spark, folder(spark, tmp_path / "a")).collect()
    want = Counter((r[0], not (r[1] and LETTER.search(r[1]))) for r in ROWS)
    assert Counter((r["doc_id"], r["lang_pred"] == "und") for r in rows) == want
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    unlabelled = [(i, t, None, s) for i, t, _, s in ROWS]
    rows = q_language.op3_language_id(spark, folder(spark, tmp_path / "b", unlabelled)).collect()
    assert {r["lang_pred"] for r in rows} == {"und"} and len(rows) == len(ROWS)
    assert q_language.op3_language_id(spark, folder(spark, tmp_path / "c", [])).count() == 0


def test_prediction_is_the_weighted_mean_of_windows():
    net = byte_cnn.Net(["a", "b", "c"])
    text = "Some words, sömé more. " * 40
    raw = text.encode()
    parts = [raw[i:i + byte_cnn.WINDOW] for i in range(0, len(raw), byte_cnn.WINDOW)]
    p = net.probabilities(np.stack([np.frombuffer(b.ljust(byte_cnn.WINDOW, b"\0"), np.uint8) for b in parts]))
    want = (p * np.array([[len(b)] for b in parts])).sum(0) / len(raw)
    lang, score = net.predict(["x", text, None, "123"])
    assert lang[1] == "abc"[want.argmax()] and abs(score[1] - want.max()) < 1e-6
    assert lang[2:] == ["und", "und"]


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 103, (60, byte_cnn.WINDOW)).astype(np.uint8)
    x[::2, 5:9] = np.frombuffer(b"zzzz", np.uint8)
    y = (np.arange(60) % 2).astype(int)
    net = byte_cnn.Net(["a", "b"])
    net.train(x, y)
    assert (net.probabilities(x).argmax(1) == y).all()


def base_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def failed(s):
    return s[0] < 50 or 100 * s[4] > 50 * s[0]


def test_quality_base_columns(spark, tmp_path):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for d, rows in ((SF_SMALL, texts), (folder(spark, tmp_path), [r[:2] for r in ROWS])):
        got = q_quality.op6_quality_outliers(spark, d).collect()
        want = Counter((i, *base_stats(t), failed(base_stats(t))) for i, t in rows)
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                        r["n_repeat_words"], r["base_failed"]) for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert q_quality.op6_quality_outliers(spark, folder(spark, tmp_path / "e", [])).count() == 0


def test_repeat_words_equals_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        t = " ".join(rng.choice("abc") * rng.choice([1, 1, 2]) for _ in range(rng.randint(0, 25)))
        assert outliers.repeat_words(t.encode().split()) == base_stats(t)[4]


def test_outliers_are_rejected_and_ordinary_rows_kept(spark):
    rng = random.Random(1)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def plain(n):
        return " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(k, plain(rng.randint(60, 900)), "en" if k % 3 else None, "hot" if k % 2 else "cold") for k in range(600)]
    junk = [(1000 + k, " ".join(w + "###" for w in plain(80).split()), "en", "hot") for k in range(60)]
    stats = outliers.text_stats(documents(spark, rows + junk), ["doc_id", "lang", "source"])
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(stats).collect()}
    assert all(got[i] for i, *_ in rows) and not any(got[i] for i, *_ in junk)


def test_moderate_junk_is_rejected_beside_clean_rows(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def plain(n):
        return [rng.choice(vocab) for _ in range(n)]

    def lined(words):
        return "\n".join(" ".join(words[i:i + 10]) for i in range(0, len(words), 10))

    def symbols(n):  # 15% of the word characters
        t = plain(n)
        for _ in range(round(sum(map(len, t)) * 0.15 / 0.85)):
            k = rng.randrange(n)
            t[k] += "#"
        return lined(t)

    def lines(n):  # half of the lines repeat an earlier one; windows are kept under half by long other lines
        a = [" ".join(plain(3)) for _ in range(n // 10)]
        return "\n".join(x for y in a for x in (y, y)) + " " + " ".join(plain(n))

    def windows(n):  # 45% of the words in windows that occur twice, no line twice
        k = round(n * 0.225)
        part, rest = plain(k), plain(n - 2 * k)
        return " ".join(part + rest[:len(rest) // 2] + part + rest[len(rest) // 2:])
    rows = [(k, lined(plain(rng.randint(60, 900))), "en", "a") for k in range(600)]
    junk = [(1000 + k, (symbols, lines, windows)[k % 3](rng.randint(100, 300)), "en", "a") for k in range(45)]
    stats = outliers.text_stats(documents(spark, rows + junk), ["doc_id", "lang", "source"])
    got = {r["doc_id"]: r for r in outliers.judge(stats).collect()}
    assert not any(got[i]["base_failed"] for i, *_ in junk)
    assert sum(got[i]["kept"] for i, *_ in rows) >= 0.99 * len(rows)
    assert [i for i, *_ in junk if got[i]["kept"]] == []


def test_estimate_and_distance_equal_numpy(spark):
    assert abs(outliers.chi2_cutoff(0.5) - 3.3567) < 1e-3 and abs(outliers.chi2_cutoff(0.05) - 9.4877) < 1e-3
    x = np.random.default_rng(0).normal(size=(200, 4)) @ np.array(
        [[1, 0, 0, 0], [0.5, 1, 0, 0], [0.2, -0.3, 1, 0], [0, 0.1, 0.4, 0.5]]).T
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, x0 double, x1 double, x2 double, x3 double")
    sums = rows.groupBy("grp").agg(outliers.F.count("x0").alias("n"), *[
        outliers.F.sum(f"x{i}").alias(f"s{i}") for i in range(4)], *[
        outliers.F.sum(outliers.F.col(f"x{i}") * outliers.F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in outliers._PAIRS])
    got = sorted(r["d2"] for r in outliers._distance(rows, outliers._estimates(sums)).collect())
    d = x - x.mean(0)
    inv = np.linalg.inv(d.T @ d / len(x) + np.diag(np.square(outliers.FLOORS)))
    assert np.allclose(got, sorted(np.einsum("ij,jk,ik->i", d, inv, d)))


def brute_scores(rows):
    tok = [((r[0]), (r[1] or "").encode().lower().split() + [None]) for r in rows]
    c = Counter(w for i, ws in tok if crc(i) % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, crc(i) % 5 == 1, len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in tok]


def same(got, want):
    key = lambda r: (str(r[0]), r[2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert g[6] <= 0 and math.isfinite(g[6])


def test_scores_base_columns_and_held_out_gain(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    monkeypatch.setattr(logbilinear, "HOT", 3000)  # rare words by join, frequent ones in place
    got = [tuple(r) for r in q_scoring.op9_lm_score(spark, SF_MID).collect()]
    same(got, brute_scores(rows))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_scores_awkward_rows(spark, tmp_path):
    got = [tuple(r) for r in q_scoring.op9_lm_score(spark, folder(spark, tmp_path / "a")).collect()]
    same(got, brute_scores(ROWS))
    assert q_scoring.op9_lm_score(spark, folder(spark, tmp_path / "b", [])).count() == 0
    held = [(i, "a b", None, None) for i in range(200) if crc(i) % 5 == 1]
    got = [tuple(r) for r in q_scoring.op9_lm_score(spark, folder(spark, tmp_path / "c", held)).collect()]
    assert len(got) == len(held) and all(r[4] == 0 and r[5] == 0 for r in got)


def test_class_probabilities_sum_to_one_and_learn():
    net = logbilinear.LogBilinear(12, 6)
    keys = np.array([(1 * 12 + 2) * 12 + 3, (4 * 12 + 5) * 12 + 6, (2 * 12 + 5) * 12 + 7])
    net.train(keys, np.array([500.0, 400.0, 300.0]))
    table = net.log10_table()
    assert np.allclose((10 ** table).sum(1), 1)
    assert table[1 * 12 + 2].argmax() == 3 and table[4 * 12 + 5].argmax() == 6


def test_class_model_learns_from_every_count_without_draws(monkeypatch):
    net = logbilinear.LogBilinear(12, 6)
    monkeypatch.setattr(np.random, "default_rng", None)
    at = [(a * 12 + b) * 12 + (b + 1) % 12 for a in range(12) for b in range(12)]
    net.train(np.array(at), np.array([1000.0 if k % 7 else 10.0 for k in range(144)]))
    table = net.log10_table()
    assert np.allclose((10 ** table).sum(1), 1)
    assert all(table[k // 12].argmax() == k % 12 for k in at)


def numpy_judge(stats, tail=outliers.TAIL):
    """The whole rule over rows (lang, source, words, chars, symbols, dup lines, repeat words, lines): kept per row."""
    lang, source = [r[0] for r in stats], [r[1] for r in stats]
    n, chars, sym, dup, rep, lines = np.array([r[2:] for r in stats], float).T
    failed_ = (n < 50) | (100 * rep > 50 * n)
    one = np.maximum

    def angle(a, b):
        return np.arcsin(np.sqrt(np.minimum(1, a / one(b, 1))))
    x = np.stack([np.log(chars / one(n, 1) + 1e-9), angle(sym, chars), angle(dup, lines), angle(rep, n)], 1)
    v = np.stack([outliers.LENGTH_CV ** 2 / one(n, 1), .25 / one(n, 1), .25 / one(lines, 1), 1.5 / one(n, 1)], 1)
    per = outliers.BINS_PER_OCTAVE
    for k, size, count in ((2, lines, dup), (3, n, rep)):
        for t in set(lang):
            at = np.array([a == t for a in lang])
            use = at & ~failed_ & (size > 0)
            if not use.any():
                continue
            with np.errstate(divide="ignore"):
                bins = np.where(count > 0, np.floor(np.log2(count / one(size, 1) ** 2) * per), outliers._NEVER)[use]
            order = np.argsort(bins, kind="stable")
            w = np.cumsum((size[use] ** 2)[order])
            mid, high = (bins[order][np.searchsorted(w, q * w[-1])] for q in (.5, .84))
            rate = 2 ** ((mid + .5) / per) if mid > outliers._NEVER else 0
            mu = np.arcsin(np.sqrt(np.minimum(.5, rate * size)))
            v[at, k] += (.5 * mu * (high - mid) * math.log(2) / per)[at] ** 2
            x[at, k] -= mu[at]
    x = np.round(x, 4)
    own = list(zip(lang, source))
    size = Counter(o for o, f in zip(own, failed_) if not f)
    grp = [o if size[o] >= outliers.MIN_ROWS else None for o in own]
    kept, cut, d = ~failed_, outliers.chi2_cutoff(tail), outliers.D

    def dist(x, v, m, cov):
        return np.array([(a - m) @ np.linalg.solve(cov + np.diag(b), a - m) for a, b in zip(x, v)])

    def bin_of(d2):
        return np.floor(np.log2(d2 + 2.0 ** -16) * per)
    floor = np.diag(np.square(outliers.FLOORS))
    for g in set(grp):
        at = np.array([a == g for a in grp])
        good = at & ~failed_
        if good.sum() < outliers.MIN_ROWS:
            continue
        xs, vs = x[good], v[good]
        m = np.median(np.round(xs, 2), 0)
        cov = np.diag((1.4826 * np.median(np.round(np.abs(xs - m), 2), 0)) ** 2) + floor
        for _ in range(outliers.STEPS):
            b = bin_of(dist(xs, vs, m, cov))
            below = np.array([(b < k).sum() for k in b])
            use = xs[below < np.ceil(outliers.ALPHA * len(xs))]
            m = use.mean(0)
            cov = (use.T @ use) / len(use) - np.outer(m, m) + floor
        b = np.sort(bin_of(dist(xs, vs, m, cov)))
        half = min(k for k in b if (b <= k).sum() >= .5 * len(b))
        scale = max(1, 2 ** ((half + 1) / per) / outliers.chi2_cutoff(.5))
        kept[at] &= np.sqrt(dist(x[at], v[at], m, cov) / scale) <= math.sqrt(cut)
    return kept


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def test_outlier_rule_equals_numpy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = outliers.judge(outliers.text_stats(docs, ["doc_id", "lang", "source"])).orderBy("doc_id").collect()
    want = numpy_judge([(r["lang"], r["source"], *[r[c] for c in STATS]) for r in rows])
    assert 20 < (~want).sum() and [r["kept"] for r in rows] == want.tolist()


def test_long_clean_texts_are_kept(spark):
    """Texts of up to 20,000 words repeat themselves by chance; only junk of any length goes."""
    rng = np.random.default_rng(4)
    vocab = np.array(["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)])
    p = 1 / np.arange(4, len(vocab) + 4)
    p /= p.sum()

    def plain(n):
        w = rng.choice(vocab, n, p=p)
        ends = np.cumsum(rng.integers(4, 80, n // 4 + 1))
        return "\n".join(" ".join(x) for x in np.split(w, ends[ends < n]))
    short = [(k, plain(int(rng.integers(60, 900))), "en", "a") for k in range(500)]
    long = [(1000 + k, plain(n), "en", "a") for k, n in enumerate([3000, 3500, 4000, 5000, 6000, 8000, 10_000, 12_000, 16_000, 20_000])]

    def windows(n):
        part, rest = plain(int(n * 0.2)), plain(int(n * 0.6))
        return f"{part} {rest} {part}"
    junk = [(2000 + k, windows(n), "en", "a") for k, n in enumerate([200, 400, 1000, 3000, 8000])]
    junk += [(3000 + k, plain(n).replace(" ", "### "), "en", "a") for k, n in enumerate([100, 1000, 6000])]
    stats = outliers.text_stats(documents(spark, short + long + junk), ["doc_id", "lang", "source"])
    got = {r["doc_id"]: r for r in outliers.judge(stats).collect()}
    assert max(got[i]["n_repeat_words"] for i, *_ in long) > 500
    assert [i for i, *_ in long if not got[i]["kept"]] == []
    assert sum(got[i]["kept"] for i, *_ in short) >= 0.98 * len(short)
    assert [i for i, *_ in junk if got[i]["kept"]] == []
