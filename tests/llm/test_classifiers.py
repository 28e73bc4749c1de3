"""Classifiers: held-out accuracy, the gradient of the network, and tables
with nulls, empty texts, no labels and clashing columns."""

import random
import zlib

import numpy as np
import pytest

from tessera.llm import language_id as G
from tessera.llm import toxicity as X
from tessera.llm.common import held_out, labelled_sample
from tessera.llm.language_id import predict_language, train_language_id
from tessera.llm.quality import score_quality, train_quality
from tessera.llm.toxicity import score_toxicity, train_toxicity

RNG = random.Random(11)
SYLLABLES = {"aa": ["ka", "lo", "mi", "ra", "tu"], "bb": ["sch", "ung", "ver", "ein"], "cc": ["eaux", "tion", "ré", "que"]}


def prose(lang, n):
    return " ".join("".join(RNG.choice(SYLLABLES[lang]) for _ in range(RNG.randrange(1, 4))) for _ in range(n))


EDGE = [(None, "text of no id"), (9001, None), (9002, ""), (9003, "12 34 !!"), (9004, prose("aa", 30_000))]


def test_held_out(table):
    rows = [(i, "x") for i in range(50)] + [(None, "x")]
    for r in table(rows).select("doc_id", held_out("doc_id").alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_gradient():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in G._init(3, rng).items()}
    codes, target = rng.integers(0, 256, (6, 5)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    known = np.ones((6, 5))
    known[4:, 0] = 0
    _, g = G.gradients(w, codes, target, known)
    for name in w:
        flat = np.flatnonzero(np.abs(g[name]).reshape(-1) > 1e-3)[:4]
        for at in flat:
            old, eps = w[name].reshape(-1)[at], 1e-2
            loss = []
            for e in (eps, -eps):
                w[name].reshape(-1)[at] = old + e
                loss.append(G.gradients(w, codes, target, known)[0])
            w[name].reshape(-1)[at] = old
            assert abs((loss[0] - loss[1]) / (2 * eps) - g[name].reshape(-1)[at]) < 2e-3


def test_language(table):
    rows = [(i, prose(lang, RNG.randrange(3, 200)), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(i, t, None, "s") for i, t in EDGE]
    docs = table(rows)
    out = predict_language(docs, train_language_id(docs))
    assert set(docs.columns) <= set(out.columns)
    right = [r["lang_pred"] == r["lang"] for r in out.where(held_out("doc_id")).collect() if r["lang"]]
    assert len(right) > 20 and np.mean(right) >= 0.95
    at = {r["doc_id"]: r for r in out.collect()}
    assert [at[i]["lang_pred"] for i in (9001, 9002, 9003, 9004)] == ["und", "und", "und", "aa"]
    assert all(0 <= r["score"] <= 1 for r in at.values())
    assert sum(at[9004]["positions"].values()) == len(rows[-1][1].encode())
    none = predict_language(docs.limit(3), train_language_id(docs.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert predict_language(docs.limit(0), None).collect() == []


def test_windows_read_alike_in_any_company():
    rows = [(prose(lang, 40), lang) for lang in ("aa", "bb", "cc") for _ in range(10)]
    read = G.reader(G.fit(rows, steps=20))
    texts = [t for t, _ in rows] + ["", "a"]
    p, votes = read(texts)
    for t, q, v in zip(texts, p, votes):
        assert np.allclose(read([t])[0][0], q, atol=1e-5) and v.sum() == len(t.encode())


def test_quality(table, labels):
    rows, marks = [], []
    for i in range(160):
        good = i % 3 > 0
        t = prose("aa", RNG.randrange(20, 200))
        rows.append((i, t if good else " ".join(w + RNG.choice(["%%%", "&&&", "###"]) for w in t.split()), "en", "s"))
        marks.append((i, int(good), 0))
    docs = table(rows + [(i, t, "en", "s") for i, t in EDGE])
    marks += [(None, 1, 0), (3, None, None), (9999, 1, 0)]
    out = score_quality(docs, train_quality(docs, labels(marks)))
    truth = {i: q for i, q, _ in marks}
    right = [(r["score"] >= 0.7) == bool(truth[r["doc_id"]]) for r in out.where(held_out("doc_id")).collect() if r["doc_id"] in truth]
    assert len(right) > 20 and np.mean(right) >= 0.95
    assert out.count() == len(rows) + len(EDGE) and all(0 <= r["score"] <= 1 for r in out.collect())
    assert {r["score"] for r in score_quality(docs, train_quality(docs, labels([]))).collect()} == {0.5}
    assert score_quality(docs.limit(0), None).collect() == []


def test_toxicity(table, labels):
    rows, marks = [], []
    for i in range(200):
        w, bad = prose("aa", RNG.randrange(10, 200)).split(), i % 4 == 0
        for _ in range(2 * bad):
            w.insert(RNG.randrange(len(w)), RNG.choice(["grumpf", "zonkel" + RNG.choice(["ka", "lo", "mi"])]))
        rows.append((i, " ".join(w), "en", "s"))
        marks.append((i, 1, int(bad)))
    docs = table(rows + [(i, t, "en", "s") for i, t in EDGE])
    model = train_toxicity(docs, labels(marks + [(None, 1, 1), (0, 1, None)]))
    out = score_toxicity(docs, model)
    truth = {i: t for i, _, t in marks}
    right = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in out.where(held_out("doc_id")).collect() if r["doc_id"] in truth]
    assert len(right) > 20 and np.mean(right) >= 0.95
    assert "grumpf" in {*model.words, *model.stems} and any(s.startswith("zonk") for s in model.stems)
    at = {r["doc_id"]: r for r in out.collect()}
    assert len(at[9004]["toxic_hits"]) == 0 and max(at[i]["score"] for i in (9001, 9002, 9004)) < 0.3
    assert score_toxicity(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("text, hits", [
    ("you m0r0n", 1), ("you MОRОN!", 1), ("you morоn", 1), ("1d10t, 1oser and l0s3r", 3), ("ｍｏron", 1),
    ("$tupid", 1), ("s7up1d", 1), ("oxymoron", 0), ("morons", 0), ("the pond scum", 0), ("scum of the pond", 1),
    ("clown fish and clown", 1), ("", 0)])
def test_folding_and_exceptions(text, hits):
    model = X.ToxicityModel(words={w: 1.0 for w in X.SEEDS})
    assert len(X.matcher(model)(X.folding()(text))) == hits


def test_without_labels(table, labels):
    docs = table([(1, "you stupid idiot"), (2, "a fine day")])
    out = {r["doc_id"]: r["score"] for r in score_toxicity(docs, train_toxicity(docs, labels([]))).collect()}
    assert out[1] > 0.3 > out[2]


@pytest.mark.parametrize("text, hits", [
    ("bully, bul1y, bu1ly, bu11y and BU1LY", 5), ("lächerlich, achlichkeit and ach1ichkeit", 2), ("a c1own fish", 0),
    ("a bu1\u04cfy", 1), ("bu\uff4c1y", 1), ("a bullying", 0)])
def test_one_stands_for_i_and_l(text, hits):
    model = X.ToxicityModel(words={"bully": 1.0, "clown": 1.0}, stems={"achlich": 1.0})
    assert len(X.matcher(model)(X.folding()(text))) == hits


# ------------------------------------------------- bounds, and brute force

def test_samples_stay_bounded_when_rows_share_an_id(table, labels):
    """Thousands of rows under one id, and without one: rows are picked, not ids."""
    rows = [(4, f"good row {i}") for i in range(5000)] + [(None, f"row {i}") for i in range(5000)]
    rows += [(8, "one and the same")] * 3000 + [(i, f"bad row {i}") for i in (1, 3, 5, 7)]
    marks = labels([(4, 1, 0), (8, 1, 0), (None, 1, 1), *[(i, 0, 1) for i in (1, 3, 5, 7)]])
    got = labelled_sample(table(rows), marks, "quality", 10, 100)
    assert sum(y for _, y in got) == 10 and len({t for t, _ in got}) == len(got)
    got = labelled_sample(table(rows), marks, "quality", 10_000, 100)
    want = {(f"good row {i}", 1) for i in range(5000)} | {("one and the same", 1)}
    held = {i for i in (1, 3, 4, 5, 7, 8) if zlib.crc32(str(i).encode()) % 4 == 2}
    want = {w for w in want if 4 not in held or not w[0].startswith("good")} | {
        (f"bad row {i}", 0) for i in (1, 3, 5, 7) if i not in held}
    if 8 in held:
        want.discard(("one and the same", 1))
    assert len(got) == len(want) and set(got) == want


def test_every_language_is_learned(table, monkeypatch):
    """Hundreds of languages, one with long rows only, one id for many rows."""
    free = [i for i in range(1, 4000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(free[i], f"w{i} " * 5, f"l{i:03}", "s") for i in range(400)]
    rows += [(free[500], f"{i} zz" * 4, "many", "s") for i in range(5000)]
    rows += [(free[600], "αβγ " * 20_000, "long", "s")]
    taken = []
    monkeypatch.setattr(G, "fit", lambda sample: taken.extend(sample) or "model")
    docs = table(rows)
    assert G.train_language_id(docs, per_language=20) == "model"
    by = {}
    for t, lang in taken:
        by.setdefault(lang, []).append(t)
    assert len(by) == 402 and len(by["many"]) == 20 and [len(t) for t in by["long"]] == [G.MAX_CHARS]
    taken.clear()
    monkeypatch.setattr(G, "MAX_ROWS", 500)
    G.train_language_id(docs, per_language=20, max_languages=3)
    assert {lang for _, lang in taken} == {"many", "l000", "l001"} and len(taken) == 22


def test_quality_by_plain_compression(table):
    """Sizes of 512-byte pieces with either dictionary, by a plain loop."""
    import zstandard
    from tessera.llm import quality as Q

    rows = [(i, prose(random.Random(i).choice(["aa", "bb", "cc"]), 40 + 60 * i)) for i in range(12)] + EDGE + [(3, "a"), (3, "a")]
    sample = [prose("aa", 200) for _ in range(30)], [prose("bb", 200) for _ in range(30)]
    model = Q.QualityModel(Q._dictionary(sample[0]), Q._dictionary(sample[1]), -0.3, 25.0)

    def size(raw, dictionary):
        c = zstandard.ZstdCompressor(level=Q.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary),
                                     write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(c.compress(raw[i:i + 512])) for i in range(0, len(raw), 512))

    want = []
    for i, t in rows:
        raw = (t or "").encode()
        e = (size(raw, model.bad) - size(raw, model.good)) / len(raw) if raw else 0.0
        want.append((i, e, 1 / (1 + np.exp(-(model.bias + model.slope * e)))))
    got = score_quality(table(rows), model).select("doc_id", "evidence", "score").collect()
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-12 and abs(g[2] - w[2]) < 1e-9


def test_toxicity_by_naive_search(table):
    """Every entry at every place of the folded text."""
    model = X.ToxicityModel(words={"bully": 2.0, "moron": 1.5}, stems={"zonk": 1.0, "zonkel": 3.0}, weights=[-4.0, 1.0, 1.5])
    rng = random.Random(5)
    parts = ["bully", "bul1y", "morons", "m0ron", "zonkelka", "zonk", "pond scum", "a", "x-zonk", "unmoron", "clown fish", "moron!"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))) for i in range(80)] + EDGE
    fold = X.folding()
    spare = {fold(e) for e in model.exceptions}

    def score(text):
        text = fold(text or "")
        free = lambda a: a == 0 or not text[a - 1].isalnum()
        closed = lambda e: e == len(text) or not text[e].isalnum()
        quiet = [(a, a + len(x)) for x in spare for a in range(len(text)) if text.startswith(x, a) and free(a) and closed(a + len(x))]
        total = 0.0
        for a in range(len(text)):
            found = [(w, a + len(fold(x))) for group, whole in ((model.words, True), (model.stems, False)) for x, w in group.items()
                     if text.startswith(fold(x), a) and free(a) and (closed(a + len(fold(x))) or not whole)]
            if found:
                w, e = max(found)
                total += w * (not any(p <= a and e <= q for p, q in quiet))
        v = -4.0 + np.log1p(total) + 1.5 * np.log1p(total / (1 + len(text) / X.PER_CHARS))
        return 1 / (1 + np.exp(-max(-30, min(30, v))))

    short = [(i, t) for i, t in rows if not t or len(t) < 5000]
    got = {r["doc_id"]: r["score"] for r in score_toxicity(table(short), model).collect()}
    for i, t in short:
        assert abs(got[i] - score(t)) < 1e-9, t


def test_language_by_a_loop_over_positions(table):
    """The network step by step, one position and one window at a time."""
    rows = [(i, prose(lang, 30), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 5)]
    model = G.fit([(t, lang) for _, t, lang, _ in rows], steps=15)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    sig = lambda a: 1 / (1 + np.exp(-a))

    def run(codes, side):
        x, u, h, out, k = w["x" + side], w["u" + side], np.zeros(G.HIDDEN), {}, G.HIDDEN
        order = range(len(codes)) if side == "f" else range(len(codes) - 1, -1, -1)
        for t in order:
            a, b = x[:, codes[t]], u @ h
            z, r = sig(a[:k] + b[:k]), sig(a[k:2 * k] + b[k:2 * k])
            new = np.tanh(a[2 * k:] + r * b[2 * k:])
            h = (1 - z) * new + z * h
            out[t] = h
        return out

    def pooled(text):
        raw, total = text.encode(), np.zeros(3)
        for lo in range(0, len(raw), G.WINDOW):
            piece = raw[lo:lo + G.WINDOW].ljust(G.WINDOW, b"\0")
            f, b = run(piece, "f"), run(piece, "b")
            for t in range(min(G.WINDOW, len(raw) - lo)):
                e = w["o"] @ np.concatenate([f[t], b[t]]) + w["c"][:, 0]
                p = np.exp(e - e.max())
                total += p / p.sum()
        return total / len(raw)

    docs = rows + [(100, "x1", None, "s"), (101, "ä" * 70, None, "s"), (100, "x1", None, "s"), (None, "no id", None, "s")]
    got = {(r["doc_id"], r["text"]): r for r in predict_language(table(docs), model).collect()}
    for i, t, *_ in docs:
        p = pooled(t)
        assert got[i, t]["lang_pred"] == model.languages[int(p.argmax())] and abs(got[i, t]["score"] - p.max()) < 1e-4
