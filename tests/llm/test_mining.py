"""Spelling groups, collocations and packing against brute force on small
tables with nulls, empty and very long texts, ties, repeated rows, empty
tables and clashing columns."""

import random
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import collocations as C
from tessera.llm import packing as P
from tessera.llm import spelling as S
from tessera.llm.queries import op11_spelling_variants, op12_collocations, op13_packing


def canon(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


# ---------------------------------------------------------------- spelling

@pytest.fixture(scope="module")
def letters():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(7, 12))) for _ in range(12)] + [
        "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "×÷×÷×÷×", "ÉCOLIERS", "écoliers"]

    def edited(w):
        i, c = rng.randrange(len(w) + 1), rng.choice("abcdÿ")
        return rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])

    rows = []
    for i in range(60):
        words = [rng.choice(base) for _ in range(30)]
        rows.append((i, " ".join(rng.choice([w, w, w, w.upper(), edited(w), edited(edited(w))]) for w in words)))
    long = "".join(rng.choice("xyz") for _ in range(3000))
    rows += [(100, long), (101, long + " " + long[:1500] + "q" + long[1500:]), (102, long[:1500] + "q" + long[1500:]),
             (103, "q" + long + " q" + long), (104, long[:-1] + "," + long[:-1]), (105, None), (106, ""), (107, "1_2 -"),
             (None, "aaaaaaaa aaaaaaab"), (None, "aaaaaaaa aaaaaaab"), (None, None), (3, rows[3][1]), (108, "abcdefg " * 4000)]
    return rows


def test_spelling(table, letters):
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    want = canon(brute.spelling(letters))
    assert canon(S.spelling_groups(table(letters)).select(*cols).collect()) == want
    # sets halved to the end, and open parts of one code point only
    assert canon(S.spelling_groups(table(letters), group_words=1, open_length=1).select(*cols).collect()) == want
    assert {r[1] for r in want} > {None} and any(r[4] > 3 for r in want)
    assert max(len(r[0]) for r in want if r[4]) == 3001
    assert S.spelling_groups(table([])).collect() == []
    assert S.spelling_groups(table([(1, None), (2, "")])).collect() == []


def test_chain_of_forms(table):
    words = ["abcdefg"] * 3 + ["abcdefgh"] * 30 + ["abcdefghi"] * 300 + ["abcdefghij"] * 3000
    rows = [(i, w) for i, w in enumerate(words)]
    got = {r["word"]: r for r in S.spelling_groups(table(rows)).collect()}
    assert canon(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got.values()) == canon(
        brute.spelling(rows))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=3, max_size=6), unique=True, max_size=30))
def test_composition(words):
    """All pairs of the composed machine, whole and by halved sets."""
    for m in range(3, 7):
        group = [w for w in words if len(w) in (m, m + 1)]
        got = sorted(tuple(sorted((group[i], group[j]))) for i, j in S.near_words(group, m, 0, 0))
        want = sorted({tuple(sorted((a, b))) for a in group for b in group if a != b and len(a) == m and (
            len(b) == m and sum(x != y for x, y in zip(a, b)) == 1
            or len(b) == m + 1 and any(b[:i] + b[i + 1:] == a for i in range(m + 1)))})
        assert got == want      # each pair once


def test_minimised():
    """States with the same right language are one."""
    a = S.Acceptors()
    a.build(sorted(x + y for x in "abcd" for y in ("ing", "ed", "")))
    assert len(a.arcs) == 6      # initial, behind the first letter, in, ing | e, end


# ------------------------------------------------------------ collocations

@pytest.fixture(scope="module")
def speech():
    rng = random.Random(9)
    pool = [f"w{i}" for i in range(40)] + ["É", "ÀB", "x\x00y"]
    fixed = ["new york city", "of the", "of the people by", "a a a a", "Big Data"]

    def text():
        out = []
        for _ in range(rng.randrange(3, 60)):
            out.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(pool))
            out.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!", "\x0b"]))
        return "".join(out)

    rows = [(i, text(), rng.choice(["en", "en", "de", None]), "s") for i in range(120)]
    rows += [(500, "only in one long text: " + "rare pair, " * 40 + "four rare words here " * 45, "fr", "s"),
             (501, None, "en", "s"), (502, "", None, "s"), (503, " .,; \t", "en", "s"), (None, rows[0][1], "en", "s"),
             (None, None, None, None), rows[5], rows[5], (504, "lorem ipsum " * 20_000, "la", "s")]
    return rows


def test_phrases_exact(table, speech):
    """Whatever the sample proposes, all frequent phrases are counted."""
    want, total = brute.phrases([(r[2], r[1]) for r in speech], 30)
    want |= {(lang, ""): n for lang, n in total.items()}
    for options in ({}, {"share": 1, "sample_count": 1}, {"share": 1, "sample_count": 10 ** 9}, {"chunk_words": 50},
                    {"size": 64}, {"size": 1 << 10, "sample_count": 10}):
        rows = C.frequent_phrases(table(speech), **options).collect()
        assert {(r["lang"], r["phrase"]): r["n"] for r in rows} == want and len(rows) == len(want)


def test_border_failures(spark, speech):
    """What the sample does not propose is counted by the expansion, down to
    phrases of which no part was proposed."""
    rows = [("en", "alpha beta gamma delta. " * 30)]
    docs = spark.createDataFrame([(1, t, lang) for lang, t in rows], "doc_id long, text string, lang string")
    got = {r["phrase"]: r["n"] for r in C.frequent_phrases(docs, share=1, sample_count=31).collect()}
    assert got == {"": 120, **{" ".join("alpha beta gamma delta".split()[i:j]): 30 for i in range(4) for j in range(i + 1, 5)}}


def test_buckets_add_up_alike(spark, monkeypatch):
    """Whatever the buckets, and in whatever steps a bucket is added up."""
    rng = random.Random(6)
    docs = spark.createDataFrame([("en", " ".join(f"w{rng.randrange(40)}" for _ in range(300))) for _ in range(20)],
                                 "lang string, text string").repartition(3)
    full = spark.sparkContext.broadcast(np.full(1, 2 ** 64 - 1, np.uint64))
    want = sorted(map(tuple, C.hash_counts(docs, full).collect()))
    assert sum(n for _, n in want) == 20 * (300 + 299 + 298 + 297)
    for bits in (8, 13, 18):
        for merged in (500_000, 7):
            monkeypatch.setattr(C, "MERGED", merged)
            got = C.hash_counts(docs, full, chunk_words=500, least=3, bucket_bits=bits).collect()
            assert sorted(map(tuple, got)) == [w for w in want if w[1] >= 3]


def test_distinct_rows():
    rng = np.random.default_rng(2)
    for bits in (3, 16, 21, 30):
        rows = rng.integers(0, 1 << min(bits, 3), (500, 4))
        rows[:, 0] += (1 << bits) - 8
        columns, n = C.distinct_rows([*rows.T], bits)
        want, times = np.unique(rows, axis=0, return_counts=True)
        assert (np.column_stack(columns) == want).all() and (n == times).all()


def test_collocations(table, speech):
    want = brute.collocations([(r[2], r[1]) for r in speech])
    assert canon(C.mine_collocations(table(speech)).collect()) == canon(want) and len(want) > 10
    top = C.collocations(C.frequent_phrases(table(speech)), top=3)
    assert canon(top.collect()) == canon(r for r in want if r[1] <= 3)
    assert C.mine_collocations(table([])).collect() == []
    assert C.mine_collocations(table([(1, None, None, None)])).collect() == []


def test_exact_arithmetic(spark):
    big = 9 * 10 ** 18 - 1
    rows = [("x", 0, "", big), ("x", 1, "a", big), ("x", 1, "b", big - 2), ("x", 2, "a b", big - 3)]
    got = C.collocations(spark.createDataFrame(rows, "lang string, k int, phrase string, n long")).collect()
    assert [(r["score"], r["a"]) for r in got] == [(2000000 * (big - 3) // (big + big - 2), big - 3)]


# ----------------------------------------------------------------- packing

@pytest.fixture(scope="module")
def encode():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, 1]


def whole(rows, encode, window=2048):
    """Checks every sequence and document of packed rows against the tokenizer."""
    def check(out, rows):
        sequences, docs = {}, {}
        for r in out:
            assert len(r["ids"]) == 4 * r["length"] > 0
            sequences.setdefault(r["sequence_id"], []).append(r)
            docs.setdefault(r["doc_id"], []).append(r)
        lengths = []
        for s in sequences.values():
            s.sort(key=lambda r: r["offset"])
            ends = np.cumsum([r["length"] for r in s])
            assert [r["offset"] for r in s] == [0, *ends[:-1]] and ends[-1] <= window
            lengths.append(int(ends[-1]))
        want = {}
        for d, t, *_ in rows:
            want.setdefault(d, []).append(np.array(encode(t), "<u4").tobytes())
        for d, texts in want.items():
            assert sum(r["length"] for r in docs[d]) == sum(map(len, texts)) // 4
            if len(texts) == 1:
                pieces = sorted(docs[d], key=lambda r: r["start"])
                assert b"".join(r["ids"] for r in pieces) == texts[0]
                assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]]
                assert {r["doc_tokens"] for r in pieces} == {len(texts[0]) // 4}
        assert len(docs) == len(want)
        return lengths
    return check(rows[0], rows[1])


@pytest.fixture(scope="module")
def library():
    rng = random.Random(4)
    rows = [(i, " ".join(f"topic{i % 7}x{rng.randrange(30)}" for _ in range(rng.randrange(1, 400)))) for i in range(80)]
    return rows + [(200, None), (201, ""), (202, "long text, " * 30_000), (203, "a<|endoftext|>b  \n\t é 中文 \U0001f600"),
                   (None, "no id"), (None, None), (5, "an id that repeats"), (6, rows[6][1]), (6, rows[6][1]),
                   *[(300 + i, "one and the same text " * 30) for i in range(40)]]


def test_packing(table, library, encode):
    out = P.pack(table(library)).collect()
    lengths = whole((out, library), encode)
    assert all(n & (n - 1) == 0 for n in lengths)            # nothing is padded
    assert sum(n < 2048 for n in lengths) <= 11              # one shard
    small = P.pack(table(library), window=64, shard_ids=300).collect()
    whole((small, library), encode, 64)
    assert P.pack(table([])).collect() == []
    assert [r["length"] for r in P.pack(table([(1, None), (1, None), (None, None)])).collect()] == [1, 1, 1]


def test_neighbours(table, encode):
    """A window is filled with texts of its seed's words."""
    rng = random.Random(8)
    kinds = [["".join(rng.choices(letters, k=6)) for _ in range(60)] for letters in ("abcde", "fghij", "klmno", "pqrst")]
    rows = [(i, " ".join(rng.sample(kinds[i % 4], 30))) for i in range(40)]
    shards = P.pack(table(rows), window=1024).collect()
    of = {}
    for r in shards:
        of.setdefault(r["sequence_id"], []).append(r)
    full = [s for s in of.values() if sum(r["length"] for r in s) == 1024]
    same = [sum(r["length"] for r in s if r["doc_id"] % 4 == s[0]["doc_id"] % 4) for s in full]
    assert full and sum(same) / (1024 * len(full)) > 0.5     # a quarter by chance


def test_bm25_scores():
    rng = np.random.default_rng(1)
    pieces = [rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint16) for _ in range(30)]
    held = np.bincount(np.concatenate([np.unique(p) for p in pieces]), minlength=60)
    idf, mean = P.rarity(held, 30), np.mean([len(p) for p in pieces])
    index = P.ShardIndex(pieces, idf, mean)
    for q in range(30):
        heavy = sorted((-w, t) for _, t, w in zip(*P.weighted_bags([pieces[q]], idf, mean)))[:P.QUERY_TERMS]
        assert P.heaviest_terms(pieces, idf, mean)[q] == heavy[0][1]
        for i, p in enumerate(pieces):
            tf = {t: list(p).count(t) for _, t in heavy}
            want = sum(np.log1p((30 - held[t] + .5) / (held[t] + .5)) * n * 2.2 / (n + 1.2 * (.25 + .75 * len(p) / mean))
                       for t, n in tf.items())
            assert abs(index.scores(q)[i] - want) < 1e-9


def test_shards_are_bounded():
    sizes = [(t, 10) for t in range(100)] + [(200, 1000), (201, 35), (202, 100)]
    rows = P.shard_table(sizes, 100)
    load = {}
    for (t, n), (_, first, k) in zip(sorted(sizes), rows):
        for s in range(first, first + k):
            load[s] = load.get(s, 0) + n / k
    assert max(load.values()) <= 100 and len(load) < 25


def test_token_ids_of_all_code_points(encode):
    coder, size = P.encoder(P.ranks_path())
    assert size == 50257
    for lo in range(0, 0x20000, 256):
        text = "".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}'s" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000)
        assert [*coder(text).tolist(), 1] == encode(text)


# ----------------------------------------------------------------- queries

def test_queries_on_tables(spark, encode):
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = [r[:2] for r in docs]
    assert canon(op11_spelling_variants(spark, d).collect()) == canon(brute.spelling(rows))
    assert canon(op12_collocations(spark, d).collect()) == canon(brute.collocations([(r[2], r[1]) for r in docs]))
    out = op13_packing(spark, d).collect()
    ids = {i: np.array(encode(t), "<u4") for i, t in rows}
    assert sum(r["length"] for r in out) == sum(map(len, ids.values()))
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) for r in out)
