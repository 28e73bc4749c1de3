"""The operators over whole texts, against brute force on small tables with
nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import line_dedup as L
from tessera.llm import ngram_jaccard as J
from tessera.llm import substring_dedup as S
from tessera.llm.components import connected_components
from tessera.llm.decontamination import find_items
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.license_scan import scan_licenses
from tessera.llm.mixing import mix


def text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, t, share):
    return " ".join(f"e{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in t.split(" "))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base, passage = text(rng, 120), text(rng, 60)
    rows = [(i, text(rng, rng.randrange(20, 150))) for i in range(1, 25)]
    rows += [(30 + i, edited(rng, base, 0.01 * (i % 6))) for i in range(40)]         # near copies, many on the threshold
    rows += [(80 + i, text(rng, 30) + "\n" + passage + "\n" + text(rng, 10)) for i in range(8)]
    rows += [(90 + i, "One and the same text\there ") for i in range(6)]              # copies
    rows += [(100, None), (101, ""), (102, None), (103, "  \n "), (104, "four words are few"), (105, "FOUR words are few")]
    rows += [(None, base), (None, passage), (None, None)]
    rows += [(7, "a row of an id that repeats\nwith a line of its own"), (30, base), (30, base)]
    rows += [(110, "same " * 80), (111, "ab " * 9000 + text(rng, 4000)), (112, "x" * 50_000), (113, "Ünïcode ÀB  wörter\x85hier da")]
    return rows


def canon(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def got(df, *cols):
    return canon([tuple(r) for r in df.select(*cols).collect()])


def test_exact_dedup(table, corpus):
    out = exact_dedup(table(corpus))
    assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == canon(brute.exact(corpus))
    kept = out.where("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == out.select("text_sha256").distinct().count()
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_jaccard(table, corpus):
    assert got(J.jaccard_components(table(corpus)), "doc_id", "n_shingles", "component_id") == canon(brute.jaccard(corpus))


def test_jaccard_in_pairs_of_blocks(table, corpus):
    out = J.jaccard_components(table(corpus), block_shingles=700)
    assert got(out, "doc_id", "n_shingles", "component_id") == canon(brute.jaccard(corpus))


def test_search_group_is_exact():
    import numpy as np
    rng = random.Random(3)
    for _ in range(30):
        base = [rng.sample(range(300), 40) for _ in range(3)]
        sets = [np.unique(np.array([x if rng.random() > p else rng.randrange(300, 900) for x in rng.choice(base)], np.uint64))
                for p in [rng.choice([0, .05, .1, .15, .25]) for _ in range(25)]]
        comp = list(range(25))
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                    comp = [new if c == old else c for c in comp]
        assert J.search_group(sets) == comp


def near_copies(rng, n, edits, words=64, alternatives=10 ** 6):
    """``n`` different shingle sets of one text with up to ``edits`` words replaced."""
    sets, of = {}, J.shingler()
    while len(sets) < n:
        w = [f"w{i}" for i in range(words)]
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(alternatives)}"
        s = of(" ".join(w))
        sets[s.tobytes()] = s
    return list(sets.values())


def components(n, ties):
    comp = list(range(n))
    for i, j in ties:
        old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
        comp = [new if c == old else c for c in comp]
    return comp


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_blocks_find_every_link(edits):
    """Blocks of queries against indexed blocks, any labels joined before, are
    as good as all pairs."""
    rng = random.Random(edits)
    sets = near_copies(rng, 120, edits)
    linked = [(i, j) for i in range(120) for j in range(i) if len(set(sets[i].tolist()) & set(sets[j].tolist()))
              >= J.least_overlap(len(sets[i]), len(sets[j]))]
    want = components(120, linked)
    assert J.search_group(sets) == want
    lead = [next((k for k in (0, 7) if i == k or (max(i, k), min(i, k)) in linked), None) for i in range(120)]
    label = [{None: 0, 0: 1, 7: 2}[k] for k in lead]
    ties = [(i, k) for i, k in enumerate(lead) if k not in (None, i)]
    block = [rng.randrange(3) for _ in range(120)]
    for main in (1, 2, -1):
        found = list(ties)
        for a in range(3):
            for b in range(3):
                q = [i for i in range(120) if block[i] == a and label[i] != main]
                s = [i for i in range(120) if block[i] == b]
                if q and s:
                    found += [(q[i], s[j]) for i, j in J.search_blocks(
                        [sets[i] for i in q], q, [label[i] for i in q], [sets[i] for i in s], s, [label[i] for i in s], main)]
        assert components(120, found) == want


def test_search_of_large_groups_does_not_explode():
    """1,600 near-equal sets of 60 shingles in seconds, as the sets of a third
    of the corpus may be near copies."""
    import time
    rng = random.Random(1)
    for edits in (1, 2, 4):
        sets = near_copies(rng, 1600, edits)
        began = time.process_time()
        J.search_group(sets)
        assert time.process_time() - began < 10       # about one second on an idle core


def test_substrings(table, corpus):
    out = S.dedup_substrings(table(corpus))
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == canon(brute.substrings(corpus))


def test_substrings_with_crowded_anchors(table, corpus):
    out = S.dedup_substrings(table(corpus), max_passages=1)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == canon(brute.substrings(corpus))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=30), st.integers(1, 2)), max_size=5), st.integers(1, 5))
def test_suffix_automaton(sequences, size):
    auto = S.SuffixAutomaton()
    for words, weight in sequences:
        auto.add(words, weight)
    auto.count()
    windows = [tuple(w[k:k + size]) for w, c in sequences for _ in range(c) for k in range(len(w) - size + 1)]
    for words, _ in sequences:
        want = [k for k in range(len(words) - size + 1) if windows.count(tuple(words[k:k + size])) > 1]
        assert auto.repeats(words, size) == want


def test_lines(table, corpus):
    rows = corpus + [(200, "A line of some length\nother\nA line of some length"), (201, "  a LINE of some length\t\nshort one\n"),
                     (202, "a line of some length"), (None, "a line of some length"), (203, "short one")]
    out = L.dedup_lines(table(rows))
    assert got(out.withColumn("s", F.sha2("text", 256)), "doc_id", "n_lines", "n_dropped", "s") == canon(brute.lines(rows))
    assert out.columns[:2] == ["doc_id", "text"] and set(table(rows).columns) <= set(out.columns)


def test_line_index_is_reversible(table, spark):
    first = [(1, "line number one\nline number two"), (2, "line number two\nline number three")]
    more = [(0, "line number three"), (3, "line number one\nline number four"), (None, "line number four")]
    index = L.build(table(first), keys_per_shard=2)
    both = L.add(index, table(more))
    dropped = lambda x: got(L.lost_keys(x).withColumn("key", F.hex("key")), "doc", "key")
    assert dropped(both) == dropped(L.build(table(first + more), keys_per_shard=2))
    assert len(dropped(both)) == 4
    back = L.remove(both, spark.createDataFrame([(0,), (3,), (None,)], "doc_id long"))
    assert dropped(back) == dropped(index) and got(back.refs.withColumn("key", F.hex("key")), "key", "doc", "n") == got(
        index.refs.withColumn("key", F.hex("key")), "key", "doc", "n")
    for x in (index, both, back):  # no filter loses a key that it holds
        held = {bytes(r["key"]) for r in L._repeated(x.refs).collect()}
        assert {bytes(r["key"]) for r in L.lost_keys(x).collect()} == held


def test_lines_of_rows_that_share_an_id(table, monkeypatch):
    """Thousands of rows without an id, or with one: each row meets only the
    keys of its own lines."""
    rows = [(None, f"line of row {i} and of another\nalone in row {i}") for i in range(1500)]
    rows += [(5, f"line of row {i} and of another\nsecond row {i}") for i in range(1500)]
    rows += [(1, f"line of row {i} and of another") for i in range(0, 1500, 3)] + [(2, "second row 7"), (None, None), (5, "")] + rows[:3]
    largest = []
    monkeypatch.setattr(L, "map_columns", lambda df, *a, f=L.map_columns: largest.append(
        df.select(F.max(F.size("_lost"))).first()[0]) or f(df, *a))
    out = L.dedup_lines(table(rows))
    assert got(out.withColumn("s", F.sha2("text", 256)), "doc_id", "n_lines", "n_dropped", "s") == canon(brute.lines(rows))
    assert max(n for n in largest if n) <= 2


def test_lines_of_a_hot_shard(table):
    """A line that most documents hold is probed in many pieces, with the same result."""
    rows = [(i, f"the line that all of them hold\na line of number {i} alone\nshared by {i // 2} and a neighbour") for i in range(200)]
    index = L.build(table(rows), keys_per_shard=100)
    whole = got(L.lost_keys(index).withColumn("key", F.hex("key")), "doc", "key")
    assert len(whole) == 199 + 100
    assert got(L.lost_keys(index, piece_rows=10).withColumn("key", F.hex("key")), "doc", "key") == whole
    even, hot = L._pieces(index, 10)
    assert even == 10 and hot.agg(F.max("pieces")).first()[0] >= 200 / 10 + even


def test_cuckoo_filter():
    import numpy as np
    rng = np.random.default_rng(1)
    keys, other = rng.integers(0, 2 ** 63, 20_000).astype(np.uint64), rng.integers(0, 2 ** 63, 20_000).astype(np.uint64)
    f = L.CuckooFilter.of(keys)
    assert f.contains(keys).all() and f.contains(other).mean() < 0.01
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all() and f.contains(keys[:10_000]).mean() < 0.01
    assert L.CuckooFilter.from_bytes(f.to_bytes()).contains(keys[10_000:]).all()
    full = L.CuckooFilter(2)
    with pytest.raises(OverflowError):
        full.insert(keys[:50])


def test_leaks(table, spark, corpus):
    rng = random.Random(9)
    items = [(i, text(rng, 8 + 5 * i, 4000)) for i in range(8)] + [(50, "too few words"), (51, None), (None, text(rng, 20)), (52, "")]
    rows = corpus + [(300 + i, text(rng, 900) + " " + edited(rng, t or "", 0.03) + ". " + text(rng, 500)) for i, (_, t) in enumerate(items)]
    rows += [(320, items[3][1].upper()), (320, items[4][1]), (None, items[5][1])]
    out = find_items(table(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert got(out, "doc_id", "item_id", "n_shingles", "n_found") == canon(brute.leaks(rows, items))
    assert out.where("sketch_containment <= 0 OR sketch_containment > 1").count() == 0


def test_licenses(table):
    rows = [(1, "Some text. All rights  Reserved! more, cc\nby and CC-BY."), (2, None), (3, ""),
            (4, "w " * 31 + "general public license" + " w" * 100 + " general public licenses general public License"),
            (5, "Licensed under the Apache License, Version 2.0."), (6, "licensed under an apache licence version 2 0 of the"),
            (7, "by cc rights all reserved"), (None, "xé all rights reserved"), (None, None), (4, "cc by")]
    out = {}
    for r in scan_licenses(table(rows)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    one = lambda i: out[i][0]
    assert (one(1)["n_words"], one(1)["n_base"], one(1)["first_word"], one(1)["last_word"]) == (11, 3, 2, 9)
    assert one(1)["base_labels"] == "cc-by,reserved" == one(1)["labels"] and one(1)["score"] == 1.0
    for i in (2, 3):
        assert tuple(one(i)[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) == (
            0, 0, None, None, "", "", 0.0)
    four = sorted(out[4], key=lambda r: -r["n_words"])
    assert (four[0]["n_base"], four[0]["first_word"], four[0]["last_word"], four[0]["base_labels"]) == (2, 31, 137, "gpl")
    assert one(5)["labels"] == "apache-2.0" and one(5)["base_labels"] == "" and one(5)["score"] == 1.0
    assert one(6)["labels"] == "" or one(6)["score"] >= 0.8
    assert one(7)["n_base"] == 0 and one(7)["labels"] == ""
    assert sorted(r["n_base"] for r in out[None]) == [0, 1]


def test_license_blocks_against_all_pairs(table):
    """Every block against every template, without filters."""
    import math
    import re

    from tessera.llm import license_scan as LS
    rng = random.Random(4)
    pool = [w for t in LS.TEMPLATES.values() for w in t.split()] + ["the", "of", "filler", "other"]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < .6 else "z" for _ in range(rng.randrange(5, 120)))) for i in range(60)]
    rows += [(100 + i, " ".join(rng.sample(t.split(), math.ceil(.85 * len(t.split()))))) for i, t in enumerate(LS.TEMPLATES.values())]
    for r in scan_licenses(table(rows)).collect():
        w = re.findall(LS.WORD_RUN, r["text"].lower())
        bags = [set(w[b * 32:(b + 2) * 32]) for b in range(len(w) // 32 + 1)]
        want = {n: max(len(set(t.split()) & b) / len(set(t.split())) for b in bags) for n, t in LS.TEMPLATES.items()}
        assert {m["label"]: m["containment"] for m in r["matches"]} == {n: v for n, v in want.items() if v >= .8}


def test_mix(table):
    rng = random.Random(2)
    rows = [(i, text(rng, rng.randrange(1, 60)), "en", rng.choice(["a", "b", "b", "b", "c", None, "é"])) for i in range(300)]
    rows += [(900, None, "en", "a"), (901, "", "en", "zero"), (None, "one two", "en", "b"), (3, "twice the id", "en", "b"), (3, "twice the id", "en", "b")]
    out = mix(table(rows), slice_rows=20)
    assert out.count() == len(rows)
    assert got(out, "doc_id", "taken") == got(mix(table(rows[::-1]), slice_rows=7), "doc_id", "taken")
    by = {}
    for r in out.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["target"], []).append(r)
    # round by round, as the contract words it
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= 2 * size[s]
        free -= over
    for r in out.collect():
        assert any(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == size[s] for s in names)
    for t, rs in by.items():
        assert abs(sum(r["taken"] for r in rs) - t) < 1 or len({r["source_size"] for r in rs}) > 1


def test_mix_slices_stay_even(spark):
    """Slices are bounded whatever the weights, and follow the keys' order."""
    from tessera.llm.mixing import position, uniform
    n, slices = 40_000, 40
    for weights in ("0.1D", "1D", "if(doc_id % 3 = 0, 0.1D, 0.7D)"):
        key = -F.log(uniform("doc_id", "mix")) / F.expr(weights)
        rows = spark.range(n).withColumnRenamed("id", "doc_id").select(key.alias("k"), position(key).alias("p")).orderBy("k").collect()
        held = [0] * (slices + 1)
        for r in rows:
            held[int(r["p"] * slices)] += 1
        assert max(held) < 8.5 * n / slices
        assert all(0 <= a["p"] <= b["p"] <= 1 for a, b in zip(rows, rows[1:]))


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(5, 5)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(out.collect()) == {i: find(i) for i in root}


def test_empty_tables(table, spark):
    none = table([])
    items = spark.createDataFrame([(1, "a benchmark item of several words here")], "item_id long, text string")
    for out in (exact_dedup(none), mix(none), scan_licenses(none), L.dedup_lines(none), J.jaccard_components(none),
                S.dedup_substrings(none), find_items(none, items), find_items(table([(1, "a b c d e f")]), items.limit(0))):
        assert out.collect() == []
