"""Substring dedup by suffix automata of reference shards.

Removes every word covered by a window of ``WINDOW`` consecutive words that
also starts somewhere else.  A suffix automaton of the whole corpus cannot be
broadcast, and streaming every document through every shard's automaton is
quadratic; so the reference is sharded by content, and a document's passages
are streamed only through the automaton that can match them:

1. Anchors.  The anchor of a window is the smallest hash among its
   ``GRAM``-word grams.  Equal windows have equal anchors, so a window can
   repeat only if its anchor is met in another text, or twice in its own
   (an aggregate over one row per text and anchor).  Copies of one text
   repeat whole; one row stands for them, with the number of copies.
2. Passages.  Of texts with such anchors, each run of windows with one shared
   anchor is cut out as a passage of words.  Equal passages are collapsed
   map-side and counted.
3. Shards.  The distinct passages of an anchor are the reference of its
   shard: a generalised suffix automaton with the number of places at which
   each of its states ends.  Each passage is streamed through it; where the
   matching statistic is at least ``WINDOW`` and the state ends at two places
   or more, the window repeats.  Words are compared as they are.
   An anchor with more than ``MAX_PASSAGES`` distinct passages is not held in
   one task: its windows are counted as rows instead, which is as exact.
4. The repeated windows of a text are united, and their words removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_columns, staged, text_or_empty, texts_of

WINDOW = 35
GRAM = 8
MAX_PASSAGES = 2000
PASSAGES_PER_PACK = 2_000
VOCABULARY = 1_000_000


def with_digest(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _t, t1, t2): texts, null as empty, with a 128-bit digest."""
    t = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("_id"), t.alias("_t"), F.xxhash64(t).alias("t1"),
                       F.xxhash64(F.lit("second"), t).alias("t2"))


def word_hasher():
    """list of words (bytes) -> array of their 64-bit hashes."""
    import xxhash

    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest

    def of(words):
        if len(known) > VOCABULARY:
            known.clear()
        codes = []
        for w in words:
            c = known.get(w)
            if c is None:
                c = known[w] = digest(w)
            codes.append(c)
        return np.array(codes, np.uint64)

    return of


def window_anchors(codes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each window, hash of each gram) of a text's word hashes."""
    if len(codes) < window:
        empty = np.zeros(0, np.uint64)
        return empty, empty
    n = len(codes) - gram + 1
    h = np.zeros(n, np.uint64)
    mul = np.uint64(0x9E3779B97F4A7C15)
    for j in range(gram):
        h = (h + codes[j:j + n]) * mul
        h ^= h >> np.uint64(31)
    width = window - gram + 1
    low, span = h, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return (np.minimum(low[:len(low) - rest], low[rest:]) if rest else low), h


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the number of
    places (weighted) at which each state's words end."""

    def __init__(self):
        self.next, self.link, self.size, self.places = [{}], [-1], [0], [0]

    def _state(self, size, link, next_):
        self.next.append(next_)
        self.link.append(link)
        self.size.append(size)
        self.places.append(0)
        return len(self.size) - 1

    def add(self, words, weight: int) -> None:
        """A further sequence, counted ``weight`` times."""
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for w in words:
            held = nxt[last].get(w)
            if held is not None and size[held] == size[last] + 1:
                last = held
            else:
                p, fresh = last, held is None
                if fresh:
                    made = self._state(size[last] + 1, 0, {})
                    while p != -1 and w not in nxt[p]:
                        nxt[p][w] = made
                        p = link[p]
                    held = nxt[p][w] if p != -1 else None
                if p == -1:
                    link[made] = 0
                elif size[held] == size[p] + 1:
                    link[made] = held
                else:
                    clone = self._state(size[p] + 1, link[held], dict(nxt[held]))
                    while p != -1 and nxt[p].get(w) == held:
                        nxt[p][w] = clone
                        p = link[p]
                    link[held] = clone
                    if fresh:
                        link[made] = clone
                    else:
                        made = clone
                last = made
            self.places[last] += weight

    def count(self) -> None:
        """Once all sequences are in: places of a state include those of the
        states that link to it."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]

    def repeats(self, words, window: int) -> list[int]:
        """Starts of the windows of ``words`` that end at two places or more,
        by the matching statistics of the sequence."""
        nxt, link, size, places = self.next, self.link, self.size, self.places
        out, s, met = [], 0, 0
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                met = size[s]
            if w in nxt[s]:
                s = nxt[s][w]
                met += 1
            while s and size[link[s]] >= window:
                s = link[s]
                met = size[s]
            if met >= window and places[s] >= 2:
                out.append(i - window + 1)
        return out


def _ranges(starts) -> list[dict]:
    """Runs of consecutive starts as half-open ranges."""
    out: list[dict] = []
    for s in starts:
        if out and out[-1]["end"] == s:
            out[-1]["end"] = s + 1
        else:
            out.append({"start": s, "end": s + 1})
    return out


RANGES = "array<struct<start:int,end:int>>"


def _anchored(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(_id, _t, t1, t2) -> (_id, t1, t2, anchors): the distinct anchors of
    the text's windows, and whether an anchor's gram is met twice in it."""
    schema = T.StructType([docs.schema["_id"], *T.StructType.fromDDL(
        "t1 long, t2 long, anchors array<struct<a:bigint,twice:boolean>>").fields])

    def start():
        hashes = word_hasher()

        def f(batch):
            out = []
            for text in texts_of(batch, "_t"):
                anchors, grams = window_anchors(hashes(text.encode().split()), window, gram)
                own = np.unique(anchors)
                grams = np.sort(grams)
                twice = np.searchsorted(grams, own, "right") - np.searchsorted(grams, own, "left") > 1
                out.append([{"a": a, "twice": t} for a, t in zip(own.view(np.int64).tolist(), twice.tolist())])
            return {"anchors": out}

        return f

    return map_columns(docs, schema, start)


def _passages(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """(_t, t1, t2, copies, shared) -> a row for each run of windows with one
    shared anchor: (a, s1, s2, t1, t2, copies, start, words)."""
    schema = T.StructType.fromDDL(
        "a long, s1 long, s2 long, t1 long, t2 long, copies long, start int, words string")
    names, size = schema.names, window

    def run(batches):
        import pyarrow as pa
        import xxhash

        hashes = word_hasher()
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.string()]
        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            out = []
            for text, t1, t2, copies, shared in zip(*[cols[c] for c in ("_t", "t1", "t2", "copies", "shared")]):
                words = text.encode().split()
                anchors, _ = window_anchors(hashes(words), size, gram)
                anchors = anchors.view(np.int64)
                cuts = np.flatnonzero(np.diff(anchors)) + 1
                wanted = set(shared)
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(anchors)]):
                    if b > a and int(anchors[a]) in wanted:
                        piece = b" ".join(words[a:b + size - 1])
                        digest = xxhash.xxh3_128_digest(piece)
                        out.append((int(anchors[a]), int.from_bytes(digest[:8], "big", signed=True),
                                    int.from_bytes(digest[8:], "big", signed=True), t1, t2, copies, a, piece.decode()))
            for at in range(0, len(out), 20_000):
                part = list(zip(*out[at:at + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds)], names=names)

    return texts.mapInArrow(run, schema)


def _by_automaton(distinct: DataFrame, packs: int, window: int) -> DataFrame:
    """Repeated windows of the distinct passages (a, s1, s2, words, weight)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s1, s2, anchors, found = [], [], [], []
        for a, g in pdf.groupby("a", sort=False):
            passages = [w.encode().split(b" ") for w in g["words"]]
            weights = g["weight"].tolist()
            if len(passages) == 1 and weights[0] >= 2:
                starts = [list(range(len(passages[0]) - window + 1))]
            else:
                auto = SuffixAutomaton()
                for words, weight in zip(passages, weights):
                    auto.add(words, weight)
                auto.count()
                starts = [auto.repeats(words, window) for words in passages]
            for x, y, s in zip(g["s1"], g["s2"], starts):
                if s:
                    anchors.append(a)
                    s1.append(x)
                    s2.append(y)
                    found.append(_ranges(s))
        return pd.DataFrame({"a": np.array(anchors, np.int64), "s1": np.array(s1, np.int64),
                             "s2": np.array(s2, np.int64), "ranges": found})

    pack = F.pmod(F.xxhash64("a"), F.lit(packs)).alias("pack")
    return (distinct.select("*", pack).groupBy("pack")
            .applyInPandas(run, f"a long, s1 long, s2 long, ranges {RANGES}"))


def _by_rows(distinct: DataFrame, window: int) -> DataFrame:
    """The same for anchors with too many passages: windows as rows."""
    split = distinct.select("a", "s1", "s2", "weight", F.split("words", " ").alias("w"))
    rows = split.select("a", "s1", "s2", "weight", "w", F.explode(
        F.sequence(F.lit(0), F.size("w") - window)).alias("start")).select(
        "a", "s1", "s2", "weight", "start", F.md5(F.concat_ws(" ", F.slice("w", F.col("start") + 1, window))
                                                  .cast("binary")).alias("key"))
    often = rows.groupBy("key").agg(F.sum("weight").alias("places")).where("places >= 2").select("key")
    one = F.array(F.struct(F.col("start").cast("int").alias("start"), (F.col("start") + 1).cast("int").alias("end")))
    return (rows.join(often, "key").groupBy("a", "s1", "s2")
            .agg(F.flatten(F.collect_list(one)).alias("ranges")))


def _removed(docs: DataFrame, window: int) -> DataFrame:
    """(_id, _t, whole, ranges) -> (_id, n_words, n_removed, kept_text, spans,
    kept_sha256)."""
    schema = T.StructType([docs.schema["_id"], *T.StructType.fromDDL(
        "n_words long, n_removed long, kept_text string, spans array<struct<start:int,end:int>>, kept_sha256 string")])
    size = window

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in schema.fields]
        for batch in batches:
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            out = []
            for i, text, whole, ranges in zip(*[cols[c] for c in ("_id", "_t", "whole", "ranges")]):
                words = text.encode().split()
                if whole and len(words) >= size:
                    spans = [[0, len(words)]]
                else:
                    spans = []
                    for r in sorted((r["start"], r["end"] + size - 1) for r in ranges or ()):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], r[1])
                        else:
                            spans.append(list(r))
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                left = b" ".join(kept)
                out.append((i, len(words), len(words) - len(kept), left.decode(),
                            [{"start": a, "end": b} for a, b in spans], hashlib.sha256(left).hexdigest()))
            part = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(part, kinds)], names=schema.names)

    return docs.mapInArrow(run, schema)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM, max_passages: int = MAX_PASSAGES) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text, spans (the
    removed words, half-open, maximal) and kept_sha256.

    Null and empty texts have no words and keep none.  Rows may repeat and
    share ids or have null ones; each row is a place of its own.  Columns
    other than id and text are ignored.
    """
    base = with_digest(docs, id_col, text_col)
    rows = staged(_anchored(base, window, gram))
    texts = staged(rows.groupBy("t1", "t2").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("copies")))

    met = rows.select("t1", F.explode("anchors").alias("x")).select("t1", "x.a", "x.twice")
    shared = (met.groupBy("a").agg(F.min("t1").alias("low"), F.max("t1").alias("high"), F.max("twice").alias("twice"))
              .where("low <> high OR twice").select("a"))
    mine = (met.select("t1", "a").distinct().join(shared, "a").groupBy("t1")
            .agg(F.collect_list("a").alias("shared")))
    same = F.col("x._id").eqNullSafe(F.col("y._id")) & (F.col("x.t1") == F.col("y.t1")) & (F.col("x.t2") == F.col("y.t2"))
    one = base.alias("x").join(texts.join(mine, "t1").alias("y"), same)
    # a row that repeats with its id adds to a weight that is 2 or more already
    places = staged(_passages(one.select("_t", "x.t1", "x.t2", "copies", "shared"), window, gram))

    distinct = staged(places.groupBy("a", "s1", "s2").agg(F.sum("copies").alias("weight"), F.first("words").alias("words")))
    many = distinct.groupBy("a").agg(F.count(F.lit(1)).alias("passages")).where(F.col("passages") > max_passages).select("a")
    packs = max(1, -(-distinct.count() // PASSAGES_PER_PACK))
    repeated = _by_automaton(distinct.join(many, "a", "left_anti"), packs, window).unionByName(
        _by_rows(distinct.join(many, "a", "left_semi"), window))
    found = places.where("copies = 1").join(repeated, ["a", "s1", "s2"]).select(
        "t1", "t2", F.expr("transform(ranges, r -> struct(r.start + start AS start, r.end + start AS end))").alias("r"))
    spans = found.groupBy("t1", "t2").agg(F.flatten(F.collect_list("r")).alias("ranges"))

    of_text = texts.select("t1", "t2", "copies").join(spans, ["t1", "t2"], "left")
    of_row = (rows.select("_id", "t1", "t2").distinct().join(of_text, ["t1", "t2"])
              .select("_id", "t1", "t2", (F.col("copies") > 1).alias("whole"), "ranges"))
    out = base.alias("x").join(of_row.alias("y"), same).select("x._id", "_t", "whole", "ranges")
    return _removed(out, window).withColumnRenamed("_id", id_col)
