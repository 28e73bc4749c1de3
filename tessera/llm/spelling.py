"""Spelling variant grouping by finite-state composition.

Words one edit apart are found by composing three machines: the minimised
acceptor of the vocabulary, a transducer that makes exactly one edit (replace
or insert a code point), and the acceptor again.  The composed machine is
never built whole.  Its accepted pairs are enumerated for each set of words
that meet in one initial state:

1. A pair is told by the length ``m`` of its shorter word and by the place of
   its edit, the length of the two words' common prefix.  That place lies in
   an interval: halving the interval, a pair either shares the code points
   before its middle (then both words pass through one state behind that
   prefix) or those behind it (one state before that suffix).  A word
   therefore belongs to two sets for each ``m`` of its length and one less,
   keyed by the shared code points.
2. Sets of one word are dropped.  Sets above ``GROUP_WORDS`` words, or open
   over more than ``OPEN_LENGTH`` code points, are halved again, until the
   open part is one code point; such a set holds at most one word for each
   two code points of the alphabet.  No set grows with the corpus.
3. The sets, sorted by key, stream through ``mapInPandas``.  For each, both
   acceptors (words of length m and m + 1) are built from the sorted open
   parts with one register of states, so that equal right languages are one
   state, and the composition is walked from their initial states: common
   prefix, one edit whose next code points differ (so a pair has one path
   only), common suffix, memoised by pairs of states.

Every pair appears in exactly one set, once.

Texts and ids: null text holds no run; a null id is written ``null`` where the
rule that deletes code points reads it.  Repeated rows count again.  Other
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import ascii_lower, staged, text_or_empty

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10
DELETE_MOD = 31
RUN = r"[A-Za-zÀ-ÿ]{%d,}"
#: words of a set that one task composes at once
GROUP_WORDS = 20_000
#: code points of the part of a set's words in which the edit may lie
OPEN_LENGTH = 64

FOUND = "word string, near long, best_n long, best string"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all documents with their occurrences.

    Maximal letter runs, A-Z lower-cased; of a run whose crc32 of
    ``<id>:<run>`` is divisible by 31 the code point crc32 mod length is
    deleted; at least 7 code points and 2 occurrences.
    """
    run, h = F.col("run"), F.col("h")
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.explode(
        F.regexp_extract_all(text_or_empty(text_col), F.lit(RUN % MIN_LENGTH), F.lit(0))).alias("run"))
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    return (hashed.select(F.when(h % DELETE_MOD == 0, cut).otherwise(run).alias("word"))
            .where(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT))


class Acceptors:
    """Minimal acyclic acceptors that share their states: a state is known by
    what follows it, so equal right languages are one number."""

    def __init__(self):
        self.register: dict = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.common: dict[tuple[int, int], list[str]] = {}
        self.replaced: dict[int, list[tuple[str, str]]] = {}
        self.inserted: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, *arcs)
        s = self.register.get(key)
        if s is None:
            s = self.register[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
        return s

    def build(self, words: list[str]) -> int:
        """The initial state of the acceptor of sorted distinct words."""
        path: list[list] = [[False, []]]  # of the last word: [final, arcs] of each open state
        last = ""
        for w in [*words, None]:
            keep = 0
            if w is not None:
                top = min(len(w), len(last))
                while keep < top and w[keep] == last[keep]:
                    keep += 1
            while len(path) > keep + 1:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], self.state(final, arcs)))
            if w is not None:
                path.extend([False, []] for _ in w[keep:])
                path[-1][0] = True
                last = w
        return self.state(path[0][0], path[0][1])

    def both(self, p: int, q: int) -> list[str]:
        """What both states accept."""
        if p > q:
            p, q = q, p
        out = self.common.get((p, q))
        if out is None:
            out = [""] if self.final[p] and self.final[q] else []
            a, b = self.arcs[p], self.arcs[q]
            if len(a) > len(b):
                a, b = b, a
            for c, s in a.items():
                t = b.get(c)
                if t is not None:
                    out += [c + x for x in self.both(s, t)]
            self.common[(p, q)] = out
        return out

    def replace(self, p: int) -> list[tuple[str, str]]:
        """Pairs accepted from ``p`` and ``p`` whose first code points are replaced."""
        out = self.replaced.get(p)
        if out is None:
            arcs = list(self.arcs[p].items())
            out = self.replaced[p] = [(x + s, y + s) for i, (x, a) in enumerate(arcs) for y, b in arcs[:i]
                                      for s in self.both(a, b)]
        return out

    def insert(self, p: int, q: int) -> list[tuple[str, str]]:
        """Pairs accepted from ``p`` and ``q`` with a code point inserted
        before the first, and unequal to it."""
        out = self.inserted.get((p, q))
        if out is None:
            out = []
            for y, b in self.arcs[q].items():
                if self.final[p] and self.final[b]:
                    out.append(("", y))
                for c, a in self.arcs[p].items():
                    if c != y and c in self.arcs[b]:
                        out += [(c + s, y + c + s) for s in self.both(a, self.arcs[b][c])]
            self.inserted[(p, q)] = out
        return out

    def pairs(self, p: int | None, q: int | None, places: int):
        """(u, v) of the composition from the initial states: ``p`` of the
        shorter words and ``q`` of the longer ones, with the edit at one of
        the first ``places`` places."""
        open_ = [("", p, q)]
        while open_:
            before, p, q = open_.pop()
            for u, v in self.replace(p):
                yield before + u, before + v
            if q is not None:
                for u, v in self.insert(p, q):
                    yield before + u, before + v
            if len(before) + 1 < places:
                longer = self.arcs[q] if q is not None else {}
                open_ += [(before + c, s, longer.get(c)) for c, s in self.arcs[p].items()]


def near_words(words: list[str], m: int, lo: int, tail: int):
    """(i, j) of words of one set (distinct, of length m or m + 1, alike
    before ``lo`` and in the last ``tail`` code points) that are one edit
    apart, with the edit in the set's interval."""
    at = {w[lo:len(w) - tail]: i for i, w in enumerate(words) if len(w) == m}
    more = {w[lo:len(w) - tail]: i for i, w in enumerate(words) if len(w) > m}
    machine = Acceptors()
    p = machine.build(sorted(at))
    q = machine.build(sorted(more)) if more else None
    for u, v in machine.pairs(p, q, m - lo - tail + (tail == 0)):
        yield at[u], at[v] if len(u) == len(v) else more[v]


KEY = ["m", "lo", "tail", "shared"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, tail) with the code points their set shares."""
    w = F.col("word")
    shared = F.concat(F.substring(w, F.lit(1), F.col("lo")), F.substring(w, F.length(w) - F.col("tail") + 1, F.col("tail")))
    return rows.select("word", "n", "m", "lo", "tail", shared.alias("shared"))


def _halved(rows: DataFrame) -> DataFrame:
    """Both halves of each set, as keyed rows."""
    o = F.col("m") - F.col("lo") - F.col("tail")
    h = F.floor(o / 2).cast("int")
    sides = F.array(F.struct((F.col("lo") + h).alias("lo"), F.col("tail").alias("tail")),
                    F.struct(F.col("lo").alias("lo"), (F.col("tail") + o - h).alias("tail")))
    return _keyed(rows.select("word", "n", "m", F.explode(sides).alias("s")).select("word", "n", "m", "s.lo", "s.tail"))


def _compose(sets: DataFrame) -> DataFrame:
    """(word, near, best_n, best) of each word of the sets that has near words
    there, from rows that are sorted by set within their partitions."""
    def found(g: list) -> list:
        m, lo, tail = g[0][:3]
        words, ns = [r[4] for r in g], [r[5] for r in g]
        count, best = [0] * len(g), [None] * len(g)
        for i, j in near_words(words, m, lo, tail):
            for a, b in ((i, j), (j, i)):
                count[a] += 1
                k = (-ns[b], words[b])
                if best[a] is None or k < best[a]:
                    best[a] = k
        return [(w, c, -b[0], b[1]) for w, c, b in zip(words, count, best) if c]

    def run(frames):
        group, key, out = [], None, []
        for pdf in frames:
            for r in pdf.itertuples(index=False, name=None):
                if r[:4] != key:
                    if group:
                        out += found(group)
                    group, key = [], r[:4]
                group.append(r)
            yield pd.DataFrame(out, columns=["word", "near", "best_n", "best"])
            out = []
        if group:
            yield pd.DataFrame(found(group), columns=["word", "near", "best_n", "best"])

    return sets.select(*KEY, "word", "n").mapInPandas(run, FOUND)


def near_table(words: DataFrame, group_words: int = GROUP_WORDS, open_length: int = OPEN_LENGTH) -> DataFrame:
    """(word, n_near, form_n, form): for each of ``words`` (word, n) that has
    near words their number, and the one of largest n (then the smallest)."""
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).select(
        "*", F.lit(0).alias("lo"), F.lit(0).alias("tail"))
    parts = None
    while True:
        rows = _halved(rows)
        size = (rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("size"), F.min(F.length("word")).alias("least"))
                .where("size > 1 AND least = m").drop("least"))
        o = F.col("m") - F.col("lo") - F.col("tail")
        done = (o == 1) | (F.col("size") <= group_words) & (o <= open_length)
        rows = staged(rows.join(size, KEY).select(*KEY, "word", "n", done.alias("done")))
        part = rows.where("done")
        parts = part if parts is None else parts.unionByName(part)
        rows = rows.where("NOT done")
        if rows.isEmpty():
            break
    near = _compose(parts.repartition(*KEY).sortWithinPartitions(*KEY))
    return (near.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.w").alias("form")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), by doubling the steps taken.
    A step multiplies n by 10 at least, so few rounds reach all ends."""
    rows = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not rows.where("moved").isEmpty():
        ahead = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        rows = staged(rows.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return rows.select("word", "root")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    group_words: int = GROUP_WORDS, open_length: int = OPEN_LENGTH) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one code point inserted, deleted or replaced)
    of largest n, ties to the smallest in code-point order, where its n is at
    least 10 times the word's; ``root`` follows forms to the last.  A group of
    spelling variants is the words of one root.
    """
    words = staged(vocabulary(docs, id_col, text_col))
    near = near_table(words, group_words, open_length)
    big = F.col("form_n") >= FORM_FACTOR * F.col("n")
    named = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast(T.LongType())).alias("n_near"),
        F.when(big, F.col("form")).alias("form"), F.when(big, F.col("form_n")).alias("form_n")))
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
