"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Links documents whose sets of five-word shingles have a Jaccard similarity of
at least ``SIMILARITY`` and names each document's connected component.

A partner of a set of ``n`` shingles shares at least ``T = ceil(0.75 n)`` of
them, that is, occurs in at least T of its inverted lists.  In four steps:

1. Equal sets are one class (a 128-bit digest); only classes are searched.
2. Classes that no T-occurrence can reach are put aside: who has more than
   ``n - T`` shingles that no other class holds has no partner.  First over
   the shingles whose hash lies in the lowest ``SLICE`` of the hash range
   (the same shingles everywhere, so the counts over them are exact), then,
   for what is left, over all shingles.
3. The shingles of a class are ordered by the length of their lists; the
   ``n - T + 1`` shortest are its short lists, and partners meet in at least
   one list that is short for both.  Each short list is tied to its least
   class; the components of these ties are the search groups, which no link
   leaves.
4. Search groups are packed into tasks of bounded size.  In a task,
   T-occurrence search merges a query's short lists with a heap that skips
   what cannot reach T, probes its long lists by bisection for the classes met
   often enough (DivideSkip), and so counts every overlap exactly.  Lists are
   ordered by set size, so only the stretch of possible partners is read, and
   without the classes of the query's own component.  Classes that already are
   in the largest component of their group need no query of their own: a link
   between two components has an end outside the largest.  Groups above the
   bound are first linked with a few leaders, then cut by size and hash into
   blocks of queries (what the main leader does not link) and of indexed
   classes; a task searches one block of queries in one indexed block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import checked_small, map_columns, staged, texts_of
from tessera.llm.components import connected_components

WORDS = 5
PERCENT = 75
SLICE = 0.30
#: shingles of a block of one search group, and of the groups packed together
BLOCK_SHINGLES = 250_000
MAX_BROADCAST = 1_000_000
#: DivideSkip's weight of the heap against the probes
MU = 0.01
LEADERS = 16
#: words remembered by a task's hash table
VOCABULARY = 1_000_000

SET_FIELDS = "n long, d1 long, d2 long"


def shingler():
    """text -> sorted array of the distinct 64-bit hashes of its shingles."""
    import xxhash

    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    mul = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0x85EBCA77C2B2AE63], np.uint64)

    def mixed(h):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def of(text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: A-Z and the six blanks only
        if len(known) > VOCABULARY:
            known.clear()
        codes = []
        for w in words:
            c = known.get(w)
            if c is None:
                c = known[w] = digest(w)
            codes.append(c)
        codes = np.array(codes, np.uint64)
        if len(codes) < WORDS:
            if not len(codes):
                return codes
            h = np.array([len(codes)], np.uint64)
            for j in range(len(codes)):
                h = mixed((h + codes[j:j + 1]) * mul[j])
            return h
        m = len(codes) - WORDS + 1
        h = np.zeros(m, np.uint64)
        for j in range(WORDS):
            h = mixed((h + codes[j:j + m]) * mul[j])
        return np.unique(h)

    return of


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed integers; (0, 0) for the empty set."""
    import xxhash

    if not len(shingles):
        return 0, 0
    d = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return tuple(int(x) - (1 << 64) if x >> 63 else int(x) for x in (d >> 64, d & ((1 << 64) - 1)))


def _with_sets(docs: DataFrame, text_col: str, share: float | None) -> DataFrame:
    """``docs`` without its text, with n, d1, d2 and ``shingles`` (those in
    the lowest ``share`` of the hash range, or all)."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col]
                          + T.StructType.fromDDL(f"{SET_FIELDS}, shingles array<bigint>").fields)
    limit = None if share is None else np.uint64(int(share * 2 ** 64))

    def start():
        shingles_of = shingler()

        def f(batch):
            sets = [shingles_of(t) for t in texts_of(batch, text_col)]
            digests = [set_digest(s) for s in sets]
            kept = sets if limit is None else [s[:np.searchsorted(s, limit)] for s in sets]
            return {"n": [len(s) for s in sets], "d1": [d[0] for d in digests], "d2": [d[1] for d in digests],
                    "shingles": [s.view(np.int64) for s in kept]}

        return f

    return map_columns(docs, schema, start)


def _overlap(n):
    """Shingles that any partner of a set of ``n`` shares at least."""
    return F.ceil(n * PERCENT / 100).cast("long")


class Lists:
    """Inverted lists over sets, numbered by size: the sets whose size allows
    a link with a query are one stretch of every list.  Queries are the sets
    themselves, or ``queries``; ``shared`` counts the shingles of each indexed
    set that it can have in common with any of them."""

    def __init__(self, sets: list[np.ndarray], queries: list[np.ndarray] | None = None):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.order = np.argsort(self.sizes, kind="stable")       # number -> set
        self.ordered = self.sizes[self.order]
        number = np.empty(len(sets), np.int64)
        number[self.order] = np.arange(len(sets))
        tokens = np.concatenate(sets)
        owners = np.repeat(number, self.sizes)
        by = np.lexsort((owners, tokens))
        self.owners = owners[by]
        self.tokens, first = np.unique(tokens[by], return_index=True)
        self.bounds = np.append(first, len(tokens))
        if queries is None:
            met = np.diff(self.bounds) > 1
        else:
            met = np.isin(self.tokens, np.concatenate(queries))
        self.shared = np.bincount(self.owners[np.repeat(met, np.diff(self.bounds))], minlength=len(sets))
        self.alone = int(queries is None)     # entries of a list that only its query has

    def of(self, query: np.ndarray) -> list[tuple[int, int]]:
        """Places in ``owners`` of the query's lists that hold another set."""
        at = np.searchsorted(self.tokens, query)
        at = at[at < len(self.tokens)] if len(at) and at[-1] >= len(self.tokens) else at
        at = at[self.tokens[at] == query[:len(at)]]
        a, b = self.bounds[at], self.bounds[at + 1]
        held = b - a > self.alone
        return list(zip(a[held].tolist(), b[held].tolist()))


def least_overlap(a: int, b: int) -> int:
    """Shingles that linked sets of ``a`` and ``b`` shingles share at least."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def partners(lists: Lists, query: np.ndarray, wanted):
    """Numbers of the indexed sets linked with the query (DivideSkip).

    ``wanted()`` tells of each indexed set whether it matters; it is asked
    only where sizes allow partners at all.  Other sets leave the lists before
    these are merged.  The short lists are merged with a heap: a set on top
    fewer than ``need`` times cannot be a partner, nor can any before the
    ``need``-th head, to which the lists then skip.  What is met often enough
    is probed in the long lists by bisection, for as long as it can still
    reach the overlap that its size asks for.
    """
    from bisect import bisect_left
    from heapq import heapify, heappop, heappush

    n, places = len(query), lists.of(query)
    # 100 c >= 75 (n + b - c) with c <= len(places) bounds the partner's size b from above too
    most = min(n * 100 // PERCENT, len(places) * (100 + PERCENT) // PERCENT - n)
    lo = int(np.searchsorted(lists.ordered, -(-PERCENT * n // 100), "left"))
    hi = int(np.searchsorted(lists.ordered, most, "right"))
    if lo >= hi:
        return
    ok = wanted()
    ok &= (100 + PERCENT) * lists.shared >= PERCENT * (n + lists.ordered)
    ok[:lo] = ok[hi:] = False
    if not ok.any():
        return
    need = least_overlap(n, int(lists.ordered[lo]))
    stretch = [lists.owners[a:b] for a, b in places]
    stretch = sorted((o for o in (o[ok[o]].tolist() for o in stretch) if o), key=len)
    if len(stretch) < need:
        return
    n_long = min(need - 1, int(need / (MU * np.log2(len(stretch[-1]) + 1) + 1)))
    short, long_ = stretch[:len(stretch) - n_long], stretch[len(stretch) - n_long:]
    need -= n_long
    heap = [(o[0], i, 0) for i, o in enumerate(short)]
    heapify(heap)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap))
        shared = len(popped)
        if shared >= need:
            target, left = top + 1, n_long
            overlap = least_overlap(n, int(lists.ordered[top]))
            for o in long_:
                if shared + left < overlap:
                    break
                k = bisect_left(o, top)
                shared += k < len(o) and o[k] == top
                left -= 1
            if shared >= overlap:
                yield top
        else:
            while len(popped) < need - 1 and heap:
                popped.append(heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(short[i], target, at)
            if at < len(short[i]):
                heappush(heap, (short[i][at], i, at))


class Components:
    """Components of numbered members, with the label of each as an array."""

    def __init__(self, labels: np.ndarray):
        self.label = labels.copy()
        self.members: dict[int, list[int]] = {}
        for i, x in enumerate(self.label.tolist()):
            self.members.setdefault(x, []).append(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i].item(), self.label[j].item()
        if a != b:
            if len(self.members[a]) < len(self.members[b]):
                a, b = b, a
            moved = self.members.pop(b)
            self.label[moved] = a
            self.members[a] += moved


def _led(sets: list[np.ndarray]) -> Components:
    """Components by links with a few leaders: a cheap first pass.  A set
    without a link leads from then on, in place of a leader that no set has
    followed, if there are enough."""
    found, leaders = Components(np.arange(len(sets))), []     # [followers, index]
    for i, s in enumerate(sets):
        for lead in leaders:
            other = sets[lead[1]]
            small, large = sorted((len(s), len(other)))
            if 100 * small >= PERCENT * large and len(
                    np.intersect1d(s, other, assume_unique=True)) >= least_overlap(small, large):
                found.join(i, lead[1])
                lead[0] += 1
                break
        else:
            if len(leaders) == LEADERS:
                idle = next((x for x in leaders if not x[0]), None)
                if idle is None:
                    continue
                leaders.remove(idle)
            leaders.append([0, i])
        leaders.sort(key=lambda x: -x[0])
    return found


def search_group(sets: list[np.ndarray]) -> list[int]:
    """The component of each set, as the index of its first member.

    A link between two components has an end outside the largest one of the
    first pass, so its sets need no query of their own; nor do those that
    have joined it by the time it is their turn.
    """
    found = _led(sets)
    if len(found.members) > 1:
        main = max(found.members.values(), key=len)[0]
        lists = Lists(sets)
        for q, s in enumerate(sets):
            if found.label[q] == found.label[main]:
                continue
            for number in partners(lists, s, lambda: (found.label != found.label[q])[lists.order]):
                other = lists.order[number].item()
                if found.label[other] != found.label[q]:
                    found.join(q, other)
    first = {}
    return [first.setdefault(x, i) for i, x in enumerate(found.label.tolist())]


def search_blocks(queries: list[np.ndarray], query_ids: list[int], query_labels: list[int],
                  sets: list[np.ndarray], ids: list[int], labels: list[int], main: int):
    """(query, set) places of links between a block of queries and a block of
    indexed sets that join components; sets of one label are joined already.
    Two sets outside the label ``main`` are both queries somewhere: the one of
    the smaller id finds the link."""
    lists, n = Lists(sets, queries), len(queries)
    of, number = {}, []
    for x in [*query_labels, *labels]:        # label 0: alone
        number.append(len(of) + len(number) if not x else of.setdefault(x, -len(of) - 1))
    # the same set as query and as indexed is one member
    place = {i: k for k, i in enumerate(query_ids)}
    found = Components(np.array(number))
    for k, i in enumerate(ids):
        if i in place:
            found.join(place[i], n + k)
    id_of, free = np.array(ids)[lists.order], np.array(labels)[lists.order] != main
    for q, s in enumerate(queries):
        for k in partners(lists, s, lambda: (found.label[n:][lists.order] != found.label[q])
                          & ~(free & (id_of <= query_ids[q]))):
            other = lists.order[k].item()
            if found.label[n + other] != found.label[q]:
                found.join(q, n + other)
                yield q, other


def _search(rows: DataFrame) -> DataFrame:
    """(a, b) ties of classes from rows (pack, part, side, root, cid, label,
    main, shingles): packed whole groups (side 0), or a block of queries
    (side 1) beside a block of indexed sets (side 2)."""
    def arrays(g):
        return [np.asarray(s, np.int64).view(np.uint64) for s in g["shingles"]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        if pdf["side"].iloc[0] == 0:
            for _, g in pdf.groupby("root", sort=False):
                g = g.sort_values("cid")
                ids = g["cid"].tolist()
                for i, j in enumerate(search_group(arrays(g))):
                    if i != j:
                        a.append(ids[i])
                        b.append(ids[j])
        else:
            pdf = pdf.sort_values("cid")
            q, s = pdf[pdf["side"] == 1], pdf[pdf["side"] == 2]
            if len(q) and len(s):
                qi, si = q["cid"].tolist(), s["cid"].tolist()
                for i, j in search_blocks(arrays(q), qi, q["label"].tolist(), arrays(s), si, s["label"].tolist(),
                                          int(s["main"].iloc[0])):
                    a.append(qi[i])
                    b.append(si[j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return rows.groupBy("pack", "part").applyInPandas(run, "a long, b long")


def _overlaps(a, b):
    """Whether two arrays of shingles are linked."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def _blocks(large: DataFrame, block_shingles: int) -> tuple[DataFrame, DataFrame]:
    """(rows for :func:`_search`, ties with leaders) of groups above a block.

    Each group's first ``LEADERS`` classes by a hash lead it: a class takes
    the label of the first leader it is linked with, or 0.  The label most
    classes have is the group's main one; only classes outside it are queries.
    Classes of a group are dealt by size band (a linked set is in the same or
    the next band) and by hash into blocks, and every block of queries meets
    every indexed block of the three bands about its own.
    """
    by_hash = Window.partitionBy("root").orderBy(F.xxhash64("cid"), "cid")
    lead = (large.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= LEADERS)
            .groupBy("root").agg(F.sort_array(F.collect_list(F.struct("nth", "cid", "shingles"))).alias("lead")))
    linked = F.transform("lead", lambda x: _overlaps(x["shingles"], F.col("shingles")))
    label = F.array_position(linked, True)
    labelled = staged(large.join(lead, "root").withColumn("label", label).select(
        "root", "cid", "n", "shingles", "label", F.get("lead", (F.col("label") - 1).cast("int"))["cid"].alias("leader")))
    ties = labelled.where("label > 0 AND cid <> leader").select(F.col("cid").alias("a"), F.col("leader").alias("b"))

    main = (labelled.where("label > 0").groupBy("root", "label").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("root").agg(F.max_by("label", F.struct("k", -F.col("label"))).alias("main")))
    band = F.floor(F.log(F.col("n") * 1.0) / F.log(F.lit(100.0 / PERCENT)))
    member = labelled.join(main, "root", "left").select(
        "root", "cid", "label", F.coalesce("main", F.lit(-1)).alias("main"), "shingles", band.alias("band"), "n")
    asks = (F.col("label") == 0) | (F.col("label") != F.col("main"))
    layout = staged(member.groupBy("root", "band").agg(
        F.ceil(F.sum("n") / F.lit(block_shingles)).alias("indexed"),
        F.ceil(F.coalesce(F.sum(F.when(asks, F.col("n"))), F.lit(0)) / F.lit(block_shingles)).alias("queries")))
    near = F.explode(F.array(*[F.col("band") + j for j in (-1, 0, 1)])).alias("band")

    def copies(rows, side, own, other):
        """A row for each block of the other side that meets the row's block."""
        meets = (layout.select("root", F.col("band").alias("met"), F.col(other).alias("many"), near)
                 .where("many > 0").groupBy("root", "band").agg(F.collect_list(F.struct("met", "many")).alias("meets")))
        here = layout.select("root", "band", F.col(own).alias("blocks"))
        block = F.pmod(F.xxhash64("cid", F.lit(side)), F.col("blocks"))
        out = rows.join(here.join(meets, ["root", "band"]), ["root", "band"]).withColumn("block", block)
        out = out.select("*", F.explode("meets").alias("m")).select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m.many") - 1)).alias("o"))
        mine, its = F.struct("band", "block"), F.struct(F.col("m.met").alias("band"), F.col("o").alias("block"))
        q, i = (mine, its) if side == 1 else (its, mine)
        part = F.struct(q["band"].alias("a"), q["block"].alias("b"), i["band"].alias("c"), i["block"].alias("d"))
        return out.select(F.col("root").alias("pack"), part.alias("part"), F.lit(side).alias("side"), "root", "cid",
                          "label", "main", "shingles")

    return copies(member.where(asks), 1, "queries", "indexed").unionByName(copies(member, 2, "indexed", "queries")), ties


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, class_size.

    ``component_id`` is the least id reachable by links.  Null or empty texts
    have no shingles and stay alone.  Null ids are never a component's least
    id unless it has no other (then it is null).  Repeated rows are copies of
    one class.  Columns other than id and text are ignored.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    rows = staged(_with_sets(base, "_t", SLICE))

    # what has too many shingles of its own, over the slice
    held = rows.where("n > 0").select("d1", F.explode("shingles").alias("token"))
    own = (held.groupBy("token").agg(F.min("d1").alias("d1"), F.max("d1").alias("other")).where("d1 = other")
           .groupBy("d1").agg(F.count(F.lit(1)).alias("own")))
    classes = staged(rows.groupBy("d1", "d2", "n").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("class_size")))
    left = staged(classes.where("n > 0").join(own, "d1", "left").where(
        F.coalesce("own", F.lit(0)) <= F.col("n") - _overlap(F.col("n"))).select("least", "d1", "d2"))

    # the whole sets of what is left, one row per class
    wanted = checked_small(left.select(F.col("least").alias("_id")).distinct(), MAX_BROADCAST)
    sets = _with_sets(base.alias("x").join(wanted.alias("w"), F.col("x._id").eqNullSafe(F.col("w._id")), "left_semi"),
                      "_t", None)
    sets = sets.join(left.select("d1", "d2"), ["d1", "d2"], "left_semi").dropDuplicates(["d1", "d2"])
    sets = staged(sets.select(F.monotonically_increasing_id().alias("cid"), "n", "d1", "d2", "shingles"))

    # inverted lists: lengths, and the short lists of each class
    lists = sets.select("cid", F.explode("shingles").alias("token"))
    lengths = lists.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    shared = (lists.join(lengths, "token").groupBy("cid")
              .agg(F.sort_array(F.collect_list(F.struct("length", "token"))).alias("shared")))
    spare = F.col("n") - _overlap(F.col("n")) + 1 - (F.col("n") - F.size("shared"))
    short = staged(sets.select("cid", "n").join(shared, "cid").where(spare > 0)
                   .select("cid", F.explode(F.slice("shared", F.lit(1), spare.cast("int"))).alias("s"))
                   .select("cid", "s.token"))
    hubs = short.groupBy("token").agg(F.min("cid").alias("hub"))
    groups = staged(connected_components(short.join(hubs, "token").select(
        F.col("cid").alias("a"), F.col("hub").alias("b"))))

    # tasks: small groups packed, large ones as blocks of queries beside indexed blocks
    member = sets.join(groups, sets["cid"] == groups["node"]).select("cid", "root", "n", "shingles")
    size = staged(member.groupBy("root").agg(F.sum("n").alias("total")))
    large = size.where(F.col("total") > block_shingles)
    packs = max(1, -(-(size.agg(F.sum("total")).first()[0] or 0) // block_shingles))
    none = F.lit(0).cast("long")
    small = member.join(large, "root", "left_anti").select(
        (-1 - F.pmod(F.xxhash64("root"), F.lit(packs))).alias("pack"),
        F.struct(none.alias("a"), none.alias("b"), none.alias("c"), none.alias("d")).alias("part"),
        F.lit(0).alias("side"), "root", "cid", none.alias("label"), none.alias("main"), "shingles")
    if large.isEmpty():
        ties = _search(small)
    else:
        rows_of, led = _blocks(member.join(large, "root", "left_semi"), block_shingles)
        ties = _search(small).unionByName(_search(rows_of)).unionByName(led)
    links = staged(connected_components(staged(ties)))

    # components of classes, then of rows
    of_class = sets.select("cid", "d1", "d2").join(links.withColumnRenamed("node", "cid"), "cid").select("d1", "d2", "root")
    named = classes.join(of_class, ["d1", "d2"], "left")
    lowest = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    tied = named.join(lowest, "root").select("d1", "d2", "class_size", "component_id")
    alone = named.where("root IS NULL").select("d1", "d2", "class_size", F.col("least").alias("component_id"))
    return (rows.select("_id", "n", "d1", "d2").join(tied.unionByName(alone), ["d1", "d2"])
            .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "class_size"))
