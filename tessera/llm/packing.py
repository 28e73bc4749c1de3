"""Packing documents into training windows by lexical retrieval (BM25).

1. Every document is tokenised whole, the end id appended, and cut into
   pieces: whole windows of ``WINDOW`` ids, which are sequences of their own,
   and the rest, which is shorter.  The pieces are written once.
2. The BM25 statistics (pieces that hold each id, their mean length) are taken
   over all pieces.  The terms are token ids, so these statistics have at most
   one entry for each id of the vocabulary and may be broadcast.
3. The rests are dealt to index shards by their heaviest BM25 term, so that
   pieces with the same rare terms meet.  Terms with little text share a
   shard; one with more than ``SHARD_IDS`` ids (copies of one text may be a
   third of the corpus) is split over as many shards as it needs, by row
   number.  A shard's size thus does not grow with the corpus.
4. A task builds the inverted index of a shard.  The longest unused piece is
   the seed; the index returns the unused pieces by their score against the
   seed's ``QUERY_TERMS`` heaviest terms, and they fill the seed's window
   greedily: of the first ``NEIGHBOURS`` those that still fit, then a cut of
   the best that does not.  What is cut off stays in the index.  Windows are
   filled to the last id; only what is left at the end of a shard is cut into
   sequences of a power of two, which need no padding.

Token ids are those of the ``tokenizers`` file of the same vocabulary (the
tests compare both, for every code point); ``tiktoken`` reads the ranks file
because it is five times as fast.  The end-of-text string in a text is its
special id, as there.

Null text is the empty text: one piece with the end id.  Null and repeated ids
are fine, rows are told apart by a number given when the pieces are written;
other columns are ignored.  Every id lies in exactly one piece.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import staged, texts_of

WINDOW = 2048
END_ID = 1
SPECIAL = "<|endoftext|>"
SHARD_IDS = 1 << 19
QUERY_TERMS = 32
NEIGHBOURS = 64
K1, B = 1.2, 0.75


def ranks_path() -> str:
    """The installed ranks of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """(text -> numpy array of token ids, size of the vocabulary)."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f)}
    size = max(ranks.values()) + 2
    coder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={SPECIAL: size - 1})
    return lambda text: coder.encode_to_numpy(text, allowed_special="all"), size


def code_type(size: int) -> str:
    """How ids of a vocabulary are stored between the steps."""
    return "<u2" if size <= 1 << 16 else "<u4"


def pieces_of(docs: DataFrame, path: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """(id, start, length, doc_tokens, row, ids): the pieces of every
    document; ``row`` numbers them within the task that cut them."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(
        "start long, length int, doc_tokens long, row long, ids binary").fields])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, size = encoder(path)
        row, stored = TaskContext.get().partitionId() << 33, code_type(size)
        for batch in _slices(batches, 500):
            ids, texts = batch.column(batch.schema.get_field_index(id_col)), texts_of(batch, text_col)
            at, start, length, total, cut = [], [], [], [], []
            for i, text in enumerate(texts):
                codes = np.append(encode(text), END_ID).astype(stored)
                for s in range(0, len(codes), window):
                    part = codes[s:s + window]
                    at.append(i)
                    start.append(s)
                    cut.append(part.tobytes())
                    length.append(len(part))
                    total.append(len(codes))
            rows = np.arange(row, row + len(at))
            row += len(at)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())).cast(to_arrow_type(kind)), pa.array(start, pa.int64()),
                 pa.array(length, pa.int32()), pa.array(total, pa.int64()), pa.array(rows), pa.array(cut, pa.binary())],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _slices(batches, rows: int):
    """Arrow batches cut to at most ``rows`` rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _codes(column, stored: str) -> list[np.ndarray]:
    return [np.frombuffer(x, stored) for x in column.to_pylist()]


def bags(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, term, tf) of each distinct term of each piece, in that order,
    by one sort over all of them."""
    narrow = pieces[0].dtype.itemsize == 2 and len(pieces) <= 1 << 16
    kind, shift = (np.uint32, 16) if narrow else (np.uint64, 32)
    key = np.repeat(np.arange(len(pieces), dtype=kind) << kind(shift), [len(p) for p in pieces])
    key |= np.concatenate(pieces)
    key, tf = np.unique(key, return_counts=True)
    return (key >> shift).astype(np.int64), (key & ((1 << shift) - 1)).astype(np.int64), tf


def term_counts(pieces: DataFrame, size: int) -> tuple[np.ndarray, int, float]:
    """(pieces that hold each id, number of pieces, their mean length): at
    most one row for each id of the vocabulary reaches the driver."""
    stored = code_type(size)

    def run(batches):
        import pyarrow as pa

        held, n, total = np.zeros(size, np.int64), 0, 0
        for batch in _slices(batches, 2000):
            codes = _codes(batch.column(0), stored)
            held += np.bincount(bags(codes)[1], minlength=size)
            n += len(codes)
            total += sum(map(len, codes))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(held[at], [n, total]))],
                                         names=["term", "n"])

    rows = pieces.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    by = dict(zip(rows["term"].to_pylist(), rows["n"].to_pylist()))
    n, total = by.pop(-1, 0), by.pop(-2, 0)
    held = np.zeros(size, np.int64)
    held[list(by)] = list(by.values())
    return held, n, total / max(1, n)


def rarity(held: np.ndarray, n: int) -> np.ndarray:
    """BM25's inverse document frequency of each id."""
    return np.log1p((n - held + 0.5) / (held + 0.5))


def weighted_bags(pieces: list[np.ndarray], idf: np.ndarray, mean: float):
    """(piece, term, BM25 weight) of each distinct term of each piece."""
    owner, term, tf = bags(pieces)
    length = np.array([len(p) for p in pieces])[owner]
    return owner, term, idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def heaviest_terms(pieces: list[np.ndarray], idf: np.ndarray, mean: float) -> np.ndarray:
    """Each piece's term of largest weight, the smallest of equal ones."""
    owner, term, weight = weighted_bags(pieces, idf, mean)
    first = np.searchsorted(owner, np.arange(len(pieces)))
    top = np.flatnonzero(weight == np.maximum.reduceat(weight, first)[owner])
    return term[top[np.searchsorted(owner[top], np.arange(len(pieces)))]]


def _keyed(rests: DataFrame, stats, stored: str) -> DataFrame:
    """The rests with ``term``, their heaviest term."""
    schema = T.StructType([*rests.schema.fields, T.StructField("term", T.IntegerType())])
    at = rests.columns.index("ids")

    def run(batches):
        import pyarrow as pa

        idf, mean = stats.value
        for batch in _slices(batches, 2000):
            keys = heaviest_terms(_codes(batch.column(at), stored), idf, mean)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int32())], names=schema.names)

    return rests.mapInArrow(run, schema)


def shard_table(sizes: list[tuple[int, int]], shard_ids: int) -> list[tuple[int, int, int]]:
    """(term, first shard, shards) from the ids under each term: shards of
    some ``shard_ids``, small terms together, large ones split."""
    out, shard, room = [], 0, shard_ids
    for term, n in sorted(sizes):
        if n > shard_ids:
            if room < shard_ids:
                shard, room = shard + 1, shard_ids
            k = -(-n // shard_ids)
            out.append((term, shard, k))
            shard += k
            continue
        if n > room:
            shard, room = shard + 1, shard_ids
        out.append((term, shard, 1))
        room -= n
    return out


class ShardIndex:
    """Inverted lists of a shard's pieces, with BM25 weights."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        owner, term, weight = weighted_bags(pieces, idf, mean)
        by_term = np.argsort(term, kind="stable")
        self.owners, self.weights = owner[by_term], weight[by_term]
        known, first = np.unique(term[by_term], return_index=True)
        last = np.append(first[1:], len(term))
        heavy = np.lexsort((-weight, owner))
        begin = np.searchsorted(owner, np.arange(len(pieces) + 1))
        heavy = heavy[np.arange(len(heavy)) - begin[owner] < QUERY_TERMS]
        at = np.searchsorted(known, term[heavy])
        self.first, self.last = first[at], last[at]
        self.begin = np.searchsorted(owner[heavy], np.arange(len(pieces) + 1))

    def scores(self, piece: int) -> np.ndarray:
        """The BM25 score of every piece against one piece's heaviest terms."""
        lo, hi = self.begin[piece], self.begin[piece + 1]
        lists = [slice(a, b) for a, b in zip(self.first[lo:hi].tolist(), self.last[lo:hi].tolist())]
        return np.bincount(np.concatenate([self.owners[x] for x in lists]),
                           np.concatenate([self.weights[x] for x in lists]), len(self.begin) - 1)


def fill_windows(pieces: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW
                 ) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start, length) that hold every id of the pieces
    (each shorter than a window) once.  All are whole windows, but for the
    last ones, whose lengths are different powers of two."""
    index = ShardIndex(pieces, idf, mean)
    left = np.array([len(p) for p in pieces])       # ids not used yet, from the end of each piece
    begin = np.zeros(len(pieces), np.int64)
    out = []

    def take(sequence, i, n):
        sequence.append((int(i), int(begin[i]), int(n)))
        begin[i] += n
        left[i] -= n

    while left.any():
        seed, sequence = int(left.argmax()), []
        room = window - int(left[seed])
        take(sequence, seed, left[seed])
        score = None
        while room and left.any():
            if score is None:
                score = index.scores(seed)
            unused = np.flatnonzero(left)
            best = unused[np.argsort(-score[unused], kind="stable")[:NEIGHBOURS]]
            for i in best:
                if left[i] <= room:
                    room -= int(left[i])
                    take(sequence, i, left[i])
                    if not room:
                        break
            rest = best[left[best] > 0]
            if room and len(rest):
                take(sequence, rest[0], room)
                room = 0
        out.append(sequence)
    if out and (total := sum(n for _, _, n in out[-1])) & (total - 1):
        out += _powers(out.pop(), total)
    return out


def _powers(sequence: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """A short sequence cut into ones of a power of two."""
    out, parts = [], sequence[::-1]
    while total:
        need = size = 1 << (total.bit_length() - 1)
        out.append([])
        while need:
            i, s, n = parts.pop()
            k = min(n, need)
            out[-1].append((i, s, k))
            if k < n:
                parts.append((i, s + k, n - k))
            need -= k
        total -= size
    return out


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, shard_ids: int = SHARD_IDS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset
    and ``ids`` (little-endian unsigned 32-bit).

    ``start`` counts the document's ids before the piece, ``offset`` those of
    its sequence; the document's ids end with the end id.  Sequence ids are
    odd for sequences of a shard and even for windows of one document.
    """
    spark, path = docs.sparkSession, path or ranks_path()
    size = encoder(path)[1]
    pieces = staged(pieces_of(docs, path, window, id_col, text_col))
    held, n, mean = term_counts(pieces, size)
    stats = spark.sparkContext.broadcast((rarity(held, n), max(mean, 1.0)))

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(
        "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary").fields])
    stored = code_type(size)

    def widen(batches):
        import pyarrow as pa

        for batch in _slices(batches, 2000):
            ids = [c.astype("<u4").tobytes() for c in _codes(batch.column(6), stored)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(ids, pa.binary())], names=schema.names)

    whole = pieces.where(F.col("length") == window).select(
        F.col("id").alias(id_col), "start", F.col("length").cast("long").alias("length"), "doc_tokens",
        (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids").mapInArrow(widen, schema)

    rests = _keyed(pieces.where(F.col("length") < window), stats, stored)
    sizes = rests.groupBy("term").agg(F.sum("length").alias("n")).collect()     # a row for each term at most
    table = np.array(shard_table([(r["term"], r["n"]) for r in sizes], shard_ids), np.int64).reshape(-1, 3)
    shards = spark.createDataFrame(pd.DataFrame(table, columns=["term", "first", "shards"]),
                                   "term int, first long, shards long")
    dealt = rests.join(F.broadcast(shards), "term").withColumn(
        "shard", F.col("first") + F.pmod(F.xxhash64("row"), F.col("shards"))).drop("term", "first", "shards", "length")

    def run(table):
        import pyarrow as pa

        table = table.sort_by("row")
        shard = table["shard"][0].as_py()
        codes = _codes(table["ids"], stored)
        starts = table["start"].to_numpy()
        idf, mean = stats.value
        at, sequence, offset, begin, cut = [], [], [], [], []
        for k, parts in enumerate(fill_windows(codes, idf, mean, window)):
            o = 0
            for i, s, m in parts:
                at.append(i)
                sequence.append(((shard << 20) + k) * 2 + 1)
                offset.append(o)
                begin.append(int(starts[i]) + s)
                cut.append(codes[i][s:s + m].astype("<u4").tobytes())
                o += m
        length = pa.array([len(c) // 4 for c in cut], pa.int64())
        at = pa.array(at, pa.int64())
        return pa.table([table["id"].take(at), pa.array(begin, pa.int64()), length, table["doc_tokens"].take(at),
                         pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array(cut, pa.binary())],
                        names=schema.names)

    return whole.unionByName(dealt.groupBy("shard").applyInArrow(run, schema))
