"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

State of the index, three tables:

* ``refs`` -- exact: one row (key, doc, n) for each line key and document
  holding it, ``n`` times.  The key is the 128-bit MD5 of the stripped,
  lower-cased line; lines under ``MIN_CHARS`` code points have none.
* ``repeated`` -- exact: (key, docs, owner) of the keys that at least two
  documents hold; the owner is the smallest of them.
* ``filters`` -- one cuckoo filter a shard (a hash of the key) over those keys.

``add`` and ``remove`` change them: new references are added or removed
exactly, and the keys that thereby become (or cease to be) repeated are
inserted into (or deleted from) the filter of their shard, so any document
can be taken out again and the index is what it would have been without it.
Null ids count as one document that comes after all others.

When lines are dropped, a document's keys first probe the filter of their
shard; only keys that may be repeated meet the exact table, which decides.  A
line whose key a third of all documents hold is counted map-side, and the
exact table has one row for it.  The references of a shard are probed in
pieces of some ``PIECE_ROWS`` rows, cut by document: a shard with such a line
has as many more pieces as its references need, each with a copy of the
filter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (
    BLANKS, MAX_LONG, ascii_lower, checked_small, map_columns, staged, text_or_empty, texts_of)

MIN_CHARS = 10
SLOTS = 4
KICKS = 500
KEYS_PER_SHARD = 100_000
#: references that probe one copy of a filter
PIECE_ROWS = 12_500
#: a table of hot shards of up to so many rows (16 bytes each) is broadcast
MAX_BROADCAST = 1_000_000


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key's two buckets are
    ``h & mask`` and that XOR a hash of its fingerprint.  Holds one copy of
    a fingerprint for each inserted key, so that ``delete`` is exact for keys
    that were inserted.  It doubles when an insertion finds no place, which
    needs the keys again: ``insert`` then raises ``OverflowError``."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8))))))

    @classmethod
    def of(cls, hashes: np.ndarray) -> "CuckooFilter":
        """Filter over all ``hashes``, doubled until they fit."""
        out = cls.sized(len(hashes))
        while True:
            try:
                out.insert(hashes)
                return out
            except OverflowError:
                out = cls(2 * len(out.table))

    @classmethod
    def from_bytes(cls, raw: bytes) -> "CuckooFilter":
        table = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray):
        h = hashes.astype(np.uint64, copy=False)
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = h & self.mask
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_):
        mixed = np.asarray(print_, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(20)) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        p, a, b = self._places(hashes)
        return ((self.table[a] == p[:, None]) | (self.table[b] == p[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray) -> None:
        prints, first, second = self._places(hashes)
        t = self.table
        for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            for kick in range(KICKS):
                for row in (a, b):
                    free = np.flatnonzero(t[row] == 0)
                    if len(free):
                        t[row, free[0]] = p
                        break
                else:
                    slot = kick % SLOTS
                    p, t[b, slot] = int(t[b, slot]), p
                    a = b
                    b = int(np.uint64(b) ^ self._jump(np.uint16(p)))
                    continue
                break
            else:
                raise OverflowError("cuckoo filter is full")

    def delete(self, hashes: np.ndarray) -> None:
        prints, first, second = self._places(hashes)
        for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            for row in (a, b):
                at = np.flatnonzero(self.table[row] == p)
                if len(at):
                    self.table[row, at[0]] = 0
                    break


@dataclass
class LineIndex:
    refs: DataFrame      # key binary, doc long, n long
    repeated: DataFrame  # key binary, docs long, owner long: of the keys two or more documents hold
    filters: DataFrame   # shard long, filter binary
    shards: int


def line_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, doc): a row for each line that has a key."""
    line = ascii_lower(F.btrim(F.col("_line"), F.lit(BLANKS)))
    return (docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)).alias("doc"),
                        F.explode(F.split(text_or_empty(text_col), "\n")).alias("_line"))
            .select("doc", line.alias("_line")).where(F.length("_line") >= MIN_CHARS)
            .select(F.unhex(F.md5(F.col("_line").cast("binary"))).alias("key"), "doc"))


def _hash(key):
    """The filters' 64-bit hash of a key: its first eight bytes."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def _repeated(refs: DataFrame) -> DataFrame:
    """(key, docs, owner) of the keys that two or more documents hold."""
    return (refs.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("owner"))
            .where("docs >= 2"))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    h = _hash(F.col("key"))
    return keys.select("*", h.alias("h")).withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))


def _filters(repeated: DataFrame, shards: int) -> DataFrame:
    return _rebuild(_sharded(repeated.select("key"), shards).select("shard", "h"))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          keys_per_shard: int = KEYS_PER_SHARD) -> LineIndex:
    """Index of a documents table."""
    refs = staged(line_keys(docs, id_col, text_col).groupBy("key", "doc").agg(F.count(F.lit(1)).alias("n")))
    shards = max(1, -(-refs.count() // keys_per_shard))
    repeated = staged(_repeated(refs))
    return LineIndex(refs, repeated, staged(_filters(repeated, shards)), shards)


def _changed(index: LineIndex, refs: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with new references: keys of ``touched`` whose repeatedness
    differs go into or out of the filter of their shard."""
    repeated = staged(index.repeated.join(touched, "key", "left_anti").unionByName(
        _repeated(refs.join(touched, "key", "left_semi"))))
    before = index.repeated.join(touched, "key", "left_semi").select("key", F.lit(True).alias("was"))
    after = repeated.join(touched, "key", "left_semi").select("key", F.lit(True).alias("is"))
    moves = _sharded(before.join(after, "key", "full").where("was IS NULL OR is IS NULL"), index.shards).select(
        "shard", "h", F.col("is").isNotNull().alias("add"))
    keys = _sharded(repeated.select("key"), index.shards).select("shard", "h")

    def update(_, old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
        kept = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(0)
        h, add = change["h"].to_numpy().view(np.uint64), change["add"].to_numpy(bool)
        kept.delete(h[~add])
        shard = int((old if len(old) else change)["shard"].iloc[0])
        try:
            kept.insert(h[add])
            raw = kept.to_bytes()
        except OverflowError:
            raw = None  # rebuilt below from the exact table
        return pd.DataFrame({"shard": [shard], "filter": [raw]})

    out = staged(index.filters.groupBy("shard").cogroup(moves.groupBy("shard"))
                 .applyInPandas(update, "shard long, filter binary"))
    full = out.where("filter IS NULL").select("shard")
    rebuilt = _rebuild(keys.join(full, "shard", "left_semi")) if full.limit(1).count() else None
    out = out.where("filter IS NOT NULL")
    return LineIndex(refs, repeated, staged(out if rebuilt is None else out.unionByName(rebuilt)), index.shards)


def _rebuild(keys: DataFrame) -> DataFrame:
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(pdf["h"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "filter": [made.to_bytes()]})

    return keys.groupBy("shard").applyInPandas(build, "shard long, filter binary")


def add(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """The index with the lines of new documents."""
    new = staged(line_keys(docs, id_col, text_col).groupBy("key", "doc").agg(F.count(F.lit(1)).alias("n")))
    refs = staged(index.refs.unionByName(new).groupBy("key", "doc").agg(F.sum("n").alias("n")))
    return _changed(index, refs, new.select("key").distinct())


def remove(index: LineIndex, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without the documents in ``ids``: what was never added and
    what was removed cannot be told apart."""
    gone = ids.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)).alias("doc")).distinct()
    touched = index.refs.join(gone, "doc", "left_semi").select("key").distinct()
    return _changed(index, staged(index.refs.join(gone, "doc", "left_anti")), touched)


def _pieces(index: LineIndex, piece_rows: int) -> tuple[int, DataFrame]:
    """Pieces of an even shard, and (shard, pieces) of the hot ones: the
    shards whose repeated keys alone have more references than that."""
    even = max(1, -(-index.refs.count() // (index.shards * piece_rows)))
    held = _sharded(index.repeated, index.shards).groupBy("shard").agg(F.sum("docs").alias("held"))
    hot = staged(held.where(F.col("held") > even * piece_rows).select(
        "shard", (F.ceil(F.col("held") / F.lit(piece_rows)) + even).cast("long").alias("pieces")))
    return even, checked_small(hot, MAX_BROADCAST)


def lost_keys(index: LineIndex, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(doc, key): the keys whose lines a document loses, because another
    document with a smaller id holds them too."""
    even, hot = _pieces(index, piece_rows)
    pieces = F.coalesce("pieces", F.lit(even).cast("long"))
    refs = (_sharded(index.refs.select("key", "doc"), index.shards).join(hot, "shard", "left")
            .withColumn("piece", F.pmod(F.xxhash64("doc"), pieces)).drop("pieces"))
    filters = index.filters.join(hot, "shard", "left").select(
        "shard", "filter", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))

    def probe(_, lines: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(lines):
            return lines.iloc[:0][["key", "doc"]]
        maybe = CuckooFilter.from_bytes(held["filter"].iloc[0]).contains(lines["h"].to_numpy().view(np.uint64))
        return lines.loc[maybe, ["key", "doc"]]

    maybe = (refs.groupBy("shard", "piece").cogroup(filters.groupBy("shard", "piece"))
             .applyInPandas(probe, "key binary, doc long"))
    return maybe.join(index.repeated, "key").where("doc <> owner").select("doc", "key")


def dedup_lines(docs: DataFrame, index: LineIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rid of repeated lines, and two columns more:
    ``n_lines`` (before) and ``n_dropped``.  All rows and columns are kept.

    Null or empty text is one empty line and becomes an empty text.  Rows
    that share an id, or have none, are one document to the index, and each
    loses its lines; a row meets only the keys it holds itself, however many
    the document loses.  Columns of the input named ``n_lines`` or
    ``n_dropped`` are replaced.
    """
    index = index or build(docs, id_col, text_col)
    base = docs.drop("n_lines", "n_dropped", "_lost", "_doc", "_row")
    rows = base.withColumn("_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_LONG)))
    lost = lost_keys(index).withColumnRenamed("doc", "_doc")
    shared = staged(rows.groupBy("_doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_doc"))
    by = ["_doc"]
    if shared.isEmpty():
        lost = lost.groupBy("_doc").agg(F.collect_list("key").alias("_lost"))
    else:
        by, lost = ["_doc", "_row"], staged(lost)
        shared = checked_small(shared, MAX_BROADCAST)
        rows = rows.join(shared.withColumn("_shared", F.lit(True)), "_doc", "left").withColumn(
            "_row", F.when(F.col("_shared"), F.xxhash64(text_col)).otherwise(F.lit(0))).drop("_shared")
        texts = rows.where("_row <> 0").select("_doc", "_row", F.col(text_col).alias("_text")).groupBy("_doc", "_row").agg(
            F.first("_text").alias("_text"))
        own = line_keys(texts.groupBy("_row").agg(F.first("_text").alias("_text")), "_row", "_text").distinct()
        own = texts.select("_doc", "_row").join(own.withColumnRenamed("doc", "_row"), "_row")
        lost = (lost.join(shared, "_doc", "left_anti").withColumn("_row", F.lit(0).cast("long")).select("_doc", "_row", "key")
                .unionByName(own.join(lost, ["_doc", "key"]).select("_doc", "_row", "key"))
                .groupBy("_doc", "_row").agg(F.collect_list("key").alias("_lost")))
    rows = rows.join(lost, by, "left").drop("_doc", "_row")
    schema = base.withColumns({text_col: F.lit("").cast("string"), "n_lines": F.lit(0).cast("long"),
                               "n_dropped": F.lit(0).cast("long")}).schema
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    blanks, least = BLANKS.encode(), MIN_CHARS

    def start():
        def f(batch):
            texts, before, gone = [], [], []
            lost_of = batch.column(batch.schema.get_field_index("_lost")).to_pylist()
            for text, lost_here in zip(texts_of(batch, text_col), lost_of):
                lines = kept = text.split("\n")
                if lost_here:
                    bad, kept = set(lost_here), []
                    for line in lines:
                        raw = line.encode().strip(blanks).translate(lower)
                        if len(raw) < least or hashlib.md5(raw).digest() not in bad:
                            kept.append(line)
                texts.append("\n".join(kept))
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
            return {text_col: texts, "n_lines": before, "n_dropped": gone}

        return f

    return map_columns(rows, schema, start)
