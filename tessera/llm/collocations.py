"""Phrase collocation mining by Toivonen's sampling.

Phrases are runs of 1 to ``LONGEST`` words within the pieces of a text, and
all counts are kept by language.  A phrase is frequent with at least
``MIN_COUNT`` occurrences.

1. A sample (``SHARE`` of the rows, by a hash) is mined level by level at the
   lowered threshold ``SAMPLE_COUNT``: it proposes the phrases of up to three
   words that may be frequent.  The proposals are kept as bits of a filter of
   ``FILTER_BITS``, which is all that is broadcast: a false positive proposes
   a phrase more, and a fuller filter costs counting, never a phrase.
2. One full pass counts all words, the proposals and their negative border:
   the phrases that are not proposed though the phrases without their last and
   without their first word are.  Both are told while reading, by the filter,
   so the border is never written out beyond what occurs.  As most of the
   border is rare, this pass counts by hashes of ``HASH_BITS``; a hash that two phrases
   share can only raise a count, and what reaches ``MIN_COUNT`` is counted
   again.
3. What reached it outside the proposals is a border failure.  The expansion
   pass counts, by the words themselves, all that reached it, and along with
   it all that was not counted before and may be frequent: phrases whose parts
   reached it or are counted in this pass for the first time too.  As it does
   not wait for the counts of such parts, one such pass closes the search:
   every part of a frequent phrase is frequent, so it reached the count, or is
   counted along.  These counts are the result.

A task counts some ``CHUNK_WORDS`` words at a time with numpy.  Words have
numbers within the chunk, and in the last pass a phrase is known by the
numbers of its words, so no hash stands for a phrase in any result.  Counts of
a chunk are added up by Spark, with partial aggregation; a hot phrase is one
row a chunk.

Null text counts as empty, null language as ``und``.  Null ids and repeated
rows count like any other row.  Other columns are ignored.  An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

LONGEST = 4
MIN_COUNT = 30
SHARE = 10             # one of so many rows is in the sample
SAMPLE_COUNT = 2
FILTER_BITS = 1 << 26
HASH_BITS = 40         # of a phrase's hash are counted by and known to a filter
SHIFTS = (0, 18, 37)   # the filter's three places of a hash, once more mixed
CHUNK_WORDS = 500_000
ROWS = 50_000          # of an emitted batch
MERGED = 500_000     # hashes of a task that are added up before they are sent
BUCKET_WORDS = 500_000 # words of the corpus for each bucket of hashes
#: fewer, and the rest of a hash would not fit 32 bits; more, and a task would
#: send rows of only a few hashes
LEAST_BUCKET_BITS, MOST_BUCKET_BITS = HASH_BITS - 32, 18
SCALE = 2_000_000      # of the score
PART_NUM, PART_DEN = 80, 100
TOP = 2000

#: A-Z lower-cased, tab a blank, every end of a piece a full stop
_FOLD = bytes(32 if b == 9 else 46 if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers(dict):
    """Words (bytes) of one language, numbered as they come in lists that all
    languages of a chunk share; 0 is the end of a piece."""

    def __init__(self, lang: int, words: list[bytes], langs: list[int]):
        super().__init__({b".": 0})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return n


class _Chunk:
    """The words of some documents, as numbers, until they are counted."""

    def __init__(self):
        self.words, self.langs, self.numbers, self.ids, self.size = [b"."], [0], {}, [], 0

    def add(self, lang: str, text: str) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(len(self.numbers), self.words, self.langs)
        words = text.encode().translate(_FOLD).replace(b".", b" . ").split()
        self.ids.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.ids.append(np.zeros(1, np.int64))
        self.size += len(words)

    def places(self) -> np.ndarray:
        """The word number at each place, 0 between pieces and at the end."""
        return np.concatenate([*self.ids, np.zeros(1, np.int64)])


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _lang_hash(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\0" + lang)


def _places(kept: np.ndarray, size: int):
    """The filter's places of hashes cut to ``HASH_BITS``."""
    h = _mixed(kept * _ODD)
    for s in SHIFTS:
        yield (h >> np.uint64(s)) & np.uint64(size - 1)


def _holds(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter (64-bit slots, or none: nothing) holds."""
    out = np.full(len(h), bits is not None)
    if bits is not None:
        for at in _places(h >> np.uint64(64 - HASH_BITS), len(bits) * 64):
            out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def distinct_rows(columns: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below 2 ** bits, and how often
    each occurs.  Numbers are packed side by side into 63 bits; where they do
    not fit, what is packed so far is replaced by its rank."""
    code, width, ranks = columns[0], bits, []
    for c in columns[1:]:
        rank = None
        if width + bits > 63:
            rank, code = np.unique(code, return_inverse=True)
            width = len(rank).bit_length()
        ranks.append(rank)
        code, width = code << bits | c, width + bits
    code, n = np.unique(code, return_counts=True)
    out = []
    for rank in reversed(ranks):
        out.append(code & ((1 << bits) - 1))
        code = code >> bits
        if rank is not None:
            code = rank[code]
    return [code, *reversed(out)], n


def chunk_counts(chunk: _Chunk, bits: np.ndarray | None, done: np.ndarray | None, levels: tuple[int, ...]):
    """(k, places, hashes) of a chunk's phrases of k words that count, for
    each k of ``levels``; a phrase is told by the place of its first word.

    Without ``done`` all words count, and longer phrases of which the filter
    ``bits`` holds both parts of one word less.  ``done`` is the filter of such
    a pass and ``bits`` now holds what proved frequent there: that counts, and
    what the pass did not count if each part is in ``bits`` or counts likewise.
    """
    import xxhash

    ids = chunk.places()
    word = np.array([xxhash.xxh64_intdigest(w) for w in chunk.words], np.uint64)
    lang = np.array([_lang_hash(x) for x in chunk.numbers], np.uint64)
    one = _mixed(lang[chunk.langs] * _ODD + word)        # hash of each word as a phrase
    held, before = _holds(bits, one), _holds(done, one)
    held[0] = before[0] = False       # the end of a piece is no word
    at = np.flatnonzero(ids)
    hashes, proposed, counted = one[ids[at]], held[ids], before[ids]
    if 1 in levels:
        wanted = slice(None) if done is None else proposed[at]
        yield 1, at[wanted], hashes[wanted]
    for k in range(2, max(levels) + 1):
        both = proposed[at] & proposed[at + 1]
        at, hashes = at[both], hashes[both]
        hashes = _mixed(hashes * _ODD + word[ids[at + k - 1]])
        held, wanted = _holds(bits, hashes), slice(None)
        if done is not None:
            fresh = ~(counted[at] & counted[at + 1])
            wanted = held = held | fresh
            counted = np.zeros(len(ids), bool)
            counted[at] = _holds(done, hashes) & ~fresh
        if k in levels:
            yield k, at[wanted], hashes[wanted]
        if k < max(levels):
            proposed = np.zeros(len(ids), bool)
            proposed[at] = held


def _chunks(batches, chunk_words: int):
    """Chunks of the Arrow batches (lang, text)."""
    chunk = _Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            chunk.add(lang.as_py(), text.as_py())
            if chunk.size >= chunk_words:
                yield chunk
                chunk = _Chunk()
    if chunk.ids:
        yield chunk


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of some (hashes, counts), with the sums."""
    h, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[:len(h)])
    return h[first], np.add.reduceat(n, first) if len(h) else n


def hash_counts(docs: DataFrame, bits=None, levels: tuple[int, ...] = (1, 2, 3, 4), chunk_words: int = CHUNK_WORDS,
                least: int = 1, bucket_bits: int = LEAST_BUCKET_BITS) -> DataFrame:
    """(hash, n) of the phrases of ``docs`` (lang, text) that count with the
    broadcast filter ``bits`` and do so at least ``least`` times.

    A task adds up its chunks itself.  What it sends is dealt by the first
    ``bucket_bits`` of the hashes: a row for each bucket with the rest of its
    hashes and their counts, 4 bytes each, side by side.  A bucket is added up
    by one task, some ``MERGED`` entries at a time; the number of buckets grows
    with the corpus.
    """
    rest = HASH_BITS - bucket_bits

    def run(batches):
        import pyarrow as pa

        def rows(parts):
            h, n = _added(parts)
            # a count that does not fit is sent in parts
            while len(h):
                bucket = (h >> np.uint64(rest)).astype(np.int64)
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                low, small = (h & np.uint64((1 << rest) - 1)).astype("<u4"), np.minimum(n, 0xFFFFFFFF).astype("<u4")
                ends = [*first[1:].tolist(), len(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[first]), *[pa.array([c[a:b].tobytes() for a, b in zip(first.tolist(), ends)], pa.binary())
                                                for c in (low, small)]], names=["bucket", "hashes", "counts"])
                more = n > 0xFFFFFFFF
                h, n = h[more], n[more] - 0xFFFFFFFF

        parts, size = [], 0
        for chunk in _chunks(batches, chunk_words):
            for _, _, hashes in chunk_counts(chunk, bits and bits.value, None, levels):
                parts.append(np.unique(hashes >> np.uint64(64 - HASH_BITS), return_counts=True))
                size += len(parts[-1][0])
            if size > 2 * MERGED:
                parts = [_added(parts)]
                size = len(parts[0][0])
                if size > MERGED:
                    yield from rows(parts)
                    parts, size = [], 0
        if parts:
            yield from rows(parts)

    def add(table):
        import pyarrow as pa

        low, n = (np.concatenate([np.frombuffer(x, "<u4") for x in table[c].to_pylist()]) for c in ("hashes", "counts"))
        first, out = np.uint64(table["bucket"][0].as_py() << rest), []
        step = -(-(1 << rest) // max(1, -(-len(low) // MERGED)))
        for lo in range(0, 1 << rest, step):
            here = slice(None) if step >> rest else (low >= lo) & (low < lo + step)
            h, k = _added([(low[here].astype(np.uint64), n[here].astype(np.int64))])
            out.append((h[k >= least] | first, k[k >= least]))
        h, k = (np.concatenate(c) for c in zip(*out))
        return pa.table({"hash": pa.array(h.view(np.int64)), "n": pa.array(k)})

    return docs.mapInArrow(run, "bucket long, hashes binary, counts binary").groupBy("bucket").applyInArrow(add, "hash long, n long")


def phrase_counts(docs: DataFrame, bits, done, levels: tuple[int, ...] = (1, 2, 3, 4),
                  chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(lang, phrase, n): exact counts of the phrases that count with the
    broadcast filters ``bits`` and ``done``.  The empty phrase has the number
    of a language's words."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["lang", "phrase", "n"]
        for chunk in _chunks(batches, chunk_words):
            words, langs = pa.array(chunk.words, pa.binary()).cast(pa.string()), np.array(chunk.langs)
            ids, spoken = chunk.places(), pa.array(list(chunk.numbers))
            total = np.bincount(langs[ids[ids > 0]], minlength=len(spoken))
            yield pa.RecordBatch.from_arrays([spoken, pa.array([""] * len(spoken)), pa.array(total)], names=names)
            for k, at, _ in chunk_counts(chunk, bits.value, done.value, levels):
                if not len(at):
                    continue
                columns, n = distinct_rows([ids[at + j] for j in range(k)], len(words).bit_length())
                for lo in range(0, len(n), ROWS):
                    part = [words.take(pa.array(c[lo:lo + ROWS])) for c in columns]
                    phrase = pc.binary_join_element_wise(*part, " ") if k > 1 else part[0]
                    lang = spoken.take(pa.array(langs[columns[0][lo:lo + ROWS]]))
                    yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(n[lo:lo + ROWS])], names=names)

    return docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def filter_bits(hashes: DataFrame, size: int, old: np.ndarray | None = None) -> np.ndarray:
    """The filter of ``size`` bits that holds ``old`` and the column ``hash``.
    At most size / 64 rows reach the driver."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            kept = b.column(0).to_numpy().view(np.uint64)
            at = np.concatenate([*_places(kept, size)])
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))],
                                             names=["slot", "bit"])

    rows = (hashes.select("hash").mapInArrow(run, "slot long, bit long")
            .groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(size // 64, np.uint64) if old is None else old.copy()
    out[rows["slot"].to_numpy()] |= rows["bits"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT, share: int = SHARE, sample_count: int = SAMPLE_COUNT,
                     size: int = FILTER_BITS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(lang, k, phrase, n): every phrase of 1 to 4 words with at least
    ``min_count`` occurrences; k = 0 has a language's number of words."""
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    texts = base.select("lang", "text")
    sample = staged(base.where(F.pmod("h", F.lit(share)) == 0).select("lang", "text"))

    # buckets by the corpus' words, which are about one for six characters
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = min(MOST_BUCKET_BITS, max(LEAST_BUCKET_BITS, (chars // 6 // BUCKET_WORDS).bit_length()))

    held, proposed = None, None
    for k in range(1, LONGEST):
        frequent = hash_counts(sample, proposed, (k,), chunk_words, sample_count)
        held = filter_bits(frequent, size, held)
        proposed = spark.sparkContext.broadcast(held)
    reached = hash_counts(texts, proposed, chunk_words=chunk_words, least=min_count, bucket_bits=buckets)
    reached = spark.sparkContext.broadcast(filter_bits(reached, size))
    counts = phrase_counts(texts, reached, proposed, chunk_words=chunk_words)
    found = staged(counts.where((F.col("n") >= min_count) | (F.col("phrase") == "")))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return found.select("lang", words.alias("k"), "phrase", "n")


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each
    language from a table of :func:`frequent_phrases`.

    The score is that of the lowest-scoring cut, floor(2000000 a / (l + r));
    phrases of which at least 80 percent of the occurrences lie in one longer
    frequent phrase are dropped.  Ties go by occurrences, then by phrase.
    """
    phrases = found.where("k > 0").select("lang", "phrase", "n")
    longer = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = longer.select("lang", "k", "phrase", "a", cut).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("x"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("y"))
    for part, count in (("x", "l"), ("y", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)), ["lang", part])
    cuts = cuts.select("lang", "phrase", "a", "cut", "l", "r").withColumn(
        "score", F.expr(f"({SCALE}BD * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + r)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))

    words = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("k") - s + 1), lambda i: F.array_join(F.slice(words, i, s), " "))))
    inside = (longer.where("k > 2").select("lang", F.explode(spans).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (PART_DEN * _big("most") < PART_NUM * _big("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    sizes = found.where("k = 0").select("lang", F.col("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine_collocations(docs: DataFrame, **options) -> DataFrame:
    """:func:`collocations` of the frequent phrases of ``docs``."""
    return collocations(frequent_phrases(docs, **options))
