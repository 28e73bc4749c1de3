"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad
labelled text.  A text is cut into chunks of ``CHUNK`` bytes (all of it, so a
long text is judged whole and each chunk starts afresh from the dictionary),
each chunk is compressed with either dictionary, and the difference of the
summed sizes, divided by the text's bytes, is the evidence: the better
dictionary saves more.  A logistic curve fitted on labelled texts that were
not in the dictionaries turns it into a score; as the sample has as many bad
as good texts, its intercept is then moved to the labels' true proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fit_logistic, held_out, labelled_sample, map_columns, texts_of

CHUNK = 512
LEVEL = 3
#: bounds of the labelled sample: rows of each label, characters of a row
PER_CLASS, MAX_CHARS = 3000, 20_000
DICT_BYTES = 256 * 1024


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    bias: float
    slope: float


def _chunks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]


def _dictionary(texts: list[str]) -> bytes:
    import zstandard

    samples = [c for t in texts for c in _chunks(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their bytes serve as they are
        return b"".join(samples)[-DICT_BYTES:]


def compressor(dictionary: bytes):
    """bytes -> compressed size, with the dictionary."""
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    one = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                   write_checksum=False, write_dict_id=False)
    return lambda raw: len(one.compress(raw))


def evidence(model: QualityModel):
    """text -> (size with the bad dictionary - size with the good one) / bytes; 0 if empty."""
    good, bad = compressor(model.good), compressor(model.bad)

    def of(text: str) -> float:
        pieces = _chunks(text)
        return sum(bad(c) - good(c) for c in pieces) / max(1, sum(map(len, pieces)))

    return of


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> QualityModel | None:
    """Model from a bounded sample of the labelled rows that are not held out
    (see ``labelled_sample``); None unless both labels have two rows."""
    import numpy as np

    rows = labelled_sample(docs, labels, label, per_class, max_chars, id_col, text_col)
    good, bad = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
    if min(len(good), len(bad)) < 2:
        return None
    model = QualityModel(_dictionary(good[::2]), _dictionary(bad[::2]), 0.0, 1.0)
    of = evidence(model)
    rest = [(t, 1) for t in good[1::2]] + [(t, 0) for t in bad[1::2]]
    x = np.array([of(t) for t, _ in rest])
    scale = x.std() or 1.0
    w = fit_logistic(x / scale, [y for _, y in rest])
    n = {r["y"]: r["n"] for r in labels.where(~held_out(id_col)).where(F.col(label).isin(0, 1))
         .groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = np.log(n[1] / n[0]) - np.log(len(good) / len(bad))
    model.bias, model.slope = float(w[0] + prior), float(w[1] / scale)
    return model


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``evidence`` and ``score`` (0 to 1, higher is better).

    Null and empty texts have evidence 0 and the score that belongs to it;
    without a model every score is 0.5.  Rows and other columns are kept;
    input columns of the new names are replaced.
    """
    added = T.StructType.fromDDL("evidence double, score double")
    base = docs.drop(*added.names)

    def start():
        from math import exp

        of = evidence(model) if model else lambda text: 0.0
        bias, slope = (model.bias, model.slope) if model else (0.0, 0.0)

        def f(batch):
            x = [of(t) for t in texts_of(batch, text_col)]
            return {"evidence": x, "score": [1 / (1 + exp(-max(-30.0, min(30.0, bias + slope * v)))) for v in x]}

        return f

    return map_columns(base, T.StructType(base.schema.fields + added.fields), start)
