"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions, gives every
byte position a distribution over the languages, and a document's
probabilities are the mean over all its positions.  It is trained here, in
numpy, by backpropagation through time (Adam) on a bounded sample of rows
with a language; the weights (about 50 KB) go to the tasks, where the whole
of every text is read, many windows at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bounded_sample, held_out, map_columns, texts_of

WINDOW = 64
HIDDEN = 8
#: bounds of the training sample: rows of each language and of all of them,
#: characters of a row, windows of each row, languages
PER_LANGUAGE, MAX_ROWS, MAX_CHARS, WINDOWS_PER_ROW, MAX_LANGUAGES = 300, 60_000, 20_000, 8, 10_000
STEPS, BATCH, RATE = 400, 256, 0.02
#: windows that are read side by side
SIDE_BY_SIDE = 2048


@dataclass
class LanguageModel:
    languages: list[str]
    weights: dict[str, np.ndarray]


def _init(n_out: int, rng) -> dict[str, np.ndarray]:
    h = HIDDEN
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (3 * h, 256)).astype(np.float32)
        w["u" + d] = rng.normal(0, h ** -0.5, (3 * h, h)).astype(np.float32)
    w["o"] = rng.normal(0, 0.2, (n_out, 2 * h)).astype(np.float32)
    w["c"] = np.zeros((n_out, 1), np.float32)
    return w


def states(x: np.ndarray, u: np.ndarray, codes: np.ndarray, back: bool, trace: list | None = None) -> np.ndarray:
    """Hidden state at every position, (positions, HIDDEN, windows), for
    ``codes`` of (positions, windows).  ``trace`` collects what the backward
    pass needs.  Windows are the last axis, so every step works on long rows.
    """
    n, m, k = codes.shape[0], codes.shape[1], HIDDEN
    out = np.empty((n, k, m), np.float32)
    h = np.zeros((k, m), np.float32)
    for t in (range(n - 1, -1, -1) if back else range(n)):
        a = x.take(codes[t], axis=1)
        b = u @ h
        zr = a[:2 * k]
        zr += b[:2 * k]
        zr *= 0.5  # the sigmoid, by one tanh
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r, c = zr[:k], zr[k:], b[2 * k:]
        new = r * c
        new += a[2 * k:]
        np.tanh(new, out=new)
        if trace is not None:
            trace.append((t, h, z, r, c, new))
        h = np.subtract(h, new, out=out[t])
        h *= z
        h += new
    return out


def position_probabilities(w: dict[str, np.ndarray], codes: np.ndarray, traces=(None, None)) -> tuple:
    """((positions, languages, windows) probabilities, states)."""
    both = np.concatenate([states(w["xf"], w["uf"], codes, False, traces[0]),
                           states(w["xb"], w["ub"], codes, True, traces[1])], axis=1)
    p = w["o"] @ both
    p += w["c"]
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p, both


def gradients(w: dict[str, np.ndarray], codes: np.ndarray, target: np.ndarray, known: np.ndarray):
    """(mean loss, gradient of each weight) by backpropagation through time.
    ``target``: language of each window; ``known``: which positions count."""
    traces: tuple = ([], [])
    p, both = position_probabilities(w, codes, traces)
    n, m, k = codes.shape[0], codes.shape[1], HIDDEN
    share = known / max(1, known.sum())
    loss = float(-(np.log(p[:, target, np.arange(m)] + 1e-9) * share).sum())
    d = p.copy()
    d[:, target, np.arange(m)] -= 1
    d *= share[:, None, :]
    g = {"o": np.einsum("nlm,nkm->lk", d, both, optimize=True), "c": d.sum(axis=(0, 2))[:, None]}
    d_state = w["o"].T @ d
    for name, trace, half in (("f", traces[0], slice(0, k)), ("b", traces[1], slice(k, 2 * k))):
        u, du = w["u" + name], np.zeros_like(w["u" + name])
        dx = np.empty((3 * k, n, m), np.float32)
        dh = np.zeros((k, m), np.float32)
        for t, h, z, r, c, new in reversed(trace):
            dh = dh + d_state[t][half]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * c * r * (1 - r)
            dx[:, t] = np.concatenate([dz, dr, dn])
            inner = np.concatenate([dz, dr, dn * r])
            du += inner @ h.T
            dh = dh * z + u.T @ inner
        g["u" + name] = du
        flat = codes.reshape(-1)
        g["x" + name] = np.stack([np.bincount(flat, row.reshape(-1), 256) for row in dx])
    return loss, g


def fit(rows: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> LanguageModel | None:
    """Network from (text, language) rows; None without any."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    windows, known, target = [], [], []
    for text, lang in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = rng.integers(0, max(1, len(raw) - WINDOW + 1), WINDOWS_PER_ROW if len(raw) > WINDOW else 1)
        for s in starts:
            piece = raw[s:s + WINDOW]
            windows.append(np.pad(piece, (0, WINDOW - len(piece))))
            known.append(np.arange(WINDOW) < len(piece))
            target.append(languages.index(lang))
    windows, known, target = np.array(windows), np.array(known, np.float32), np.array(target)
    by_language = [np.flatnonzero(target == i) for i in range(len(languages))]
    w = _init(len(languages), rng)
    mean, var = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        lang = rng.integers(0, len(languages), BATCH)
        pick = np.array([by_language[i][rng.integers(len(by_language[i]))] for i in lang])
        _, g = gradients(w, windows[pick].T.copy(), target[pick], known[pick].T)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            mean[k] = 0.9 * mean[k] + 0.1 * g[k]
            var[k] = 0.999 * var[k] + 0.001 * g[k] ** 2
            w[k] = (w[k] - rate * (mean[k] / (1 - 0.9 ** step))
                    / (np.sqrt(var[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return LanguageModel(languages, w)


def train_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS,
                      max_languages: int = MAX_LANGUAGES) -> LanguageModel | None:
    """Network from a bounded sample.

    Of each language the ``per_language`` rows that come first by a hash of
    their id, among the non-empty rows with a language that are not held out.
    Rows of more than ``max_chars`` characters come last, and of such a row one
    stretch of ``max_chars`` at a place drawn from its id is read.  With so many
    languages that this exceeds ``MAX_ROWS``, each gives fewer rows, but one at
    least.  Rows that share an id count one by one, a row that repeats once.
    Every language is learned, up to ``max_languages``; beyond them those with
    the fewest rows (then the last by name) are not, and are never predicted.
    None without any row.
    """
    start = F.pmod(F.xxhash64("_id", F.lit(1)), F.greatest(F.lit(1), F.length("_t") - max_chars + 1)).cast("int") + 1
    fit_rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_y")).where(
        F.col("_y").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id") & (F.length("_t") > 0))
    found = [r["_y"] for r in fit_rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "_y").limit(max_languages).collect()]
    if not found:
        return None
    learned = fit_rows.sparkSession.createDataFrame([(y,) for y in found], "_y string")
    part = (fit_rows.join(F.broadcast(learned), "_y", "left_semi")
            .select("_id", F.substring("_t", start, F.lit(max_chars)).alias("_t"), "_y",
                    (F.length("_t") > max_chars).cast("int").alias("_long")))
    each = max(1, min(per_language, MAX_ROWS // len(found)))
    rows = bounded_sample(part, F.col("_y"), each, [F.col("_long"), F.xxhash64(F.lit("lang"), "_id")]).collect()
    return fit([(r["_t"], r["_y"]) for r in sorted(rows, key=lambda r: (r["_id"], r["_y"], r["_t"]))])


def reader(model: LanguageModel):
    """texts -> (document probabilities, positions labelled with each
    language), each (texts, languages)."""
    w, n_lang = model.weights, len(model.languages)

    def read(texts: list[str]):
        total, votes = np.zeros((len(texts), n_lang)), np.zeros((len(texts), n_lang), np.int64)
        raws = [np.frombuffer(t.encode(), np.uint8) for t in texts]
        pieces = [-(-len(r) // WINDOW) for r in raws]
        owner = np.repeat(np.arange(len(texts)), pieces)
        codes = np.zeros((len(owner), WINDOW), np.uint8)
        left = np.full(len(owner), WINDOW)
        at = 0
        for r, k in zip(raws, pieces):
            if k:
                codes[at:at + k].reshape(-1)[:len(r)] = r
                left[at + k - 1] = len(r) - (k - 1) * WINDOW
                at += k
        for a in range(0, len(owner), SIDE_BY_SIDE):
            part = slice(a, a + SIDE_BY_SIDE)
            p, _ = position_probabilities(w, np.ascontiguousarray(codes[part].T))
            inside = np.arange(WINDOW)[:, None] < left[part]
            best = p.argmax(axis=1)
            own = owner[part]
            for j in range(n_lang):
                total[:, j] += np.bincount(own, (p[:, j] * inside).sum(axis=0), len(texts))
                votes[:, j] += np.bincount(own, ((best == j) & inside).sum(axis=0), len(texts)).astype(np.int64)
        return total / np.maximum(1, [len(r) for r in raws])[:, None], votes

    return read


def predict_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its probability) and
    ``positions`` (language -> byte positions labelled with it).

    Texts that are null or have no letter are ``und`` with score 0, as is all
    without a model.  Ties go to the language that sorts first.  Rows and
    other columns are kept; input columns of the new names are replaced.
    """
    added = T.StructType.fromDDL("lang_pred string, score double, positions map<string,bigint>")
    base = docs.drop(*added.names)

    def start():
        import re

        letter = re.compile(r"[^\W\d_]").search
        read = reader(model) if model else None

        def f(batch):
            texts = texts_of(batch, text_col)
            if read is None:
                return {"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts), "positions": [{}] * len(texts)}
            p, votes = read(texts)
            best, some = p.argmax(axis=1), [letter(t) is not None for t in texts]
            return {"lang_pred": [model.languages[b] if s else "und" for b, s in zip(best, some)],
                    "score": [min(1.0, float(q[b])) if s else 0.0 for q, b, s in zip(p, best, some)],
                    "positions": [[(name, int(n)) for name, n in zip(model.languages, v) if n] for v in votes]}

        return f

    return map_columns(base, T.StructType(base.schema.fields + added.fields), start)
