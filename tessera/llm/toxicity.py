"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps homoglyphs to Latin letters and digits (and ``@``
and ``$`` before a letter) to the letters they stand in for; as the digit one
stands for i and l, these three become one letter.  A lexicon entry is a whole word or a stem that words begin with; its weight is the log ratio of
how often toxic and other labelled texts hold it.  One automaton finds
entries and exception phrases; what lies inside an exception does not count.
The summed weights, as they are and divided by the length of the text, give
the score by a fitted logistic curve.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import fit_logistic, labelled_sample, map_columns, texts_of

#: bounds of the labelled sample: rows of each label, characters of a row
PER_CLASS, MAX_CHARS = 1500, 8_000
MIN_DOCS, MIN_WEIGHT = 4, 3.0
STEMS = range(4, 8)
#: characters of text per unit of length in the normalised sum
PER_CHARS = 1000.0

#: fixed values: words that count without any label, and their weight
SEEDS = ["idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "trash", "clown"]
SEED_WEIGHT = 3.0
#: fixed values: phrases in which such words are not an insult
EXCEPTIONS = ["clown fish", "trash can", "trash bin", "trash bag", "pond scum", "circus clown", "clown show tickets",
              "pathetic fallacy", "stupid simple", "sore loser trophy"]
#: fixed values: look-alike characters and the letters they stand in for
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "ս": "u", "օ": "o", "ⅼ": "l", "ⅰ": "i",
}
#: fixed values: digits and signs in place of letters
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s"}


def folding():
    """text -> folded text of the same length (but for rare case mappings)."""
    import re

    table = {ord(k): v for k, v in {**HOMOGLYPHS, **DIGITS}.items()}
    table |= {0xFF41 + i: chr(97 + i) for i in range(26)}  # full-width letters
    table |= {0xFF10 + int(d): v for d, v in DIGITS.items()} | {ord("l"): "l"}
    table = {k: "i" if v == "l" else v for k, v in table.items()}
    sign = re.compile(r"[@$](?=[@$]*[^\W\d_])")
    signs = dict(SIGNS)

    def fold(text: str) -> str:
        text = text.lower()
        if "@" in text or "$" in text:
            text = sign.sub(lambda m: signs[m.group()], text)
        return text.translate(table)

    return fold


@dataclass
class ToxicityModel:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))
    weights: list[float] = field(default_factory=lambda: [-4.0, 1.0, 1.5])


def matcher(model: ToxicityModel):
    """folded text -> [(start, end, weight)] of the entries that count.

    Entries and exceptions are folded as the text is."""
    import ahocorasick

    fold = folding()
    auto, exceptions = ahocorasick.Automaton(), {fold(e) for e in model.exceptions}
    entries: dict[str, list] = {}
    for kind, group in (("word", model.words), ("stem", model.stems)):
        for entry, weight in group.items():
            entries.setdefault(fold(entry), []).append((kind, weight))
    for e in exceptions:
        entries.setdefault(e, []).append(("exception", 0.0))
    for entry, values in entries.items():
        auto.add_word(entry, (len(entry), values))
    if entries:
        auto.make_automaton()

    def hits(text: str) -> list[tuple[int, int, float]]:
        if not entries:
            return []
        found, spared, n = {}, [], len(text)
        for last, (size, values) in auto.iter(text):
            first, end = last - size + 1, last + 1
            if first and text[first - 1].isalnum():
                continue
            closed = end == n or not text[end].isalnum()
            for kind, weight in values:
                if kind == "exception":
                    if closed:
                        spared.append((first, end))
                elif closed or kind == "stem":
                    found[first] = max(found.get(first, (0.0, end)), (weight, end))
        return [(a, e, w) for a, (w, e) in sorted(found.items())
                if not any(x <= a and e <= y for x, y in spared)]

    return hits


def _features(hits, chars: int) -> tuple[float, float]:
    total = sum(w for _, _, w in hits)
    return math.log1p(total), math.log1p(total / (1 + chars / PER_CHARS))


def learn_lexicon(rows: list[tuple[str, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """(words, stems) with weights, from texts labelled 1 (toxic) or 0.

    Greedy cover: among words and stems that at least ``MIN_DOCS`` toxic texts
    hold and whose log ratio reaches ``MIN_WEIGHT``, the one with the largest
    product of that ratio and the number of toxic texts without an entry yet
    is taken, until none is in ``MIN_DOCS`` of them.  Chance words of toxic
    texts are so left out."""
    import re

    fold, find = folding(), re.compile(r"[^\W_]+").findall

    def keys(text):
        """Whole words end in a blank, stems do not."""
        words = set(find(fold(text)))
        return {w + " " for w in words} | {w[:n] for w in words for n in STEMS if len(w) > n}

    toxic = Counter()
    for text, y in rows:
        if y:
            toxic.update(keys(text))
    toxic = Counter({k: n for k, n in toxic.items() if n >= MIN_DOCS})
    other, total = Counter(), Counter(y for _, y in rows)
    uncovered = []
    for text, y in rows:
        held = keys(text) & toxic.keys()
        if y:
            uncovered.append(held)
        else:
            other.update(held)
    good = {k: math.log((n + 0.5) / (total[1] + 1)) - math.log((other[k] + 0.5) / (total[0] + 1))
            for k, n in toxic.items()}
    good = {k: w for k, w in good.items() if w >= MIN_WEIGHT}
    uncovered = [held & good.keys() for held in uncovered]
    chosen: dict[str, float] = {}
    while True:
        left = Counter(k for held in uncovered for k in held)
        best = max(left, key=lambda k: (left[k] * good[k], k[-1] == " ", len(k), k), default=None)
        if best is None or left[best] < MIN_DOCS:
            break
        chosen[best] = good[best]
        uncovered = [held for held in uncovered if best not in held]
    return ({k[:-1]: w for k, w in chosen.items() if k[-1] == " "},
            {k: w for k, w in chosen.items() if k[-1] != " "})


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> ToxicityModel:
    """Model from a bounded sample of the labelled rows that are not held out
    (see ``labelled_sample``).  Without rows of both labels it has the seed
    words and fixed weights."""
    rows = labelled_sample(docs, labels, label, per_class, max_chars, id_col, text_col)
    seeds = {w: SEED_WEIGHT for w in SEEDS}
    if len({y for _, y in rows}) < 2:
        return ToxicityModel(words=seeds)
    words, stems = learn_lexicon(rows)
    fold = folding()
    model = ToxicityModel(words={fold(w): v for w, v in seeds.items()} | words, stems=stems)
    hits = matcher(model)
    x = [_features(hits(fold(t)), len(t)) for t, _ in rows]
    model.weights = [float(v) for v in fit_logistic(x, [y for _, y in rows])]
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxic_hits`` (start, end and weight of each entry that
    counts, in the folded text) and ``score`` (0 to 1).

    Null and empty texts have no hits and the lowest score.  Rows and other
    columns are kept; input columns of the new names are replaced.
    """
    added = T.StructType.fromDDL("toxic_hits array<struct<start:int,end:int,weight:double>>, score double")
    base = docs.drop(*added.names)

    def start():
        fold, hits = folding(), matcher(model)
        bias, *slopes = model.weights

        def score(found, chars):
            v = bias + sum(a * b for a, b in zip(slopes, _features(found, chars)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, v))))

        def f(batch):
            texts = texts_of(batch, text_col)
            found = [hits(fold(t)) for t in texts]
            return {"toxic_hits": [[{"start": a, "end": e, "weight": w} for a, e, w in h] for h in found],
                    "score": [score(h, len(t)) for h, t in zip(found, texts)]}

        return f

    return map_columns(base, T.StructType(base.schema.fields + added.fields), start)
