"""License scans: an exact set-similarity join of text blocks with templates.

A document's words are cut into blocks of ``2 * STRIDE`` words, a new one
every ``STRIDE`` words, so any run of up to ``STRIDE + 1`` words lies whole in
the block that starts at or before it.  A block matches a template when it
holds at least the template's share (``threshold``) of distinct tokens.

The join follows the prefix-filter scheme.  Tokens are ordered by how many
documents of the whole corpus hold them, rarest first.  A template of ``k``
tokens that needs ``a = ceil(threshold * k)`` of them in a block must have
one of its ``k - a + 1`` rarest there (prefix filter), so only those tokens
are looked up; a block with fewer than ``a`` template tokens is left out
(length filter); a first shared token at place i of the template and j of the
block, in the global order, bounds the overlap by ``1 + min`` of what follows
both (positional filter); what remains is counted exactly.

Base phrases are templates that need all their tokens; in the blocks the join
returns, the places where the words stand consecutively are then read off.

The templates are a short fixed list, so their prefix index is shipped with
the task; documents are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import WORD_RUN, ascii_lower, map_columns, text_or_empty, texts_of

STRIDE = 32
THRESHOLD = 0.8

#: fixed values: phrases of the base contract and their labels
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: fixed values: opening or naming sentences of common licenses
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl": "gnu lesser general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0": "creative commons zero public domain dedication",
}


def token_counts(docs: DataFrame, tokens: list[str], text_col: str) -> dict[str, int]:
    """How many documents hold each of ``tokens``: over all documents, one
    row for each token comes back."""
    wanted = F.array(*[F.lit(t) for t in tokens])
    words = F.split(ascii_lower(text_or_empty(text_col)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    held = docs.select(F.explode(F.array_intersect(wanted, words)).alias("token"))
    return {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def prefix_index(templates: dict[str, tuple[str, float]], rank: dict[str, int]):
    """token -> [(name, place in the template's order)] over the prefixes;
    name -> (tokens, tokens needed)."""
    index, needs = {}, {}
    for name, (text, threshold) in templates.items():
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        needs[name] = (frozenset(tokens), need)
        for place, token in enumerate(tokens[:len(tokens) - need + 1]):
            index.setdefault(token, []).append((name, place))
    return index, needs


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None,
                  phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels,
    labels, score and matches (label, first block's start word, containment,
    best block of each label).

    Null or empty text has no words and no match.  ``score`` is the best
    containment of any match, 0 without one.  Rows and other columns are kept
    as they are; input columns of these names are replaced.
    """
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    for text in [*templates, *phrases]:
        text = templates.get(text, text)
        if not 1 <= len(text.split()) <= STRIDE + 1:
            raise ValueError(f"a template has 1 to {STRIDE + 1} words: {text!r}")
    wanted = {("t", k): (v, threshold) for k, v in templates.items()} | {
        ("p", p): (p, 1.0) for p in phrases}
    tokens = sorted({t for v, _ in wanted.values() for t in v.split()})
    count = token_counts(docs, tokens, text_col)
    rank = {t: i for i, t in enumerate(sorted(tokens, key=lambda t: (count.get(t, 0), t)))}
    index, needs = prefix_index(wanted, rank)

    added = T.StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<label:string,start:bigint,containment:double>>")
    base = docs.drop(*added.names)
    schema = T.StructType(base.schema.fields + added.fields)
    lower = {65 + i: 97 + i for i in range(26)}
    stride, word_run, labels_of = STRIDE, WORD_RUN, dict(phrases)

    def start():
        import re

        find = re.compile(word_run).findall

        def candidates(words):
            """(template, block) pairs that pass the three filters."""
            seen = {}
            for at, word in enumerate(words):
                for name, place in index.get(word, ()):
                    last = at // stride
                    for block in (last - 1, last) if last else (0,):
                        if (name, block) not in seen:
                            seen[name, block] = (place, word)
            for (name, block), (_, _) in seen.items():
                own = {w for w in words[block * stride:(block + 2) * stride] if w in rank}
                tokens, need = needs[name]
                if len(own) < need:
                    continue
                order = sorted(own, key=rank.__getitem__)
                mine = sorted(tokens, key=rank.__getitem__)
                i, j = next((i, order.index(t)) for i, t in enumerate(mine) if t in own)
                if 1 + min(len(mine) - i - 1, len(order) - j - 1) < need:
                    continue
                shared = len(own & tokens)
                if shared >= need:
                    yield name, block, shared / len(tokens)

        def scan(text):
            words = find(text.translate(lower))
            places, found, best = {}, {}, 0.0
            for (kind, name), block, share in candidates(words):
                if kind == "t":
                    best = max(best, share)
                    old = found.get(name)
                    if old is None or (-share, block) < (-old[1], old[0]):
                        found[name] = (block, share)
                else:
                    phrase = name.split()
                    for at in range(block * stride, min((block + 1) * stride, len(words) - len(phrase) + 1)):
                        if words[at] == phrase[0] and words[at:at + len(phrase)] == phrase:
                            places.setdefault(name, []).append(at)
            starts = [at for p in places.values() for at in p]
            base_labels = sorted({labels_of[p] for p in places})
            every = sorted({*base_labels, *found})
            return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(base_labels), ",".join(every), 1.0 if starts else best,
                    [{"label": n, "start": b * stride, "containment": s} for n, (b, s) in sorted(found.items())])

        return lambda batch: dict(zip(added.names, zip(*[scan(t) for t in texts_of(batch, text_col)])))

    return map_columns(base, schema, start)
