"""Plain Python versions of the operators' contracts."""

import hashlib
import re
from collections import Counter

BLANK = " \t\n\x0b\x0c\r"
LOWER = {65 + i: 97 + i for i in range(26)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def least(ids):
    ids = [i for i in ids if i is not None]
    return min(ids) if ids else None


def exact(rows):
    """[(id, keep_id, size, sha)] and the number of rows kept per text."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    return [(i, least(groups[t]), len(groups[t]), sha(t)) for (i, _), t in zip(rows, norm)]


def shingle_set(text):
    w = [x for x in words((text or "").translate(LOWER))]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def jaccard(rows):
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), least(groups[find(i)]) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def substrings(rows, size=35):
    docs = [words(t) for _, t in rows]
    count = Counter(tuple(w[k:k + size]) for w in docs for k in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, docs):
        gone = set()
        for k in range(len(w) - size + 1):
            if count[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone))))
    return out


def lines(rows):
    """Null ids count as one document after all others."""
    far = float("inf")
    key = lambda line: line.strip(BLANK).translate(LOWER)
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(far if d is None else d)
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(held.get(key(x), ())) < 2 or min(held[key(x)]) == (far if d is None else d)]
        out.append((d, len(all_), len(all_) - len(kept), sha("\n".join(kept))))
    return out


def leaks(rows, items):
    def grams(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    docs = {}
    for d, t in rows:
        docs.setdefault(d, set()).update(grams(t))
    out = []
    for i, t in items:
        g = grams(t)
        out += [(d, i, len(g), len(g & s)) for d, s in docs.items() if i is not None and g and len(g & s) >= .75 * len(g)]
    return out


def spelling(rows):
    """[(word, form, root, n, n_near, form_n)]"""
    import zlib

    n = Counter()
    for d, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, count = {}, {}
    for w in n:
        by = sorted((-n[x], x) for x in n if near(w, x))
        count[w] = len(by)
        form[w] = by[0][1] if by and -by[0][0] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return out


def phrases(rows, least):
    """{(lang, phrase): occurrences} of the frequent ones, {lang: words}"""
    count, total = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3, 4):
                count.update((lang, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    return {k: v for k, v in count.items() if v >= least}, dict(total)


def collocations(rows, least=30, top=2000):
    f, total = phrases(rows, least)
    scored, most = {}, Counter()
    for (lang, p), a in f.items():
        w = p.split(" ")
        cuts = [(f[lang, " ".join(w[:c])], f[lang, " ".join(w[c:])]) for c in range(1, len(w))]
        if cuts:
            scored[lang, p] = min((2000000 * a // (x + y), c, x, y) for c, (x, y) in enumerate(cuts))
        for s in range(2, len(w)):
            for i in range(len(w) - s + 1):
                q = lang, " ".join(w[i:i + s])
                most[q] = max(most[q], a)
    out = []
    for lang in total:
        kept = sorted((-v[0], -f[lang, p], p.encode(), v[2], v[3]) for (x, p), v in scored.items()
                      if x == lang and 100 * most[lang, p] < 80 * f[lang, p])
        out += [(lang, i, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(kept[:top], 1)]
    return out
