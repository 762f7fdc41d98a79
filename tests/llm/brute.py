"""Plain versions of the operators over lists of rows, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=10):
    grams = {}
    for item, text in items:
        words = LETTER.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            grams.setdefault(tuple(words[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        words = LETTER.findall((text or "").translate(LOWER))
        hit, named = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                found = grams.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    named |= found
        listed = ",".join(sorted(str(x) for x in named if x is not None))
        out.append((doc, len(words), len(hit), len(named - {None}), sha(listed), bool(hit)))
    return out


def shingles(text):
    words = SPACE.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    for d, s in sets.items():
        for e, n in Counter(e for g in s for e in holders[g] if e < d).items():
            if 100 * n >= 85 * (len(s) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return [(d, len(sets[d]), find(d), find(d) == d) for d, _ in docs]


def substrings(docs, window=35):
    split = [(d, SPACE.findall(t or "")) for d, t in docs]
    count = Counter(
        tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1)
    )
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha(kept)))
    return out


def edit(a, b):
    """Word edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def lines(docs, least=8):
    first, rows = {}, {}
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        rows[d] = []
        for i, line in enumerate((t or "").split("\n")):
            words = tuple(SPACE.findall(line))
            if words:
                rows[d].append((i, words))
                first.setdefault(words, (d, i))
    long = [w for w in first if len(w) >= least]
    order = {w: k for k, w in enumerate(first)}
    near = {
        w for w in long
        if any(order[o] < order[w] and abs(len(o) - len(w)) < 2 and edit(o, w) < 2 for o in long)
    }
    out = []
    for d, found in rows.items():
        gone = [i for i, w in found if first[w] != (d, i) or w in near]
        out.append((d, len(found), len(gone), sha(",".join(map(str, gone)))))
    return out


def one_edit(a, b):
    """Whether one inserted, deleted or replaced letter leads from one to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def occurrences(docs, least_letters=6, least_count=5, every=199):
    found = Counter()
    for doc, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_letters:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_count}


def variants(n, ratio=5):
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(((-n[v], v) for v in found), default=(0, None))
        form[w] = best[1] if best[1] is not None and -best[0] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n]


def collocations(docs, top=2000, least=30):
    """Rows from (lang, text), with Python's whole numbers."""
    counts = {}
    for lang, text in docs:
        own = counts.setdefault("und" if lang is None else lang, (Counter(), Counter()))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own[1][""] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    own[0][tuple(words[i : i + k])] += 1
    out = []
    for lang, (f, total) in counts.items():
        often = {p: a for p, a in f.items() if a >= least}
        gone = {
            p[i : i + k] for p, a in often.items() for k in range(2, len(p))
            for i in range(len(p) - k + 1) if 100 * a >= 80 * often[p[i : i + k]]
        }
        rows = []
        for p, a in often.items():
            if len(p) > 1 and p not in gone:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[""], -score))
    return out


def proximity(docs, items, within):
    """(doc_id, item, first, last): by place of the end, the shortest stretch with all words."""
    found = []
    asked = {
        (None if name is None else str(name), frozenset(LETTER.findall((text or "").translate(LOWER))))
        for name, text in items
    }
    for doc, text in docs:
        words = LETTER.findall((text or "").translate(LOWER))
        for name, wanted in asked:
            if not wanted or not wanted <= set(words):
                continue
            for end in range(len(words)):
                for low in range(end, max(end - within, -1), -1):
                    if words[end] in wanted and wanted <= set(words[low : end + 1]):
                        found.append((doc, name, low, end))
                        break
    return found


def targets(sizes, weights, cap=3):
    """Words due to each source, by hand: 100 % of all by weight, none above `cap` times its size."""
    held = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in held]
        left, weight = float(sum(sizes) - sum(held.values())), float(sum(weights[i] for i in free))
        due = {i: left * weights[i] / weight if weight else 0.0 for i in free}
        over = [i for i in free if due[i] > cap * sizes[i]]
        if not over:
            return [float(held.get(i, due.get(i, 0.0))) for i in range(len(sizes))]
        held.update({i: cap * sizes[i] for i in over})
