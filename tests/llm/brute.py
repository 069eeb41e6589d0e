"""Plain Python versions of the operators, and a table of odd documents."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

SF_SMALL, SF_ORACLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def odd_documents() -> list[tuple[int, str | None]]:
    """Nulls, empty and very long texts, copies, near copies, shared passages, repeated rows, odd characters."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice(["the", "ing", "ou", "er", "st", "an", "é", "ß", "Re"]) for _ in range(r.randint(1, 4)))
                  for _ in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = text(30), text(200).split()
    rows: list[tuple[int, str | None]] = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One two"), (6, "one TWO"), (7, None), (8, " one two"),
        (9, "a\x00b \x1cc\x1f d"), (10, "日本語 テスト 🎉"), (11, "x " * 500), (12, "is on " * 300), (13, text(20_000)),
    ]
    for i in range(20, 45):
        near = list(base)
        for _ in range(i - 20):
            near[r.randrange(len(near))] = r.choice(vocabulary)
        rows.append((i, " ".join(near)))
    for i in range(50, 60):
        rows.append((i, f"{text(r.randint(0, 40))} {passage} {text(r.randint(0, 40))}"))
    for i in range(60, 75):
        rows.append((i, text(r.randint(1, 60)).upper() if i % 2 else "copied text of a few words"))
    for i in range(80, 110):
        rows.append((i, text(r.randint(10, 120))))
    rows.append((109, rows[-1][1]))  # a repeated row
    r.shuffle(rows)
    return rows


def odd_ids() -> list[tuple[int | None, str | None]]:
    """Rows without id, ids that name two texts, repeated rows, alone and in groups."""
    r = random.Random(9)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    long, near, shared = text(120).split(), [], text(20)
    for _ in range(3):
        w = list(long)
        w[r.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    rows = [(9, "alpha beta gamma"), (9, "other words entirely"), (12, "alpha beta gamma"), (None, "Alpha beta gamma"),
            (None, "only without id"), (None, "only without id"), (None, "ONLY without id"), (7, "seven " * 20), (7, "seven " * 20),
            (20, " ".join(long)), (20, near[0]), (None, near[1]), (21, "a clean text of its own"), (None, near[2]), (21, near[2]),
            (None, None), (None, ""), (30, None), (31, ""), (None, f"{text(5)} {shared} {text(5)}"), (40, f"{text(5)} {shared} {text(5)}"),
            (None, f"{text(5)} {shared} {text(5)}"), (41, f"{text(5)} {shared} {text(5)}"), (None, f"x {text(40)}"), (None, f"x {text(40)}")]
    r.shuffle(rows)
    return rows


def _first(i):
    """Orders ids upward, a missing one after all others."""
    return (i is None, i or 0)


def exact_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, best[t], len(g), i == best[t], hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g), key=repr)


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def jaccard_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * len(sets[a][1] | sets[b][1]):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(i, least.get(find(x), i), key=_first)
    return sorted(((i, len(s), least[find(x)]) for x, (i, s) in enumerate(sets)), key=repr)


def without_repeats(rows, n=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - n + 1):
            key = tuple(w[a:a + n])
            first[key] = min(i, first.get(key, i), key=_first)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {a + k for a in range(len(w) - n + 1) if _first(first[tuple(w[a:a + n])]) < _first(i) for k in range(n)}
        out.append((i, len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return sorted(out, key=repr)


def without_byte_repeats(rows, length):
    """Per row: bytes, removed ones, spans, what is left."""
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, raw):
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if seen[t[a:a + length]] > 1:
                gone[a:a + length] = b"\x01" * length
        out.append((i, len(t), sum(gone), len(re.findall(b"\x01+", bytes(gone))), bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def source_divergence(rows, least_docs, top):
    """``rows``: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    count, lang_count, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(LOWER))
        count[lang, source].update(terms)
        lang_count[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = sorted({r[2] for r in rows if r[1] == lang})

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: share(count[lang, s]) for s in sources}
        q = share(lang_count[lang])
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item, -v, r + 1) for part, found in (("pair", pair), ("term", term)) for r, (v, _, item) in enumerate(found)]
    return sorted(out)


def collocations(rows, longest, least, top, contained):
    """``rows``: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        often = {x: a for x, a in counts.items() if len(x) > 1 and a >= least}
        for x, a in often.items():
            score, k = min((10**6 * a * a // (counts[x[:k]] * counts[x[k:]]), k) for k in range(1, len(x)))
            inside = any(len(y) > len(x) and 100 * b >= contained * a and any(y[i:i + len(x)] == x for i in range(len(y)))
                         for y, b in often.items())
            if not inside:
                found.append((-score, -a, " ".join(x).encode(), a, counts[x[:k]], counts[x[k:]]))
        out += [(lang, r + 1, p.decode(), a, lo, hi, n[lang], -s) for r, (s, _, p, a, lo, hi) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.fixture(scope="session")
def rows():
    return odd_documents()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The odd documents with extra columns, some of which have the operators' own names."""
    made = spark.createDataFrame(
        [(i, t, None, "s", 0, "x", 1, 2, "k", False) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, keep_id string, shard int, _row int, row string, kept boolean")
    return made.repartition(5, "doc_id").cache()


@pytest.fixture(scope="session")
def none(odd):
    """An empty table."""
    return odd.limit(0)
