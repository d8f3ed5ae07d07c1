"""Plain versions of what the operators compute, and a small corpus with every odd case."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed=5, n=160):
    """Rows (doc_id, text, lang, source) with copies, near copies, shared passages, nulls, repeats and a very long text."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeinorstu") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = i % 8
        if kind == 1 and i > 8:
            text = rows[rng.randrange(len(rows))][1]
        elif kind == 2 and i > 8:
            words = (rows[rng.randrange(len(rows))][1] or "x").split(" ")
            for _ in range(1 + len(words) // 60):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            text = " ".join(words)
        elif kind == 3:
            words = [rng.choice(vocab) for _ in range(rng.randint(0, 90))]
            at = rng.randint(0, len(words))
            text = " ".join(words[:at] + passage + words[at:])
        else:
            text = rng.choice(["", "\n", "A "]) + " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 4, 5, 9, 40, 120])))
        rows.append((i, text, ["en", "de", None][i % 3], [f"s{i % 5}", "hot", None][min(i % 4, 2)]))
    rows += [(n, None, "en", "hot"), (n + 1, "", "en", "hot"), (n + 2, " \t\n ", None, None), (n + 3, "word", "de", "s1"),
             (n + 4, "Ünïcode 漢字 🙂 words here A b", "de", "s1"),
             (n + 5, " ".join(rng.choice(vocab) for _ in range(30000)), "en", "hot"),
             (None, "no id for this text at all", "en", "s2")]
    rows += [rows[3], rows[3], rows[n], (7, "another text under an id that is taken", "en", "s0")]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def words(text, lower=True):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_groups(rows):
    """Of each row: size of its set, smallest id reachable, rows linked with it."""
    sets = [shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[root(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        ids = [x for x in least[root(i)] if x is not None]
        out.append((r[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else r[0], links[i]))
    return out


def quality_counts(text):
    text = text or ""
    w = words(text, lower=False)
    places = defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i:i + 5])].append(i)
    twice = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice))


def repeated_spans(rows, width=50):
    """Spans of each distinct (id, text)."""
    docs = {(r[0], r[1] or "") for r in rows}
    owners = defaultdict(set)
    for d in docs:
        w = words(d[1], lower=False)
        for k in range(len(w) - width + 1):
            owners[tuple(w[k:k + width])].add(d)
    out = {}
    for d in docs:
        w = words(d[1], lower=False)
        spans = []
        for k in range(len(w) - width + 1):
            if len(owners[tuple(w[k:k + width])]) > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + width
                else:
                    spans.append([k, k + width])
        out[d] = [tuple(s) for s in spans]
    return out


def base_scores(rows, held):
    tokens = [words(r[1]) + [None] for r in rows]
    c = Counter()
    for r, t in zip(rows, tokens):
        if not held(r):
            c.update(t)
    n, v = sum(c.values()), len(c)
    return [(len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)) for t in tokens]


def remainder(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def targets(sizes, weights=(5, 2, 1), limit=3):
    """Target of each source: shares by weight, stopped at a multiple of its size, the rest shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - sum(limit * sizes[s] for s in stopped)
        total = sum(w for s, w in weight.items() if s not in stopped)
        share = rest / total if total else 0
        over = {s for s in order if s not in stopped and weight[s] * share > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in stopped else weight[s] * share for s in order}
        stopped |= over
