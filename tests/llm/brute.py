"""Plain versions of the operators, for comparison on small tables."""

import collections
import hashlib
import math
import re
import zlib

SPACES = re.compile(r"[ \t-\r]+")


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def exact(rows):
    """{row number: (keep_id, size)} for (doc_id, text) rows."""
    groups = collections.defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[SPACES.sub(" ", text or "")].append(i)
    found = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            found[i] = (min(ids) if ids else None, len(members))
    return found


def shingles(text):
    w = words(text, True)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(rows):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        common = collections.Counter(j for h in s for j in where[h])
        for h in s:
            where[h].append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def without_repeats(rows, window=13):
    """{doc_id: (n_words, n_removed, kept words)}."""
    first, all_words = {}, {}
    for i, t in sorted(rows):
        w = all_words[i] = words(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    found = {}
    for i, w in all_words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        found[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return found


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def language(rows, prior):
    """{doc_id: (n_tokens, n_known, train_tokens, base, score)} without quantising."""
    tokens = {i: [*words(t, True), None] for i, t in rows}
    single, pairs, contexts = collections.Counter(), collections.Counter(), collections.Counter()
    for i, w in tokens.items():
        if fold(i) != 1:
            single.update(w)
            for a, b in zip(["<s>", *w], w):
                pairs[a, b] += 1
                contexts[a] += 1
    total, kinds = sum(single.values()), len(single)

    def p(x):
        return (single[x] + 0.5) / (total + 0.5 * (kinds + 1))

    return {i: (len(w), sum(single[x] > 0 for x in w), total, sum(math.log10(p(x)) for x in w),
                sum(math.log10((pairs[a, b] + prior * p(b)) / (contexts[a] + prior)) for a, b in zip(["<s>", *w], w)))
            for i, w in tokens.items()}


def mix(rows):
    """[(doc_id, size, source_size, target, taken)] of (doc_id, source, text) rows."""
    sized = [(d, s, len(words(t)), hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()) for d, s, t in rows]
    sources = collections.Counter()
    for _, s, n, _ in sized:
        sources[s] += n
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    budget, target, capped = sum(sources.values()), {}, set()
    while True:  # share, stop at the ceiling, share the excess again
        left = budget - sum(3 * sources[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * weight[s] / total > 3 * sources[s]}
        if not over:
            break
        capped |= over
    for s in names:
        target[s] = float(3 * sources[s]) if s in capped else left * weight[s] / total
    served, copies = collections.Counter(), []
    order = sorted(sized, key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[2]))
    for k, (d, s, n, h) in enumerate(order):
        served[s] += n
        if target[s] > 0:
            copies += [((served[s] + sources[s] * p) / target[s], h, d is not None, d or 0, p, k) for p in range(3)]
    used, taken = 0, collections.Counter()
    for copy in sorted(copies):
        used += order[copy[-1]][2]
        if used > budget:
            break
        taken[copy[-1]] += 1
    return [(d, n, sources[s], target[s], n * taken[k]) for k, (d, s, n, _) in enumerate(order)]
