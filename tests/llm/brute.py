"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, fold=True):
    return WORD.findall(folded(text) if fold else text or "")


def shingle_set(text, size=5):
    found = words(text)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def smallest(pairs, ids):
    """Union of pairs: id to the least id that can be reached."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def similar_pairs(sets, percent):
    """Pairs of keys whose sets have the similarity, by counting shared members."""
    owners, shared = collections.defaultdict(list), collections.Counter()
    for key, members in sets.items():
        for m in members:
            owners[m].append(key)
    for keys in owners.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                shared[a, b] += 1
    return [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def near_duplicates(docs):
    """(doc_id, text) to doc_id: (set size, component)."""
    sets = {i: shingle_set(t) for i, t in docs}
    component = smallest(similar_pairs(sets, 75), sets)
    return {i: (len(s), component[i]) for i, s in sets.items()}


def lines(docs):
    """(doc_id, text) in order to (doc_id, line): (number of tokens, first line of the class, similar earlier lines)."""
    rows = []
    for i, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            tokens = frozenset(words(line))
            if tokens:
                rows.append(((i, n), tokens))
    first, owners, earlier = {}, collections.defaultdict(list), {}
    for key, tokens in rows:
        if tokens in first:
            continue
        first[tokens] = key
        shared = collections.Counter()
        for t in tokens:
            shared.update(owners[t])
        earlier[tokens] = {k for (k, n), c in shared.items() if 100 * c >= 75 * (len(tokens) + n - c)}
        for t in tokens:
            owners[t].append((key, len(tokens)))
    return {key: (len(tokens), first[tokens], earlier[tokens]) for key, tokens in rows}


def targets(sizes, weights=(1, 2, 3), most=3):
    """Words per source to targets, by sharing again what is above the bound until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        share = sum(weight[s] for s in free)
        left = total - sum(fixed.values())
        found = {s: left * weight[s] / share for s in free}
        above = [s for s in free if found[s] > most * sizes[s]]
        if not above:
            return fixed | found
        fixed |= {s: most * sizes[s] for s in above}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
