"""Plain Python versions of the operators' definitions."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\W_]+")
LAST = (1 << 63) - 1


def a_to_z(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def number(doc_id):
    return LAST if doc_id is None else doc_id


def kept_words(docs, n=13):
    """(n_words, n_removed, sha256) of each (id, text)."""
    split = [(number(i), WORD.findall(t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for j in range(len(w) - n + 1):
            key = tuple(w[j : j + n])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        stays = [True] * len(w)
        for j in range(len(w) - n + 1):
            if least[tuple(w[j : j + n])] < i:
                stays[j : j + n] = [False] * n
        kept = [x for x, s in zip(w, stays) if s]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        out.append((len(w), len(w) - len(kept), digest))
    return out


def shingles(text, n=5):
    w = WORD.findall(a_to_z(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1)))


def near_components(docs, percent):
    """(set size, component id, kept) of each (id, text); every pair is compared."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(docs)):
        for y in range(x):
            shared = len(sets[x] & sets[y])
            if sets[x] and 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared) and sets[y]:
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(docs):
        least[find(x)] = min(number(i), least.get(find(x), LAST))
    out = []
    for x, (i, _) in enumerate(docs):
        name = least[find(x)]
        out.append((len(sets[x]), None if name == LAST else name, number(i) == name))
    return out


def item_words(text):
    return ALNUM.findall((text or "").lower())


def bag(w):
    return Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()


def leaks(docs, items, least=0.8):
    """{(doc id, item id): (similarity, start)}; every window of every document is compared.

    Of equally good windows the first counts that starts with a shingle of an item of that
    size, or the last window.
    """
    named = {}
    for i, t in items:
        w = tuple(item_words(t))
        if w:
            named[w] = min(i, named.get(w, i))
    out, of_size = {}, {}
    for words in named:
        of_size.setdefault(len(words), set()).update(bag(list(words)))
    for d, t in docs:
        w = item_words(t)
        for words, i in named.items():
            size, own = len(words), bag(list(words))
            best, run = (0.0, 0), min(5, size)
            # A window without one of the item's shingles has similarity 0.
            if not any(tuple(w[j : j + run]) in own for j in range(len(w) - run + 1)):
                continue
            for s in range(max(1, len(w) - size + 1)):
                other = bag(w[s : s + size] if len(w) > size else w)
                value = sum((own & other).values()) / sum((own | other).values())
                named_here = s >= len(w) - size or tuple(w[s : s + min(5, size)]) in of_size[size]
                best = max(best, (value, -s if named_here else -len(w)))
            if best[0] >= least:
                out[d, i] = (round(best[0], 9), -best[1])
    return out


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_spans(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
