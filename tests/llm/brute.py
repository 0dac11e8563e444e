"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def order(doc_id) -> float:
    return float("inf") if doc_id is None else doc_id


def chat(rows):
    """conv_id: n_turns, turns, loss text, formatted characters."""
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, t in turns.items():
        t.sort()
        sizes = [len("<s>[INST][/INST]</s>") + sum(len(x) + len(re.findall(r"[\\<\[]", x)) for x in (r, s)) for _, _, r, s in t]
        ends = [i for i, x in enumerate(t) if x[2] == "assistant"]
        if not ends or ends[-1] != len(t) - 1:
            ends.append(len(t) - 1)
        out[conv] = (len(t), sha("".join(f"{r}\n{s}\n" for _, _, r, s in t)), sum(len(s) for _, _, r, s in t if r == "assistant"),
                     sha("".join(s for _, _, r, s in t if r == "assistant")), sum(sum(sizes[:i + 1]) for i in ends))
    return out


def lines(rows, min_docs=5, min_chars=40):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    def key(x):
        return x.strip(strip).translate(low)
    held = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(order(doc))
    gone = {k: max(d) for k, d in held.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        stay = [x for x in all_lines if key(x) not in gone or gone[key(x)] == order(doc)]
        out.append((doc, len(all_lines), len(all_lines) - len(stay), sha("\n".join(stay))))
    return out


def windows(rows, width=50):
    words = [(doc, WORD.findall(text or "")) for doc, text in rows]
    least = {}
    for doc, w in words:
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            least[k] = min(least.get(k, float("inf")), order(doc))
    out = []
    for doc, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i:i + width])] < order(doc):
                gone[i:i + width] = [True] * width
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


STRONG = [
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secrets(text):
    """Strong spans in order: kind, start, end."""
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, group, least) in enumerate(STRONG)
             for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(name, a, b) for a, _, b, name in sorted(found)]


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    own = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            hit[i:i + 5] = [True] * 5
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), sum(hit)


def shingles(text, width=5):
    w = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_classes(rows, threshold=0.8):
    """Least id of the class of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    classes = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            classes[root(i)] = min(classes.get(root(i), doc), doc)
    return [classes.get(root(i)) for i in range(len(rows))]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=10):
    """item_id, rank, doc_id, score of the best documents of each item."""
    counts = [(d, Counter(TERM.findall((t or "").translate(_LOW)))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    held, asked, out = Counter(x for _, c in counts for x in c), {}, []
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall((text or "").translate(_LOW)))
    weight = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[x] + 1))) for own in asked.values() for x in own}
    for item, own in asked.items():
        scores = []
        for doc, c in counts:
            if c:
                m = 10 + 90 * sum(c.values()) * n_docs // n_terms
                scores.append((-sum(weight[x] * (1_000_000_000 * c[x] // (1000 * c[x] + 8 * m)) for x in own), order(doc), doc))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(sorted((x for x in scores if x[0] < 0), key=lambda x: x[:2])[:k])]
    return out
