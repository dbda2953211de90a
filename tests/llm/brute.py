"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k=5):
    words = SPACED.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def jaccard(docs, k=5, percent=80):
    """{doc_id: (n_shingles, component_id)} for unique ids."""
    return {d: (n, c) for d, (n, c, _) in jaccard_links(docs, k, percent).items()}


def jaccard_links(docs, k=5, percent=80):
    """{doc_id: (n_shingles, component_id, n_links)} for unique ids."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    pairs, links = set(), Counter()
    for group in by.values():
        for i, a in enumerate(group):
            pairs.update((a, b) for b in group[i + 1 :])
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links.update((a, b))
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), links[d]) for d, s in sets.items()}


def repeats(docs, width=13):
    """[(doc_id, n_words, n_removed, kept_sha256)] in the order of the input."""
    words = [(d, SPACED.findall(t or "")) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(docs, items, window=10):
    windows = defaultdict(set)
    sizes = set()
    for name, text in items:
        w = LETTERED.findall((text or "").translate(UPPER))
        size = min(window, len(w))
        if size:
            sizes.add(size)
            for i in range(len(w) - size + 1):
                windows[tuple(w[i : i + size])].add(name)
    out = []
    for d, text in docs:
        w = LETTERED.findall((text or "").translate(UPPER))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(map(str, names)))), bool(hit)))
    return out


def statistics(text, window=8):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    counts = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + window))
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def chats(rows):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)} of (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def archive(pages, least=1000):
    """[(page_id, payload_bytes, payload_digest, record_type, refers_to)]"""
    last = {}
    for page, html in pages:
        last[html or ""] = max(last.get(html or "", page), page)
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        first = last[html or ""]
        revisit = len(raw) >= least and page != first
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out
