"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def groups(docs, size, percent=80):
    """{id: (set size, smallest id reachable)} by comparing all pairs."""
    sets = {k: shingles(text, size) for k, text in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def items_in(text, items, size=5, percent=80):
    """Items that a window of their length holds, tried at every place."""
    words = plain_words(text)
    found = []
    for item, item_text in items:
        own = plain_words(item_text)
        if not own:
            continue
        k = min(size, len(own))
        want = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
        for start in range(max(1, len(words) - len(own) + 1)):
            window = words[start : start + len(own)]
            have = Counter(tuple(window[i : i + k]) for i in range(len(window) - k + 1))
            if 100 * (want & have).total() >= percent * max(1, (want | have).total()):
                found.append(item)
                break
    return sorted(found)


def is_good(text, stop_words):
    words = WORD.findall(text or "")
    n = len(words)
    if n < 50:
        return False
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        k + d for k in range(n - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)
    }
    lines = [x for x in text.split("\n") if WORD.search(x)]
    stops = {f for w in stop_words for f in (w, w.capitalize(), w.upper())}
    return (
        100 * len(covered) <= 50 * n
        and 300 * n <= 100 * sum(map(len, words)) <= 1000 * n
        and 100 * len(re.findall(r"[#*$%&|<>]", text)) <= 10 * n
        and 100 * sum(w in stops for w in words) >= 2 * n
        and 100 * (len(lines) - len(set(lines))) <= 50 * len(lines)
    )


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
