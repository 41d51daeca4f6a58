"""Plain Python versions of two stages."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def windows(text, size=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def hit_words(text, items):
    return bool(windows(text) & set().union(*map(windows, items)))


def similar(texts):
    """Pairs of texts whose sets of five-word shingles have a Jaccard similarity of 0.75 or more."""
    index, pairs, sets = {}, [], []
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        own = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        shared = {}
        for x in own:
            for j in index.get(x, ()):
                shared[j] = shared.get(j, 0) + 1
            index.setdefault(x, []).append(i)
        sets.append(own)
        pairs += [(j, i) for j, k in shared.items() if 100 * k >= 75 * (len(own) + len(sets[j]) - k)]
    return pairs
