"""Brute-force versions that several tests share."""

import re


def exact_groups(texts: dict) -> set:
    """The ids that stay when texts equal but for white space keep their longest, then first."""
    best = {}
    for i, text in texts.items():
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        rank = (-len(text or ""), i)
        best[key] = min(best.get(key, rank), rank)
    return {i for _, i in best.values()}


def near_classes(sets: dict, above: int = 4, below: int = 5) -> dict:
    """The least id of each document's class, over all pairs of sets."""
    sets = {i: set(s) for i, s in sets.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(sets[i] & sets[j])
            if shared and shared * below >= (len(sets[i]) + len(sets[j]) - shared) * above:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
