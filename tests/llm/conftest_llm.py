"""Brute-force versions shared by the tests."""

import re


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    w = words_of(lower_ascii(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_components(sets, percent=80):
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
