"""Plain versions of the operators, for small tables."""

import re


def shingles(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(rows, n=4, share=85):
    """(doc_id, size, component) of rows (doc_id, text), every pair compared."""
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= share * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(i)] = min(doc_id, ids.get(root(i), doc_id))
    return [(doc_id, len(sets[i]), ids.get(root(i))) for i, (doc_id, _) in enumerate(rows)]
