"""Plain Python versions of the operators, and rows that are hard on them."""

import re
from collections import defaultdict

LONG = "lorem ipsum dolor sit amet " * 12_000

#: doc_id, text, and columns that share names with what operators compute.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, key long, score double, n long, sig string, _key int"


def documents(spark, rows):
    """Documents from (doc_id, text) with clashing extra columns."""
    data = [(i, t, "en" if k % 2 else None, None, None, k, 0.5, k, "s", 1) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, EXTRA)


HARD = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "one two"),
    (5, "One  two"),
    (None, "a row without an id but with some words in it"),
    (None, None),
    (6, LONG),
    (7, "x" * 200_000),
    (8, "twice the same row, once and again"),
    (8, "twice the same row, once and again"),
    (9, "one id"),
    (9, "two texts"),
    (10, "日本語のテキスト été Größe 😀"),
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(nodes, links):
    """The smallest node that links reach from each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def similar(rows, width=5, percent=80):
    """doc_id -> (size, component) of rows with unique ids."""
    sets, where = {}, defaultdict(list)
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        for g in sets[i]:
            where[g].append(i)
    pairs = {(a, b) for ids in where.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}
