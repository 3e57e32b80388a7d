"""Plain versions of the operators' definitions, for small tables."""

import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def components(nodes, links):
    """The least node that each node reaches."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def text_groups(rows, percent, width=5):
    """doc_id -> component of (doc_id, text) rows with distinct ids, by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return components(ids, links)


def table_rows(spark, name, sf_dir="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
