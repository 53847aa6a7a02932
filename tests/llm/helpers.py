"""Small tables and plain versions that the operators are held against."""

from __future__ import annotations

import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

# Cases every operator on documents must stand: NULLs, empty, blank and repeated rows.
ODD_ROWS = [(None, "a text without an id"), (9001, None), (9002, ""), (9003, " \n\t "), (9004, "x"), (9004, "x")]


def documents(spark, rows):
    """doc_id and text, with columns whose names operators use themselves."""
    table = [(a, b, 1, "of", 2.5) for a, b in rows]
    return spark.createDataFrame(table, "doc_id long, text string, row int, class string, n double")


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_components(rows):
    """(set size, component) by doc_id, comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last = [i]
        for j, y in enumerate(b, 1):
            last.append(min(row[j] + 1, last[-1] + 1, row[j - 1] + (x != y)))
        row = last
    return row[-1]


def near_copies(seed, n=150):
    """Texts with a large group of near copies, a common passage, short and unrelated ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = rng.choices(words, k=90)
    common = rng.choices(words, k=25)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35:
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.6:
            text = common + rng.choices(words, k=rng.randint(0, 30))
        elif kind < 0.7:
            text = rng.choices(words, k=rng.randint(0, 4))
        else:
            text = rng.choices(words, k=rng.randint(5, 150))
        rows.append((3 * i, " ".join(text)))
    return rows + [(5000 + i, rows[i][1].upper()) for i in range(20)]
