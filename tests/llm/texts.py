"""Small documents with the awkward cases, and plain Python versions of what the operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, size string, shard string, key double"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_list(text, width):
    w = words(text)
    return [tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))] if w else []


def documents(spark, seed=1, n=60):
    """Random texts with copies, near copies, nulls, repeated rows, one very long text and columns that clash."""
    rng = random.Random(seed)
    vocabulary = ["the", "a", "é", "Straße", "日本", "x", "of", "on"] + [f"w{k}" for k in range(300)]
    rows = []
    for k in range(n):
        text = " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 4, 5, 30, 80])))
        rows.append((k, text, rng.choice("abc")))
    base = " ".join(rng.choices(vocabulary, k=120)).split()
    for k in range(n, n + 25):  # near copies of one text, of which some are linked through others only
        edited = list(base)
        for _ in range(rng.randrange(9)):
            edited[rng.randrange(len(edited))] = f"new{rng.randrange(9)}"
        rows.append((k, " ".join(edited), "a"))
    for k in range(n + 25, n + 60):  # one text a third of all rows hold, up to white space
        rows.append((k, ("\t" if k % 2 else " ").join(base[:40]) + "\n" * (k % 3), "hot"))
    rows += [(200, None, "b"), (201, "", None), (202, None, None), (203, " \n\t ", "b"), (None, "no id here", "a"), (None, None, None)]
    rows += [(300, " ".join(rng.choices(vocabulary, k=60000)), "b"), (301, "x" * 50000, "c"), (-5, "minus five", "c")]
    rows += [(5, dict((r[0], r[1]) for r in rows)[5], "a")] * 2 + [(9, "same id, other text", "a")]
    return spark.createDataFrame([(*r[:2], None, r[2], None, "row", 1, "s", "x", 0.5) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(texts, width=4, percent=80):
    """Smallest id reachable from every id of ``{id: text}``."""
    sets = {i: frozenset(shingle_list(t, width)) for i, t in texts.items()}
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if (least[a], least[b]) != (low, low):
                least[a] = least[b] = low
                changed = True
    return least, {i: len(s) for i, s in sets.items()}


def holds(text, item, width=5, threshold=0.8):
    """Whether some window of ``text`` as long as ``item`` reaches the weighted similarity."""
    w, own = words(text), Counter(shingle_list(item, width))
    n = len(words(item))
    if not w or not own:
        return False
    for b in range(max(1, len(w) - n + 1)):
        there = Counter(shingle_list(" ".join(w[b:b + n]), min(width, n)))
        shared = sum((own & there).values())
        if shared / (sum(own.values()) + sum(there.values()) - shared) >= threshold:
            return True
    return False
