import random
import re
from itertools import combinations

import numpy as np
import pytest

from chartmill.llm import neardup


def exact_groups(rows):
    """Smallest id reachable by links, by comparing all pairs."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root(i), []).append(row[0])
    return [(row[0], len(s), min(groups[root(i)])) for i, (row, s) in enumerate(zip(rows, sets))]


def corpus(seed, texts=40, copies=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([1, 3, 5, 20, 60, 200]))] for _ in range(texts)]
    rows = []
    for i in range(copies):
        text = list(base[int(texts * rnd.random() ** 3)])
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((i * 7 % 1000, rnd.choice([" ", "\n", "  "]).join(text).upper() if i % 5 == 0 else " ".join(text), "en", "s"))
    rows += [(2000, None, "en", "s"), (2001, "", "en", "s"), (2002, " \t\n", None, None), (2003, "Once", "en", "s"), (2004, "once", "en", "s")]
    return rows


@pytest.mark.parametrize("largest,copies", [(neardup.UNIT, 32), (8, 32), (8, 1)])
def test_groups_equal_brute_force(docs_of, largest, copies):
    """Units of whole clusters, of pairs of blocks, and of buckets."""
    rows = corpus(largest)
    out = neardup.deduplicate(docs_of(rows), largest=largest, copies=copies).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(exact_groups(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_links_span_the_groups_of_one_unit():
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[rnd.random(300) > 0.12], rnd.integers(0, 2**63, 30, dtype=np.uint64)))) for _ in range(60)]
    found = neardup.links(np.stack([neardup.signature(s) for s in sets]), sets)
    parent = list(range(60))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def similar(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    assert all(similar(i, j) for i, j in found) and len(found) < 60
    for i, j in found:
        parent[root(i)] = root(j)
    assert all(root(i) == root(j) for i, j in combinations(range(60), 2) if similar(i, j))


def test_miss_probability():
    assert neardup.fewest_matches(128, 0.75, 1e-5) < 96 < 128
    assert neardup.fewest_matches(32, 0.75, 1e-2) > neardup.fewest_matches(32, 0.75, 1e-5)


def test_repeated_rows_missing_ids_and_empty_tables(spark, docs_of):
    text = "one two three four five six seven"
    rows = [(5, text, "en", "a"), (5, text, "en", "a"), (None, text, "en", "a"), (9, text + " eight", "en", "a"), (7, "", "en", "a"), (7, None, "en", "a"), (5, "quite another text of six words", "en", "a")]
    df = docs_of(rows, clash=["node", "label", "n"])
    out = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.deduplicate(df).collect()}
    assert out[(5, 3)] == (5, True) and out[(None, 3)] == (5, False) and out[(9, 4)] == (5, False) and out[(7, 0)] == (7, True)
    kept = neardup.keep_one(df).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(5, text), (5, "quite another text of six words"), (7, ""), (7, "")]
    assert kept[0].node == "own node"
    assert neardup.deduplicate(df.limit(0)).count() == 0 and neardup.keep_one(df.limit(0)).count() == 0
