import random

import numpy as np
import pytest

from chartmill.llm import repeats
from chartmill.llm.suffixes import suffix_array


def test_suffix_array_equals_sorting():
    rnd = random.Random(0)
    for _ in range(1500):
        x = [rnd.randint(1, rnd.choice([1, 2, 3, 6])) for _ in range(rnd.randint(0, 40))]
        if rnd.random() < 0.3:
            x = (x[: rnd.randint(1, 5)] * 20)[: len(x)]
        assert suffix_array(np.array(x, np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def brute(texts, length):
    seen = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + length] = b"\1" * length
    return [(bytes(b for b, g in zip(t, gone[d]) if not g), sum(g and not gone[d][i - 1 : i] == b"\1" for i, g in enumerate(gone[d]))) for d, t in enumerate(texts)]


def corpus(seed, n=60):
    rnd = random.Random(seed)
    alphabet = rnd.choice(["ab ", "abcdefgh  \n", "ab", "aé本 \n"])
    base = "".join(rnd.choice(alphabet) for _ in range(600))
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randint(0, 600)
            parts.append(base[at : at + rnd.randint(0, 120)] if rnd.random() < 0.6 else "".join(rnd.choice(alphabet) for _ in range(40)))
        texts.append("".join(parts))
    return [*texts, None, "", texts[0], "x" * 500, ("repeat me " * 50)]


@pytest.mark.parametrize("seed,largest", [(1, 20_000), (2, 20_000), (3, 1), (4, 2)])
def test_removal_equals_brute_force(docs_of, seed, largest):
    texts = corpus(seed)
    df = docs_of([(i, t, "en", "s") for i, t in enumerate(texts)], clash=["kept_", "first", "leader"])
    out = repeats.remove(df, length=30, gram=9, sorted_pieces=50, largest=largest).orderBy("doc_id").collect()
    expected = brute([(t or "").encode() for t in texts], 30)
    for row, (kept, spans) in zip(out, expected, strict=True):
        assert (bytes(row.kept), len(row.removed)) == (kept, spans), row.doc_id
    assert out[0].leader == "own leader"


def test_repeated_rows_and_empty_table(docs_of):
    text = "".join(random.Random(1).choice("abcdefg ") for _ in range(400))
    df = docs_of([(1, text, "en", "s"), (1, text, "en", "s"), (None, text[:150], "en", "s"), (None, None, None, None)])
    out = sorted((r.doc_id or 0, len(r.kept), len(r.removed)) for r in repeats.remove(df).collect())
    assert out == [(0, 0, 0), (0, 150, 0), (1, 0, 1), (1, 0, 1)]
    assert repeats.remove(df.limit(0)).count() == 0
