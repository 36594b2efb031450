import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from chartmill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top):
    """The definition, term by term."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def share(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 5) // (n + 5 * len(kept)) for t in kept}

        mine, whole = share(counts[lang, source]), share(sum((counts[lang, s] for s in sources), Counter()))
        pairs = [(s, sum(abs(mine[t] - q) for t, q in share(counts[lang, s]).items())) for s in sources if s != source]
        own = [(t, mine[t] - whole[t]) for t in kept if counts[lang, source][t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", own, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


words = st.sampled_from(["a", "A", "b", "ab", "été", "É", "日本", "x_y", "Z9z", " ", "😀", "`{", "ÀB", "\x7f"])
rows = st.lists(
    st.tuples(st.none() | st.lists(words, max_size=8).map(" ".join), st.sampled_from([None, "", "en", "fr"]), st.sampled_from([None, "", "s1", "s2", "é", "z"])),
    max_size=25,
)


@given(st.lists(st.text(max_size=20), max_size=5))
@settings(deadline=None)
def test_terms(texts):
    text = "".join(texts)
    assert [t.decode() for t in divergence.terms_of(text.encode())] == TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@given(rows, st.integers(1, 3), st.integers(1, 4))
@settings(max_examples=6, deadline=None)
def test_against_the_definition(spark, table, least, top):
    found = divergence.audit(spark.createDataFrame(table, "text string, lang string, source string"), least_docs=least, top=top, block=2)
    assert sorted(map(tuple, found.collect())) == brute(table, least, top)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_make_no_difference(spark, docs_of, block):
    rnd = np.random.default_rng(4)
    vocabulary = [f"w{''.join(chr(97 + int(c)) for c in str(k))}" for k in range(80)]
    table = [(k, " ".join(rnd.choice(vocabulary, 40)), "en" if k % 3 else None, f"s{rnd.integers(5)}") for k in range(120)]
    table += [(1, None, "xx", "only"), (1, None, "xx", "other"), (1, None, "xx", "other"), (2, "rare", "yy", None)]
    clash = ["term", "n", "docs", "total", "counts", "uses", "kept", "value", "rank", "item", "part", "block", "at", "length"]
    found = divergence.audit(docs_of(table, clash).repartition(3), least_docs=20, top=7, block=block)
    assert sorted(map(tuple, found.collect())) == brute([r[1:] for r in table], 20, 7)


def test_none(spark, docs_of):
    assert divergence.audit(docs_of([(1, "a", "b", "c")]).limit(0)).count() == 0


def test_exact_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("9000000000000000L as n", "9000000000000001L as uses", "3L as kept").select(divergence.share("n", "uses", "kept").alias("p")).first()
    assert row.p == 1 + 10**9 * (9 * 10**15 + 5) // (9 * 10**15 + 1 + 15)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(1, 5)), min_size=1, max_size=30))
def test_runs(entries):
    a, b, length = (np.array(x) for x in zip(*entries))
    assert divergence.difference(divergence.runs(a, length), divergence.runs(b, length)) == int((abs(a - b) * length).sum())
