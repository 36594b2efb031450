"""Language identification against the definition spelled out with plain lists and dictionaries."""

import zlib
from collections import Counter

import pytest

from chartmill.llm import language, queries

SF = "/root/testdata/sf0.001"


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = f" {' '.join(words)} " if words else ""
    return Counter(g for n in (1, 2, 3) for i in range(len(padded) - n + 1) if (g := padded[i : i + n]).strip())


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def brute(rows, hashes, train, size):
    """rows: (id, text, lang); returns the prediction of each."""
    profiles = {}
    for lang in sorted({l for _, t, l in rows if t is not None and l is not None}):
        known = [(hashes[t], t) for i, t, l in rows if l == lang and t is not None and zlib.crc32(str(i).encode()) % 4 != 2]
        total = Counter()
        for _, text in sorted(known)[:train]:
            total.update(codes_of(text))
        if known:
            profiles[lang] = {g: k for k, g in enumerate(ranked(total, size))}
    out = {}
    for i, text, _ in rows:
        own = ranked(codes_of(text or ""), size)
        distances = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(distances, key=lambda lang: (distances[lang], lang)) if own and distances else None
        out[i] = ("und", 0.0) if best is None else (best, 1 - distances[best] / (size * len(own)))
    return out


def codes_of(text):
    codes, counts = language.ngrams(text)
    return Counter(dict(zip(codes.tolist(), counts.tolist())))


def test_grams():
    """The packed n-grams are those of the padded words."""
    for text in ("Hello, World", "a", " 1 2 ", "été  et\nété", "日本 go", "", "x-y"):
        assert sorted(codes_of(text).values()) == sorted(grams(text).values())
        assert len(codes_of(text)) == len(grams(text))


@pytest.mark.parametrize("train", [3, 1000])
def test_whole_table_against_brute_force(spark, train):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(docs.where("doc_id < 40"))  # copies count as often as they occur
    rows = [tuple(r) for r in docs.collect()]
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()}
    profiles = language.fit(docs.where(~language.held_out("doc_id")), train_docs=train)
    expected = brute(rows, hashes, train, language.PROFILE)
    for r in language.predict(docs, profiles).collect():
        assert r.language.lang == expected[r.doc_id][0] and r.language.score == pytest.approx(expected[r.doc_id][1], abs=1e-12)


def test_held_out_rows_are_never_learned_from(spark):
    found = {r.doc_id: (r.held_out, r.lang_pred) for r in queries.QUERIES["op3_language"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, (held, _) in found.items())
    held = [i for i, (h, _) in found.items() if h and truth[i] is not None]
    assert sum(found[i][1] == truth[i] for i in held) >= 0.95 * len(held)
