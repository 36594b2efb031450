import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chartmill.llm import eliasfano, idfiles, queries
from chartmill.llm.eliasfano import EliasFano
from tests.llm.test_tokens import ODD, random_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


@given(st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(0, 3), max_size=60), st.sampled_from([1, 2, 512]), st.data())
@settings(max_examples=300, deadline=None)
def test_codes_give_back_every_range(values, step, data):
    values.sort()
    old, eliasfano.STEP = eliasfano.STEP, step
    try:
        numbers, parts = EliasFano.of(np.array(values, np.int64)).sections()
        code = EliasFano.read(numbers, memoryview(b"".join(parts)))
        assert code.range(0, len(values)).tolist() == values
        a, b = data.draw(st.integers(0, len(values))), data.draw(st.integers(0, len(values)))
        assert code.range(a, b).tolist() == values[a:b]
        assert [code[i] for i in range(len(values))] == values
    finally:
        eliasfano.STEP = old


def test_codes_are_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    code = EliasFano.of(ends)
    assert code.range(0, len(ends)).tolist() == ends.tolist()
    bits = 8 * sum(map(len, code.sections()[1])) / len(ends)
    assert bits < 2.2 + np.log2(1000)  # two bits beside the mean step; 64-bit tables take 64
    with pytest.raises(ValueError):
        EliasFano.of(np.array([2, 1]))


def test_words_alone_encode_as_in_their_text(library):
    own, texts = idfiles.LibraryWords(PATH), ODD + random_texts()
    for text, ids, ref in zip(texts, own.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text


def expected(library, rows):
    start, out = 0, []
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, library):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    found = queries.QUERIES["op12_id_files"](spark, SF).collect()
    assert sorted(map(tuple, found)) == expected(library, rows)


@pytest.mark.parametrize("width", [1 << 16, 4])
def test_small_files(spark, docs_of, library, tmp_path, monkeypatch, width):
    """Many files a task: borders, totals and single documents, at both widths of an id."""
    rows = [(k, text, "en", "a") for k, text in enumerate(ODD * 3)] + [(-7, "first", None, None), (2**60, "last " * 50, None, None)]
    folder, end = f"file://{tmp_path}/out", 2 if width == 1 << 16 else width * 70_000
    docs = docs_of(rows, clash=["key", "tie", "task", "file", "start", "ids", "n_tokens", "before"]).repartition(3)
    idfiles.write(docs, PATH, folder, end_id=end, file_ids=40)
    found = idfiles.read(spark, folder).orderBy("start").collect()
    start = 0
    for row, (key, text) in zip(found, sorted((r[0], r[1]) for r in rows), strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, end]
        assert (row.doc_id, row.start, row.n_tokens, np.frombuffer(row.ids, "<u4").tolist()) == (key, start, len(ids), ids)
        start += len(ids)
    manifest = spark.read.parquet(f"{folder}/manifest").collect()
    assert len(manifest) > 5 and sum(m.n_docs for m in manifest) == len(rows)
    filesystem, root = idfiles.fs.FileSystem.from_uri(folder)
    monkeypatch.setattr(idfiles, "READ_IDS", 5)
    reader = idfiles.FileReader(filesystem, f"{root}/{max(manifest, key=lambda m: m.n_docs).file}")
    parts = list(reader.batches())
    assert len(parts) > 1 and sum(len(keys) for keys, *_ in parts) == reader.docs
    assert np.concatenate([ids for *_, ids in parts]).tolist() == reader.tokens(0, reader.ids).tolist()
    by_key = {r.doc_id: r.ids for r in found}
    for i in range(reader.docs):
        assert reader.document(i).tobytes() == by_key[reader.keys[i]]


def test_nulls_ties_and_none(spark, docs_of):
    rows = [(5, "b", None, None), (None, "x", None, None), (5, None, None, None), (5, "b", None, None), (None, None, None, None), (1, "", None, None)]
    found = idfiles.through_files(docs_of(rows), PATH, end_id=2).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 1, 5, 5, 5]
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found][:-1]]).tolist()
    assert sorted(r.n_tokens for r in found) == [1, 1, 1, 2, 2, 2]
    empty = idfiles.through_files(docs_of(rows).limit(0), PATH, end_id=2)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids"]
    assert [r.n_tokens for r in idfiles.through_files(docs_of([(1, None, None, None)]), PATH).collect()] == [0]
