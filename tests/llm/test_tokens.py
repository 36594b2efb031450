import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chartmill.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "   ", "plain words here", "it's we'LL 12 3½ don't", "<|endoftext|>a<|startoftext|> b <|endoftext", "héllo ẞ İstanbul ΣΑΣ ﬁ 日本語",
    "\x1c\x1fx \u0085y\xa0z", "é ẛ̣", "😀👍🏽 ok", "!!!" * 500, "a" * 3000, "word " * 3000, "٣ ² ³",
]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def random_texts():
    rnd = random.Random(3)
    names = [n.replace("</w>", "") for n in tokens.Vocabulary(PATH).names if n.isascii()]
    joined = ["".join(rnd.choice(names) for _ in range(rnd.randint(1, 6))) for _ in range(2000)]
    ranges = [(1, 127), (1, 0x250), (0x250, 0xD7FF), (0xE000, 0x1FFFF)]
    wild = ["".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    few = ["".join(rnd.choice("aaaabbe") for _ in range(rnd.randint(1, 70))) for _ in range(500)]
    return joined + wild + few


def test_same_ids_and_text_as_the_library(library):
    texts = ODD + random_texts()
    own = tokens.Vocabulary(PATH)
    for text, ids, ref in zip(texts, own.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == ref.ids, text
        assert own.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_both_ways_of_merging_agree(monkeypatch):
    own = tokens.Vocabulary(PATH)
    words = [own.symbols("".join(own.letters[b] for b in t.encode())) for t in random_texts() if t]
    listed = [own.merge(w) for w in words]
    monkeypatch.setattr(tokens, "SHORT", 0)
    assert [own.merge(w) for w in words] == listed


def test_little_memory_changes_nothing(monkeypatch):
    texts = random_texts()[:300]
    expected = tokens.Vocabulary(PATH).encode(texts)
    monkeypatch.setattr(tokens, "WORD_MEMORY", 5)
    small = tokens.Vocabulary(PATH)
    assert [small.encode([t])[0] for t in texts] == expected


def test_tables(spark, docs_of, library):
    df = docs_of([(1, None, "en", "a"), (1, "some text", None, None), (None, "", "en", "a"), (1, "some text", None, None)], clash=["words"])
    out = tokens.decode(tokens.encode(df, PATH), PATH).collect()
    assert [len(r.ids) // 4 for r in out] == [0, 2, 0, 2] and [r.decoded for r in out][:2] == ["", "some</w> text</w>"]
    assert {r.words for r in out} == {"own words"}
    assert tokens.encode(df, PATH, decoded="decoded").collect() == out
    assert tokens.encode(df.limit(0), PATH).count() == 0
