"""BPE encoding and decoding with a public vocabulary, by speculation and verification.

A word's tokens are first guessed by greedy longest match.  A guess is the true encoding exactly when
every adjacent pair of tokens is *compatible*, that is when merging the pair's own characters yields
that very pair.  Compatibility is tested for all unseen pairs of a batch at once; only words with an
incompatible pair are merged step by step.

Null text counts as empty text: no tokens, and the empty string after decoding.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from chartmill.llm.base import give_back, shielded

# Bytes of words a task keeps; beyond it long ones, or all, are forgotten, which costs time and changes nothing.
WORD_MEMORY = 48_000_000
OFTEN = 8
ENTRY = 170  # bytes an entry takes besides its letters and ids
# Characters whose new words are learned together; one text may be longer.
TOGETHER = 1_000_000
LEARNED = 4096  # words learned at a time
# Fixed value: the split pattern of the vocabulary file, its classes spelled out for Latin-1.
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\t-\r \x85\xa0{LETTERS}{DIGITS}]+")
NO_LIMIT = np.int64(2**62)
UNMERGED = 2**62
# Words up to this many letters are merged in a plain list, longer ones with a heap.
SHORT = 48


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    spare = (chr(256 + i) for i in range(256))
    return [letters[b] if b in letters else next(spare) for b in range(256)]


class Words:
    """Splits texts into the words of a vocabulary file and remembers what each word encodes to.

    ``learn`` says how words not met before are encoded: it fills ``met``.
    """

    def __init__(self, path: str, library=None):
        from tokenizers import Tokenizer

        library = library or Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str
        self.special = {x.content: i for i, x in library.get_added_tokens_decoder().items()}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.letters = byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(self.letters)}
        self.met: dict[str, bytes] = {}
        self.held = 0

    def learn(self, words: list[str]) -> None:
        raise NotImplementedError

    def split(self, text: str) -> list[str]:
        """Words of the normalized text, lower case and free of white space."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            back = self.bytes_of
            return [bytes([back[c] for c in piece]).decode() for piece, _ in self.pre_tokenize(self.normalize(text))]
        return LATIN_WORDS.findall(text.lower())  # such text is normalized but for its case

    def parts(self, text: str) -> list[list[str] | bytes]:
        """The words between special tokens, as lists, and the special tokens' ids."""
        if "<|" not in text:
            return [self.split(text)]
        out, at = [], 0
        for found in self.special_pattern.finditer(text):
            out += [self.split(text[at : found.start()]), array("I", [self.special[found[0]]]).tobytes()]
            at = found.end()
        return [*out, self.split(text[at:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; new words are learned together."""
        met = self.met
        if self.held > WORD_MEMORY:  # long words are the least likely to be met again
            met = self.met = {w: x for w, x in met.items() if len(w) <= OFTEN}
            self.held = self.size(met)
            if self.held > WORD_MEMORY // 2:
                self.forget()
                met = self.met
        parts = [self.parts(text) for text in texts]
        new = list(set().union(*[x for text in parts for x in text if isinstance(x, list)]).difference(met))
        for at in range(0, len(new), LEARNED):
            self.learn(new[at : at + LEARNED])
        self.held += self.size({w: met[w] for w in new})
        known = met.__getitem__
        return [b"".join([b"".join(map(known, x)) if isinstance(x, list) else x for x in text]) for text in parts]

    @staticmethod
    def size(met: dict[str, bytes]) -> int:
        return sum(map(len, met)) + sum(map(len, met.values())) + ENTRY * len(met)

    def forget(self) -> None:
        self.met, self.held = {}, 0


class Vocabulary(Words):
    """Token tables of one file: words are encoded by guessing and testing pairs."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.names = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for name, i in [*ids.items(), *self.special.items()]:
            self.names[i] = name
        size = self.size_ = len(self.names)
        self.letter_ids = {c: (ids[c], ids[c + self.suffix]) for c in self.letters}
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.made_at = np.full(size, -1, np.int32)  # rank of the merge that makes a token; -1: a single letter
        ranks: dict[int, int] = {}  # by left id * size + right id
        made = []
        for a, b in spec["model"]["merges"]:
            pair = ids[a] * size + ids[b]
            if pair not in ranks:
                ranks[pair] = len(made)
                made.append(ids[a + b])
                if self.made_at[made[-1]] < 0:
                    self.made_at[made[-1]], self.left[made[-1]], self.right[made[-1]] = ranks[pair], ids[a], ids[b]
        self.rank, self.made = ranks, array("i", made)
        self.pair_keys = np.fromiter(ranks, np.int64, len(ranks))
        order = np.argsort(self.pair_keys)
        self.pair_keys, self.pair_ranks = self.pair_keys[order], order.astype(np.int32)  # ranks count up in file order
        # Only tokens that merging their own letters gives back may be guessed.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for name, i in ids.items():
            ends = name.endswith(self.suffix) and name != self.suffix
            text = name[: -len(self.suffix)] if ends else name
            if text and (self.made_at[i] < 0 or self.merge(self.symbols(text, ends)) == [i]):
                (self.final if ends else self.inner)[text] = i
        self.longest = max(map(len, [*self.inner, *self.final]))

    def symbols(self, word: str, ends: bool = True) -> list[int]:
        return [self.letter_ids[c][0] for c in word[:-1]] + [self.letter_ids[word[-1]][ends]]

    def merge(self, tokens: list[int]) -> list[int]:
        """Exact merging: always the pair of lowest rank, the leftmost of equals."""
        rank, made, size, n = self.rank, self.made, self.size_, len(tokens)
        if n <= SHORT:
            tokens = list(tokens)
            ranks = [rank.get(a * size + b, UNMERGED) for a, b in zip(tokens, tokens[1:])]
            while ranks and (best := min(ranks)) != UNMERGED:
                i = ranks.index(best)
                tokens[i : i + 2] = [made[best]]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = rank.get(tokens[i] * size + tokens[i + 1], UNMERGED)
                if i:
                    ranks[i - 1] = rank.get(tokens[i - 1] * size + tokens[i], UNMERGED)
            return tokens
        tokens, after, before = list(tokens), list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [a * size + b for a, b in zip(tokens, tokens[1:])]
        waiting = [(rank[p], i, p) for i, p in enumerate(pairs) if p in rank]
        heapify(waiting)
        while waiting:
            best, i, pair = heappop(waiting)
            j = after[i]
            if j >= n or tokens[i] * size + tokens[j] != pair:
                continue  # one of the two has been merged meanwhile
            tokens[i], tokens[j] = made[best], -size
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := tokens[i] * size + tokens[k]) in rank:
                    heappush(waiting, (rank[new], i, new))
            h = before[i]
            if h >= 0 and (new := tokens[h] * size + tokens[i]) in rank:
                heappush(waiting, (rank[new], h, new))
        return [t for t in tokens if t >= 0]

    def guess(self, word: str) -> list[int]:
        """Greedy longest match from the left; the token at the end must be one that ends a word."""
        tokens, at, n = [], 0, len(word)
        while at < n:
            if n - at <= self.longest and (last := self.final.get(word[at:])) is not None:
                tokens.append(last)
                break
            for stop in range(min(n - 1, at + self.longest), at, -1):
                if (token := self.inner.get(word[at:stop])) is not None:
                    tokens.append(token)
                    at = stop
                    break
        return tokens

    def pairs_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For all pairs at once: does merging leave the border between the two tokens alone?

        The last merge inside either token is undone, the later one first.  If the tokens that touch
        at the border could be merged earlier than the merge just undone, merging would have crossed
        the border.  With nothing left to undo the pair holds.
        """
        x, y = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(x), NO_LIMIT)
        fine, live = np.ones(len(x), bool), np.arange(len(x))
        size = self.size_
        while len(live):
            p, q, most = x[live], y[live], limit[live]
            at = np.minimum(np.searchsorted(self.pair_keys, p * size + q), len(self.pair_keys) - 1)
            found = self.pair_keys[at] == p * size + q
            crossed = found & (self.pair_ranks[at] < most)
            fine[live[crossed]] = False
            mx, my = self.made_at[p], self.made_at[q]
            undo_left = mx > my  # of equal merges the left one happens first, so it is undone last
            go = ~crossed & ((mx >= 0) | (my >= 0))
            left, right = live[go & undo_left], live[go & ~undo_left]
            limit[left] = self.made_at[x[left]]
            x[left] = self.right[x[left]]
            limit[right] = self.made_at[y[right]] + 1  # on the left of it, an equal rank would have gone first
            y[right] = self.left[y[right]]
            live = live[go]
        return fine

    def learn(self, words: list[str]) -> None:
        """Encode words not met before."""
        letters, met = self.letters, self.met
        spelled = ["".join([letters[b] for b in w.encode()]) for w in words]
        guesses = [self.guess(w) for w in spelled]
        sizes = np.array([len(g) for g in guesses])
        tokens = np.array([t for g in guesses for t in g], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(tokens[inside] * len(self.names) + tokens[inside + 1], return_inverse=True)
        fits = self.pairs_compatible(*np.divmod(pairs, len(self.names)))[back]
        wrong = np.zeros(len(words), bool)
        wrong[word[inside[~fits]]] = True
        for w, spelling, guess, failed in zip(words, spelled, guesses, wrong.tolist()):
            met[w] = array("I", self.merge(self.symbols(spelling)) if failed else guess).tobytes()

    def decode(self, ids: bytes) -> str:
        """Token strings joined by spaces, as the library does for a file without a decoder."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = TOGETHER) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows of a task and their texts, about ``most`` characters at a time; null counts as empty."""
    for batch in batches:
        texts, start, chars = [], 0, 0
        for i, value in enumerate(batch.column(text)):
            texts.append(value.as_py() or "")
            chars += len(texts[-1])
            if chars >= most or i == len(batch) - 1:
                yield batch.slice(start, len(texts)), texts
                texts, start, chars = [], i + 1, 0


@shielded("text", adds=("out", "decoded"))
def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add ``out``: the token ids of ``text``, packed as little-endian unsigned 32-bit integers.

    With ``decoded``, also add a column of that name with the text the ids decode to, in the same pass.
    ``path`` names the vocabulary file on every executor.  All other columns pass unchanged.  A null
    text gives an empty value; an empty table gives an empty table.  Rows are handed on in slices of bounded
    length, and a task's tables and words go with it: a Python worker outlives its tasks.
    """
    new = [out] if decoded is None else [out, decoded]
    rest = docs.drop(*[c for c in new if c != text])
    schema = T.StructType([*rest.schema.fields, T.StructField(out, T.BinaryType())])
    if decoded is not None:
        schema = schema.add(decoded, T.StringType())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(path)
        try:
            for rows, texts in slices(batches, text):
                ids = words.encode(texts)
                columns = [*rows.columns, pa.array(ids, pa.binary())]
                if decoded is not None:
                    columns.append(pa.array([words.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, *new])
        finally:
            words = rows = texts = ids = columns = None
            give_back()

    return rest.mapInArrow(coded, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of packed ``ids``.  Null or empty ids give the empty string."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Vocabulary(path)
        for batch in batches:
            yield pd.Series([words.decode(bytes(x)) if x is not None else "" for x in batch], dtype=object)

    return docs.withColumn(out, text(F.col(ids)))
