"""Token ids in binary files: one concatenated array, and the borders of documents as Elias-Fano codes.

A folder holds ``.ids`` files and a Parquet table ``manifest`` with a row per file.  A file is

* the ids of its documents one after the other, little-endian unsigned, 16 bits wide where all ids fit;
* the borders of the documents in that array, and their keys, each an Elias-Fano code;
* a footer in JSON with the places of these sections, its length in four bytes, and eight bytes ``MAGIC``.

Documents lie in ascending order of their key over all files: rows are dealt by ranges of the key, sorted,
and each task writes the files of its range.  Where a document starts in the whole corpus is where it starts
in its file plus the ids of the files before.  A file is named by the task's attempt and counts only once
the manifest names it, so a task that is repeated or lost leaves nothing behind that is read.

Null text counts as empty text.  Null keys come first.  Documents with equal keys are ordered by a hash of
their text, then by the text; which of two equal rows comes first cannot be told.  Columns besides key and
text are not stored.  An empty table gives an empty folder, which reads as no documents.
"""

from __future__ import annotations

import json
import uuid
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chartmill.llm.base import give_back
from chartmill.llm.eliasfano import STEP, EliasFano
from chartmill.llm.tokens import TOGETHER, Words, slices
from chartmill.session import scratch_dir

MAGIC = b"EFIDS\x00\x00\x01"
# A task begins a new file beyond about this many ids or documents; the sections of one file are held in memory.
FILE_IDS = 1 << 26
FILE_DOCS = 1 << 20
# Ids handed on at a time while reading; one document may have more.
READ_IDS = 1 << 19

MANIFEST = "task int, number int, file string, n_docs long, n_ids long"


@cache
def loaded(path: str):
    """A tokenizer, its model and its largest id, once per worker: the library does not free all that loading a model took."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return library, library.model, max(library.get_vocab(with_added_tokens=True).values())


class LibraryWords(Words):
    """Words encoded by the tokenizers library's model, each once: what surrounds a word does not matter to it."""

    def __init__(self, path: str):
        library, self.model, self.largest = loaded(path)
        super().__init__(path, library)
        self.letter_of = dict(enumerate(self.letters))

    def learn(self, words: list[str]) -> None:
        tokenize, letter_of = self.model.tokenize, self.letter_of
        for word in words:
            spelled = word.encode().decode("latin-1").translate(letter_of)
            self.met[word] = array("I", [token.id for token in tokenize(spelled)]).tobytes()


class FileWriter:
    """One file under way: ids go out as they come, borders and keys wait for the footer."""

    def __init__(self, filesystem: fs.FileSystem, path: str, width: int):
        self.path, self.width = path, width
        self.stream = filesystem.open_output_stream(path)
        self.ids = self.nulls = 0
        self.borders, self.keys = [np.zeros(1, np.int64)], []
        self.docs = 0

    def add(self, keys: pa.Array, ids: list[bytes]) -> None:
        """Documents in ascending order of their keys, their ids as unsigned 32-bit integers."""
        flat = b"".join(ids)
        self.stream.write(flat if self.width == 4 else np.frombuffer(flat, "<u4").astype("<u2").tobytes())
        ends = self.ids + np.cumsum([len(x) // 4 for x in ids])
        self.borders.append(ends)
        self.nulls += keys.null_count
        self.keys.append(keys.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        self.ids, self.docs = int(ends[-1]), self.docs + len(ids)

    def close(self) -> None:
        footer = {"width": self.width, "docs": self.docs, "nulls": self.nulls, "ids": self.ids}
        for name, values in (("borders", self.borders), ("keys", self.keys)):
            footer[name], parts = EliasFano.of(np.concatenate(values)).sections()
            for part in parts:
                self.stream.write(part)
        text = json.dumps(footer).encode()
        self.stream.write(text + len(text).to_bytes(4, "little") + MAGIC)
        self.stream.close()


class FileReader:
    """Random access to one file: any document is found without reading those before it."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.file = filesystem.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12) if size >= 12 else b""
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        length = int.from_bytes(tail[:4], "little")
        footer = json.loads(self.file.read_at(length, size - 12 - length))
        self.width, self.docs, self.nulls, self.ids = (footer[k] for k in ("width", "docs", "nulls", "ids"))
        at, codes = self.ids * self.width, {}
        for name in ("borders", "keys"):
            numbers = footer[name]
            n = numbers["low"] + numbers["high"] + 4 * -(-numbers["count"] // STEP)
            codes[name] = EliasFano.read(numbers, memoryview(self.file.read_at(n, at)))
            at += n
        self.borders, self.keys = codes["borders"], codes["keys"]

    def tokens(self, start: int, stop: int) -> np.ndarray:
        data = self.file.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document."""
        return self.tokens(*self.borders.range(i, i + 2).tolist())

    def batches(self) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """Keys, borders and ids of the documents in order, about ``READ_IDS`` ids at a time."""
        at = 0
        while at < self.docs:
            borders = self.borders.range(at, min(at + 4096, self.docs) + 1)
            n = max(1, int(np.searchsorted(borders, borders[0] + READ_IDS, "right")) - 1)
            borders = borders[: n + 1]
            keys = [None] * max(0, min(self.nulls - at, n))
            first = at + len(keys) - self.nulls
            keys += self.keys.range(first, first + n - len(keys)).tolist()
            yield keys, borders, self.tokens(int(borders[0]), int(borders[-1]))
            at += n

    def close(self) -> None:
        self.file.close()


def write(
    docs: DataFrame, vocabulary: str, folder: str, text: str = "text", key: str = "doc_id", end_id: int | None = None,
    file_ids: int = FILE_IDS,
) -> None:
    """Encode whole texts and write them to a new ``folder`` all executors can reach, in ascending order of ``key``.

    ``vocabulary`` names the tokenizer's file on every executor; ``end_id`` is appended to each document.  A task
    begins a new file beyond ``file_ids`` ids.
    """
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text").select("key", "text")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root)
        task, attempt, done = TaskContext.get().partitionId(), uuid.uuid4().hex, []
        words, file = LibraryWords(vocabulary), None
        width = 2 if max(words.largest, end_id or 0) < 1 << 16 else 4

        def finish() -> None:
            file.close()
            done.append({"task": task, "number": len(done), "file": file.path.rsplit("/", 1)[1], "n_docs": file.docs, "n_ids": file.ids})

        for part, texts in slices(batches, "text", min(TOGETHER, file_ids)):
            if file is not None and (file.ids >= file_ids or file.docs >= FILE_DOCS):
                finish()
                file = None
            if file is None:
                file = FileWriter(filesystem, f"{root}/part-{task:06d}-{len(done):04d}-{attempt}.ids", width)
            file.add(part.column("key"), [ids + end for ids in words.encode(texts)])
        if file is not None:
            finish()
        words = None
        give_back()
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([
            ("task", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
        ]))

    dealt.mapInArrow(files, MANIFEST).write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``.

    ``ids`` are packed as little-endian unsigned 32-bit integers.  The running total goes over one row
    per file, the manifest; files themselves are read by as many tasks as there are.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))
    files = placed.select("task", "number", "file", "before").repartitionByRange(max(1, manifest.count()), "task", "number")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                reader = FileReader(filesystem, f"{root}/{row['file']}")
                for keys, borders, ids in reader.batches():
                    flat, cuts = memoryview(ids.tobytes()), (borders - borders[0]) * 4
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, pa.int64()), pa.array(borders[:-1] + row["before"]), pa.array(np.diff(borders)),
                        pa.array([flat[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary()),
                    ], ["doc_id", "start", "n_tokens", "ids"])
                reader.close()
        give_back()

    return files.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def through_files(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", end_id: int | None = None) -> DataFrame:
    """Write the documents to a fresh folder under the shared scratch folder, and read them back."""
    folder = scratch_dir(docs.sparkSession, "ids")
    write(docs, vocabulary, folder if "://" in folder else f"file://{folder}", text, key, end_id)
    return read(docs.sparkSession, folder if "://" in folder else f"file://{folder}")
