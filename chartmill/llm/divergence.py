"""How far the sources of a language differ in their words, from run-length encoded count columns.

A term is a run of letters, ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, with A-Z in lower case.  A language keeps the
terms found in at least ``LEAST_DOCS`` of its documents.  Each source, and the language as a whole, gives a
kept term ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))`` with N the source's occurrences of
kept terms and V their number.  Two sources differ by the sum of ``|p - q|`` over all kept terms.

That sum needs no term by term comparison.  The vocabulary is put in an order in which terms with equal
counts in every source lie together, by a distributed sort of the count vectors; equal vectors collapse to
one entry with a length.  The order is cut into blocks.  Within a block each source is a column of runs of
equal counts; the runs of two sources are intersected, and ``|p - q|`` of each piece is multiplied by its
length.  Blocks add up, so no task sees a whole vocabulary, and a column is never longer than a block.

Null text, language and source count as ''.  A source without terms has counts of 0; a language without
kept terms has differences of 0.  An empty table gives an empty result.  Repeated rows count repeatedly, as
documents too.  Columns besides text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.llm.base import give_back, written

SCALE = 1_000_000_000
PRIOR = 5
LEAST_DOCS = 30
TOP_TERMS = 50
# Distinct count vectors in a block.
BLOCK = 1024
# Entries of a count vector that take part in dealing vectors by ranges.
HEAD = 2
# Bytes of counters a task holds before it hands them on, and rows of a batch handed on.
HELD = 64_000_000
OUT_ROWS = 20_000

# Bytes of a term stay, A-Z in lower case; all others separate terms.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term by (lang, source), added up within the task.

    A row without a term says that the group occurs at all.
    """
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (uses, docs) in groups.items():
            words = [None, *uses]
            for at in range(0, len(words), OUT_ROWS):
                part = words[at : at + OUT_ROWS]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part)), pa.array([source] * len(part)),
                    pa.array([w if w is None else w.decode() for w in part], pa.string()),
                    pa.array([0 if w is None else uses[w] for w in part], pa.int64()),
                    pa.array([0 if w is None else docs[w] for w in part], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for text, lang, source in zip(*[batch.column(c) for c in ("text", "lang", "source")]):
            uses, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            terms = terms_of(text.as_py())
            distinct = set(terms)
            fresh = distinct.difference(docs)
            held += sum(map(len, fresh)) + 300 * len(fresh)
            uses.update(terms)
            docs.update(distinct)
            if held > HELD:
                yield from handed_on()
                groups, held = {}, 0
    yield from handed_on()
    groups = {}
    give_back()


def _sum(name: str) -> Column:
    return F.sum(name).cast("long").alias(name)


def vocabulary(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """A row per kept term of a language: ``lang, term, total, counts``; ``counts`` lists (source, n), n > 0.

    One more row per language, with a null term, lists all of its sources.
    """
    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        *[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))],
    )
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # Tasks have added up their own rows, so a term has one row per task and source; both groupings share one shuffle.
    by_source = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(_sum("n"), _sum("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        _sum("docs"), F.sum("n").cast("long").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts")
    )
    return by_term.where(F.col("term").isNull() | (F.col("docs") >= least_docs)).select("lang", "term", "total", "counts")


def _groups(words: DataFrame) -> DataFrame:
    """``lang, source, uses`` (of kept terms) of every source, sources without terms included."""
    each = words.select("lang", F.explode("counts").alias("c"))
    return each.groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").cast("long").alias("uses"))


def _languages(words: DataFrame) -> DataFrame:
    """``lang, lang_uses, kept`` of every language."""
    return words.groupBy("lang").agg(F.sum("total").cast("long").alias("lang_uses"), F.count("term").alias("kept"))


def share(count: str, uses: str, kept: str) -> Column:
    """p as defined above, exact however large the counts are."""
    return F.expr(
        f"1L + ({SCALE}BD * cast({count} + {PRIOR} as decimal(19, 0))) div cast({uses} + {PRIOR} * {kept} as decimal(19, 0))"
    )


def distinctive_terms(words: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The ``top`` terms of each source by how far p exceeds the language's p."""
    each = words.where("term is not null").select("lang", "term", "total", F.explode("counts").alias("c")).select(
        "lang", F.col("c.source").alias("source"), "term", F.col("c.n").alias("n"), "total"
    )
    known = each.join(_groups(words).join(_languages(words), "lang"), ["lang", "source"])
    value = share("n", "uses", "kept") - share("total", "lang_uses", "kept")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        known.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )


def runs(counts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length code of a column whose entries stand for ``lengths`` terms each: run ends, run values."""
    last = np.flatnonzero(np.append(counts[1:] != counts[:-1], True))
    return np.cumsum(lengths)[last], counts[last]


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of ``|p - q|`` over two columns of runs: their borders are intersected, each piece taken by its length."""
    ends = np.union1d(a[0], b[0])
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    return int((np.abs(p - q) * np.diff(ends, prepend=0)).sum())


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a language's vocabulary, what it adds to the difference of each pair of sources."""
    for batch in batches:
        for lang, kept, sources, block in zip(*[batch.column(c) for c in ("lang", "kept", "sources", "block")]):
            lang, kept, sources = lang.as_py(), kept.as_py(), sources.as_py()
            place = {s["source"]: i for i, s in enumerate(sources)}
            entries = block.as_py() or []
            counts = np.zeros((len(sources), len(entries)), np.int64)
            for k, entry in enumerate(entries):
                for c in entry["counts"]:
                    counts[place[c["source"]], k] = c["n"]
            lengths = np.array([entry["length"] for entry in entries], np.int64)
            columns = []
            for column, s in zip(counts, sources):
                ends, values = runs(column, lengths) if entries else (np.zeros(1, np.int64), np.zeros(1, np.int64))
                below = s["uses"] + PRIOR * kept
                p = [1 + SCALE * (n + PRIOR) // below if below else 0 for n in values.tolist()]
                columns.append((ends, np.array(p, np.int64)))
            for i, a in enumerate(sources):
                others = range(i + 1, len(sources))
                if len(others):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(others)), pa.array([a["source"]] * len(others)),
                        pa.array([sources[j]["source"] for j in others]),
                        pa.array([difference(columns[i], columns[j]) for j in others], pa.int64()),
                    ], ["lang", "a", "b", "value"])
    give_back()


def source_differences(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``lang, source, item, value, rank`` for every ordered pair of sources of a language."""
    sources = _groups(words).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "uses"))).alias("sources"))
    languages = _languages(words).select("lang", "kept").join(sources, "lang")
    vectors = words.where("term is not null").groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("length"))
    # A partition's rows are numbered in their order: the upper bits of the id are the partition, the lower count from 0.
    # Ranges are chosen by the first entries, because sampled range keys go to the driver.
    ordered = vectors.repartitionByRange("lang", F.slice("counts", 1, HEAD)).sortWithinPartitions("lang", "counts")
    number = F.monotonically_increasing_id()
    placed = ordered.withColumn("at", F.shiftright(number, 33) * 2**33 + F.floor(number % 2**33 / block))
    blocks = placed.groupBy("lang", "at").agg(F.sort_array(F.collect_list(F.struct("counts", "length"))).alias("block"))
    nothing = languages.where("kept = 0").select("lang", F.lit(-1).cast("long").alias("at"), F.lit(None).cast(blocks.schema["block"].dataType).alias("block"))
    met = blocks.unionByName(nothing).join(languages, "lang").select("lang", "kept", "sources", "block")
    halves = met.mapInArrow(_differences, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(_sum("value"))
    both = halves.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("pair"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.select("lang", F.col("pair.a").alias("source"), F.col("pair.b").alias("item"), "value").withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS, block: int = BLOCK,
) -> DataFrame:
    """Both parts as one table: ``lang, source, part, item, value, rank``.

    ``pair`` rows rank the other sources of the language by their difference, ``term`` rows a source's
    most distinctive terms.
    """
    words = written(vocabulary(docs, text, lang, source, least_docs), "vocabulary")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_differences(words, block).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(distinctive_terms(words, top).withColumn("part", F.lit("term")).select(*columns))
