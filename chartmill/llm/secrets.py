"""Secret scanning, with multipart credentials linked by an interval join.

Three kinds are secrets by their form alone: assignments, access keys and long hexadecimal runs.  Three
more are weak: an endpoint, an account name, or a random-looking word is no secret by itself.  A weak
part is reported only if a part of a complementary role lies within its scope, the characters around
it.  Parts meet by a join on document and cell of the text, so their number stays in proportion to the
parts, however long the document.

Null and empty text has no parts.  Repeated rows get the same spans each.  Offsets are code points,
ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from chartmill.llm.base import shielded, written

# The base patterns, in the order their kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8

ENDPOINT = re.compile(r"(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqps?|ftp|ssh)://[^\s\"'<>]+", re.A)
ACCOUNT = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
ACCOUNT_WORDS = ("user", "login", "account", "client")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_ENTROPY = 3.5

KINDS = ("assign", "access", "hex", "endpoint", "account", "random")
ROLES = {"assign": "secret", "access": "name", "hex": "secret", "endpoint": "place", "account": "name", "random": "secret"}
SCOPE = 200

PART = "array<struct<kind:string,start:int,end:int>>"


def entropy(word: str) -> float:
    return -sum(n / len(word) * log2(n / len(word)) for n in Counter(word).values())


def base_parts(text: str, low: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    out = []
    if any([word in low for word in ASSIGN_WORDS]):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def weak_parts(text: str, low: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out = []
    if "://" in text:
        out += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    if any([word in low for word in ACCOUNT_WORDS]):
        out += [("account", m.start(), m.end()) for m in ACCOUNT.finditer(text)]
    taken = sorted([(start, end) for _, start, end in [*base, *out]])
    k = 0
    for m in WORD.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        free = k == len(taken) or taken[k][0] >= m.end()
        word = m[0]
        if free and re.search(r"\d", word) and re.search("[a-z]", word) and re.search("[A-Z]", word) and entropy(word) >= LEAST_ENTROPY:
            out.append(("random", m.start(), m.end()))
    return out


def scan(docs: DataFrame, text: str = "text", base: str = "_base", weak: str = "_weak") -> DataFrame:
    """Add the parts of each text: ``base`` secrets and ``weak`` candidates."""

    @F.pandas_udf(f"struct<base:{PART},weak:{PART}>")
    def parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                body = value if isinstance(value, str) else ""
                low = body.lower()
                found = base_parts(body, low)
                candidates = weak_parts(body, low, found)
                rows.append([[dict(zip(("kind", "start", "end"), p)) for p in x] for x in (found, candidates)])
            yield pd.DataFrame(rows, columns=["base", "weak"], dtype=object)

    return docs.withColumn("_parts", parts(F.col(text))).select("*", F.col("_parts.base").alias(base), F.col("_parts.weak").alias(weak)).drop("_parts")


def roles(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[kind]


def link(parts: DataFrame, keys: list[str], scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part within ``scope`` characters: an interval join.

    ``parts`` has the keys, kind, start, end and a boolean weak.  A part is put into each cell of
    ``scope`` characters that it touches, a weak one also into those its scope touches; parts meet in
    a cell.  A cell holds a bounded number of parts, and a part found in several cells counts once.
    """
    placed = parts.withColumn("_role", roles(F.col("kind")))
    reach = placed.where("weak").withColumn("_cell", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    others = placed.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_role").alias("_other"), F.col("start").alias("_from"), F.col("end").alias("_to"),
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("_at"),
    )
    near = [reach[k].eqNullSafe(others[f"_{k}"]) for k in keys]
    near += [reach["_cell"] == others["_at"], reach["_role"] != others["_other"]]
    near += [others["_from"] <= reach["end"] + scope, others["_to"] >= reach["start"] - scope]
    return reach.join(others, near, "left_semi").select(*keys, "kind", "start", "end").distinct()


@shielded("text", adds=("out",))
def find(docs: DataFrame, text: str = "text", out: str = "spans", keep_text: bool = True, scope: int = SCOPE) -> DataFrame:
    """Add ``out``: all reported spans of a text by start, then kind as listed in ``KINDS``.

    Rows are told apart by content while weak parts are linked, so null and repeated ids do no harm.
    With ``keep_text`` off the text column is dropped, which spares writing it.
    """
    key = F.sha2(F.col(text), 256)
    scanned = scan(docs, text).withColumn("_key", key)
    scanned = written(scanned if keep_text else scanned.drop(text), "secrets")
    weak_rows = scanned.where(F.size("_weak") > 0)
    texts = weak_rows.select("_key", "_base", "_weak").dropDuplicates(["_key"])
    each = [texts.select("_key", F.inline(c), F.lit(c == "_weak").alias("weak")) for c in ("_base", "_weak")]
    linked = link(each[0].unionAll(each[1]), ["_key"], scope)
    linked = linked.groupBy("_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_linked"))
    none = F.array().cast(PART)
    rows = scanned.where(F.size("_weak") == 0).withColumn("_linked", none).unionByName(
        weak_rows.join(linked, "_key", "left").withColumn("_linked", F.coalesce("_linked", none)).select(*scanned.columns, "_linked")
    )
    rank = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    ordered = F.array_sort(F.transform(F.concat("_base", "_linked"), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.withColumn(out, spans).drop("_key", "_base", "_weak", "_linked")


@shielded("text")
def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """Replace every reported span but endpoints by ``mask``; overlapping spans are masked once."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for body, found in zip(texts, spans):
            if body is None or not len(found):
                out.append(body)
                continue
            pieces, at = [], 0
            for s in found:
                if s["kind"] == "endpoint" or s["end"] <= at:
                    continue
                if s["start"] >= at:
                    pieces += [body[at : s["start"]], mask]
                at = s["end"]
            out.append("".join([*pieces, body[at:]]))
        return pd.Series(out, dtype=object)

    return find(docs, text, "_spans").withColumn(text, masked(F.col(text), F.col("_spans"))).drop("_spans")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
