"""One query per operator, over its whole table, in the form its contract asks for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartmill.llm import conversations, divergence, html, idfiles, language, licences, maxscore, mixing, neardup, neighbours, repeats, secrets, tokens
from chartmill.llm.base import ORACLE, QUERIES, query, table

__all__ = ["ORACLE", "QUERIES"]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@query("op1_near_duplicates")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_html")
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = tokens.encode(docs, VOCABULARY, decoded="decoded")
    return coded.select(
        "doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit(docs.where(~language.held_out("doc_id")))
    rows = docs.select("doc_id", "text", language.held_out("doc_id").alias("held_out"))
    return language.predict(rows, profiles).select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score")
    )


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, keep_text=False)
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"),
    )


@query("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder per source, within it folders by thousands and by fifties of ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    name = F.concat(F.col("doc_id"), F.lit(".txt"))
    path = F.concat("source", F.lit("/"), F.expr("doc_id div 1000"), F.lit("/"), F.expr("doc_id div 50"), F.lit("/"), name)
    found = licences.detect(docs.withColumn("path", path))
    return found.select("doc_id", "path", "licence", "score", "origin", "origin_dir")


@query("op6_repeats")
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    return left.select(
        "doc_id", n_bytes.cast("long").alias("n_bytes"), (n_bytes - F.length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


# English counts twice among the languages; everything else has the same weight as its siblings.
LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"lang": {"en": 2.0}}


def with_domain(docs: DataFrame) -> DataFrame:
    """Sources fall into four domains by their checksum."""
    return docs.withColumn("domain", F.concat(F.lit("domain"), F.crc32(F.col("source").cast("binary")) % 4))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    counted = docs.withColumn("n_tokens", mixing.words("text"))
    mixed = mixing.mix(counted, LEVELS, WEIGHTS, share=0.5, max_epochs=2, seed=7, tokens=F.col("n_tokens"))
    return mixed.select("doc_id", *LEVELS, "epoch", "n_tokens")


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


# Scores of all pairs of a query and another row, as the contract defines them.
OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)
  where q.vec_id % 50 = 0
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 5
"""


@query("op10_maxscore", OP10_SQL)
def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query("op12_id_files")
def op12_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = idfiles.through_files(table(spark, sf_dir, "documents"), VOCABULARY, end_id=2)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# The definition term by term, over every term and pair of sources.
OP11_SQL = r"""
with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as doc,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'
    ) as terms
  from documents
), groups as (select distinct lang, source from d
), used as (select lang, source, doc, unnest(terms) as term from d
), kept as (select lang, term, count(*)::hugeint as total from used group by all having count(distinct doc) >= 30
), size as (select lang, count(*) as v, sum(total) as lang_uses from kept group by lang
), counted as (select lang, source, term, count(*) as n from used group by all
), cell as (
  select g.lang, g.source, k.term, coalesce(n, 0)::hugeint as n, k.total
  from groups g join kept k on k.lang = g.lang left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
), uses as (select lang, source, sum(n) as uses from cell group by all
), shares as (
  select c.lang, c.source, c.term, c.n, 1 + (1000000000 * (n + 5)) // (uses + 5 * v) as p, 1 + (1000000000 * (total + 5)) // (lang_uses + 5 * v) as q
  from cell c join uses u on u.lang = c.lang and u.source = c.source join size s on s.lang = c.lang
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term group by all
  ) f on f.lang = a.lang and f.source = a.source and f.item = b.source
), terms as (select lang, source, term as item, (p - q)::bigint as value from shares where n > 0 and p > q
), parts as (select *, 'pair' as part from pairs union all select *, 'term' as part from terms
), ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank from parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""


@query("op11_divergence", OP11_SQL)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_conversations")
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.Repair(conversations.damage(table(spark, sf_dir, "conversations")), present="present").reports()
