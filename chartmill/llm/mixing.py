"""Mixing sources to target weights under a token budget.

Documents hang on a tree, for instance domain, language, source.  The budget runs down from the root:
siblings share their parent's budget by weight, and what a node cannot fill goes to its siblings by
weight before anything is left to the nodes above.  Each leaf then takes whole epochs of its documents
and a prefix of one more, in an order seeded by epoch.

The number of tree nodes may grow, their sums are all that is gathered per node.  No task ever sorts a
leaf: documents fall into buckets by their order key, buckets are summed, and only the one bucket in
which the budget ends is looked into.

A null level is a node of its own.  Null or empty text has no tokens; such documents are taken whenever
their place in the order is.  Rows alike in id and text share a place.  A prefix never exceeds the budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.llm.base import shielded, written

BUCKET_ROWS = 20_000
KEY_DIGITS = 12  # hexadecimal digits of the order key that buckets are made of


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, ids: Sequence[str], digest: str) -> Column:
    """Where a document stands in an epoch's order: a hexadecimal string, alike for alike rows.

    ``digest`` is the MD5 of its text.
    """
    parts = [F.lit(str(seed)), epoch.cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids], F.coalesce(digest, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def _paths(levels: Sequence[str]) -> list[Column]:
    """The key of each ancestor of a row, from the first level to the leaf; nulls are told apart."""
    return [F.to_json(F.array(*[F.col(c).cast("string") for c in levels[: k + 1]])) for k in range(len(levels))]


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], total: Column, max_epochs: int) -> DataFrame:
    """Add ``budget`` (double) to ``leaves``, which has the levels and ``available`` tokens.

    ``weights`` gives, for a level, the weight of a node by its name; 1 where it says nothing.
    Of sorted siblings with capacity c and weight w, the level up to which all are filled is the
    largest of (budget - capacities before) / (weights from here on).
    """
    nodes = leaves.withColumn("_cap", F.col("available").cast("double") * max_epochs)
    for k, path in enumerate(_paths(levels)):
        nodes = nodes.withColumn(f"_p{k}", path)
    nodes = nodes.withColumn("_budget", total.cast("double"))
    above: list[str] = []
    for k, level in enumerate(levels):
        here = f"_p{k}"
        given = [F.lit(x) for pair in weights.get(level, {}).items() for x in pair]
        weight = F.coalesce(F.create_map(*given)[F.col(level).cast("string")], F.lit(1.0)) if given else F.lit(1.0)
        siblings = nodes.withColumn("_w", weight.cast("double")).groupBy(*above, here).agg(
            F.sum("_cap").alias("_cap"), F.first("_w").alias("_w"), F.first("_budget").alias("_budget")
        )
        fill = F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w")).otherwise(F.lit(float("inf")))
        among = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = among.orderBy(fill, here)
        before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        reach = F.when(rest > 0, (F.col("_budget") - before) / rest).otherwise(F.lit(0.0))
        siblings = siblings.withColumn("_reach", reach).withColumn("_level", F.greatest(F.max("_reach").over(among), F.lit(0.0)))
        shared = siblings.select(F.col(here).alias("_at"), F.least("_cap", F.col("_w") * F.col("_level")).alias("_share"))
        nodes = nodes.join(shared, F.col(here) == F.col("_at")).drop("_at").withColumn("_budget", F.col("_share")).drop("_share")
        above.append(here)
    return nodes.withColumn("budget", F.col("_budget")).drop("_cap", "_budget", *above)


def mix(
    docs: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], share: float, max_epochs: int = 1, seed: int = 0,
    text: str = "text", ids: Sequence[str] = ("doc_id",), tokens: Column | None = None, epoch: str = "epoch", bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The chosen rows of ``docs``, once per epoch they are in, with the number of the ``epoch`` from 0.

    The budget is ``share`` of all tokens of ``docs``.  No document is taken more than ``max_epochs`` times.
    """
    size = "_size"
    while size in docs.columns:
        size += "_"
    sized = docs.withColumn(size, tokens if tokens is not None else words(text))
    return _mix(sized, list(levels), weights, share, max_epochs, seed, text, list(ids), size, epoch, bucket_rows).drop(size)


@shielded("levels", "text", "ids", "size", adds=("epoch",))
def _mix(
    docs: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], share: float, max_epochs: int, seed: int,
    text: str, ids: Sequence[str], size: str, epoch: str, bucket_rows: int,
) -> DataFrame:
    counted = docs.withColumn("_digest", F.md5(text)).withColumn("_leaf", _paths(levels)[-1])
    slim = counted.withColumn("_tokens", F.col(size))
    slim = slim.select(*dict.fromkeys([*levels, *ids]), "_digest", "_tokens", "_leaf")
    leaves = slim.groupBy("_leaf", *levels).agg(F.sum("_tokens").alias("available"), F.count(F.lit(1)).alias("_n"))
    whole = leaves.agg((F.coalesce(F.sum("available"), F.lit(0)) * share).alias("_total"))
    planned = leaves.join(F.broadcast(whole))  # one row
    planned = budgets(planned, levels, weights, F.col("_total"), max_epochs)
    full = F.when(F.col("available") > 0, F.floor((F.col("budget") + 1e-6) / F.col("available"))).otherwise(F.lit(0))
    plan = planned.select(
        "_leaf", F.least(full, F.lit(max_epochs)).cast("int").alias("_full"), "available",
        F.floor(F.col("budget") + 1e-6).cast("long").alias("_budget"), F.greatest(F.ceil(F.col("_n") / bucket_rows), F.lit(1)).alias("_buckets"),
    ).withColumn("_rest", F.when(F.col("_full") >= max_epochs, F.lit(0)).otherwise(F.col("_budget") - F.col("_full") * F.col("available")))

    plan = written(plan, "plan")  # one row per leaf: joins see its size
    placed = slim.join(plan.select("_leaf", "_full", "_buckets", "_rest"), "_leaf").withColumn("_key", order_key(seed, F.col("_full"), ids, "_digest"))
    part = F.conv(F.substring("_key", 1, KEY_DIGITS), 16, 10).cast("double") / float(16**KEY_DIGITS)
    placed = placed.select("_leaf", "_rest", "_key", "_tokens", F.floor(part * F.col("_buckets")).alias("_bucket"))
    sums = placed.groupBy("_leaf", "_rest", "_bucket").agg(F.sum("_tokens").alias("_sum"))
    running = F.sum("_sum").over(Window.partitionBy("_leaf").orderBy("_bucket"))
    last = sums.withColumn("_to", running).where("_to > _rest")
    last = last.groupBy("_leaf").agg(F.min("_bucket").alias("_bucket"), F.min(F.col("_to") - F.col("_sum")).alias("_before"))
    ends = placed.join(last, ["_leaf", "_bucket"]).groupBy("_leaf", "_rest", "_before", "_key").agg(F.sum("_tokens").alias("_t"))
    taken = F.col("_before") + F.sum("_t").over(Window.partitionBy("_leaf").orderBy("_key"))
    over = ends.withColumn("_to", taken).where("_to > _rest").groupBy("_leaf").agg(F.min("_key").alias("_stop"))

    # A leaf without a stop takes all of its further epoch, unless it has had every epoch already.
    stops = written(plan.select("_leaf", "_full").join(over, "_leaf", "left"), "stops")
    chosen = counted.join(stops, "_leaf").withColumn("_key", order_key(seed, F.col("_full"), ids, "_digest"))
    more = (F.col("_full") < max_epochs) & F.coalesce(F.col("_key") < F.col("_stop"), F.lit(True))
    times = F.col("_full") + more.cast("int")
    return chosen.withColumn("_times", times).where("_times > 0").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias(epoch)
    )
