"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a token target. The mix is made of blocks of equal size, the seats: the highest
quotients hand them out as integer quotas, first to the sources, then to the shards of each source, a
shard being a set of documents picked by a seeded hash. The last block of a source is a partial one, so
that its target is met to the word. Within a shard the documents form one long text in seeded order; the
quota is met by whole passes over it and a seeded, evenly spaced choice of its blocks, the last of which
is cut to what is left. Blocks have the same size whatever the sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE_CLASS, staged, text_or_empty, words

SEED = 17
#: Words of a block.
BLOCK = 64
#: Documents a shard holds on average.
SHARD_DOCS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """`target` of every source: `share` of all words by weight, none above `most` times its size.

    `sizes`: `source`, `source_size`, one row per source. The weights repeat over the sources in
    code point order, null last. What a capped source leaves over is shared among the others by
    weight, which raises all of them to one common level per weight; sorted by the level at which
    each source is full, that level follows from running sums. One row per source is all that meets
    in one place.
    """
    everything = Window.partitionBy(F.lit(1))
    place = F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    by = F.array(*(F.lit(float(w)) for w in weights))
    rows = sizes.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.get(by, place % len(weights)).alias("weight"),
        place.alias("place"),
    )
    rows = rows.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = everything.orderBy("full_at", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = share * F.sum("source_size").over(everything)
    rows = rows.withColumn(
        "level",
        (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # the level rises while full sources are taken out and falls after the last of them
    raised = F.least(F.col("cap"), F.col("weight") * F.max("level").over(everything))
    return rows.select("source", "source_size", raised.alias("target"), (most * F.col("source_size")).alias("cap"))


def apportion(rows: DataFrame, group: Sequence[str], key: Sequence[str], weight: str, seats: str) -> DataFrame:
    """`quota`: the `seats` of each group, handed to its rows by highest quotients weight / (2 k + 1).

    A row holds the k-th seat when its quotient is among the highest, so all quotients above a
    cautious level are granted at once by rounding. Fewer than two seats per row are then left; each
    row offers the few that can still win, and those are ranked. Ties go to the smaller `key`, then
    to the earlier seat. A group without weight gets nothing.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    n, total = F.count("*").over(whole), F.sum(weight).over(whole)
    part = F.when(F.col(weight) > 0, F.col(weight) / total).otherwise(0.0)
    rounded = lambda s: F.floor(F.greatest(s, F.lit(0)) * part + 0.5).cast("long")
    columns = rows.columns
    rows = rows.withColumn("_low", rounded(F.col(seats) - n)).withColumn("_high", rounded(F.col(seats) + n) + 1)
    rows = rows.withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    offers = rows.withColumn("_k", F.explode(F.sequence("_low", "_high")))
    order = whole.orderBy(F.desc(F.col(weight) / (2 * F.col("_k") + 1)), *key, "_k")
    won = ((F.row_number().over(order) <= F.col("_left")) & (F.col(weight) > 0)).cast("long")
    offers = offers.withColumn("_won", won)
    return offers.groupBy(*columns).agg((F.first("_low") + F.sum("_won")).alias("quota"))


def _chosen(upto: Column) -> Column:
    """How many of a shard's first `upto` blocks the evenly spaced choice of `rest` among `blocks` holds."""
    at = lambda i: F.call_function("div", i * F.col("rest"), F.col("blocks"))
    return at(upto + F.col("offset")) - at(F.col("offset"))


def _chosen_before(position: Column, block: int) -> tuple[Column, Column]:
    """Words in chosen blocks among a shard's first `position` words, and whether the next word is in one."""
    i = F.call_function("div", position, F.lit(block).cast("long"))
    before, here = _chosen(i), _chosen(i + 1) - _chosen(i)
    return block * before + (position - i * block) * here, here > 0


def _taken_before(position: Column, block: int) -> Column:
    """Words taken of a shard's first `position` words, repeats counted."""
    return F.col("passes") * position + F.least(_chosen_before(position, block)[0], F.col("rest_words"))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: Sequence[str] = (),
    block: int = BLOCK,
    shard_docs: int = SHARD_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of `docs`: `id_col`, `row` (the columns `keep`), size, source_size, target, taken, and where it
    lies in its shard.

    `taken` counts the words of the row that the mix takes, repeats included; it is between 0 and
    `most` (a whole number) times the size. A null text has no words and a null source is a source
    of its own. Repeated rows are rows of their own; rows without id are dealt by their texts. Rows of one
    id, text and source may change places, no others: reruns agree, whatever the partitioning. Columns of
    any name are carried along. An empty table gives no rows.
    """
    size = F.size(words(text_or_empty(text_col))).cast("long")
    # rows without id, and those of one id, are told apart by their texts
    row_key = F.xxhash64(F.lit(seed), F.col(id_col), text_or_empty(text_col))
    named = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), size.alias("_size"), row_key.alias("_key"),
        F.struct(*(F.col(c) for c in keep or [id_col])).alias("_row"),
    )
    small = staged(named.select("_source", "_size", "_key"), "sizes")
    n_docs = small.count()
    shards = max(1, -(-n_docs // shard_docs))
    shard = F.pmod(F.col("_key"), F.lit(shards))
    by_shard = staged(
        small.groupBy(F.col("_source").alias("source"), shard.alias("shard")).agg(F.sum("_size").alias("shard_size")),
        "shards",
    )
    sources = by_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    seats = round(share * (sources.agg(F.sum("source_size")).first()[0] or 0) / block)
    given = apportion(targets.withColumn("seats", F.lit(seats).cast("long")), [], ["source"], "target", "seats")
    # the last block of a source is cut, or one more begun, to meet the target
    partial = F.greatest(F.least(F.round("target").cast("long") - block * F.col("quota"), F.lit(block - 1)), F.lit(1 - block))
    given = given.select("source", "source_size", "target", F.col("quota").alias("source_quota"), partial.alias("partial"))
    on = by_shard["source"].eqNullSafe(given["source"])
    quotas = by_shard.join(given, on).select(by_shard["*"], "source_size", "target", "source_quota", "partial")
    largest = F.max(F.struct("shard_size", (-F.col("shard")).alias("shard"))).over(Window.partitionBy("source"))["shard"]
    quotas = quotas.withColumn("last", F.col("shard") == -largest)
    quotas = apportion(quotas, ["source"], ["shard"], "shard_size", "source_quota")
    in_words = block * F.col("quota") + F.when(F.col("last"), F.col("partial")).otherwise(0)
    quotas = quotas.withColumn("quota", F.greatest(F.lit(0), F.least(in_words, (most * F.col("shard_size")).cast("long"))).cast("long"))
    words_ = F.greatest(F.col("shard_size"), F.lit(1))
    quotas = quotas.withColumn("passes", F.call_function("div", F.col("quota"), words_)).withColumn("rest_words", F.col("quota") % words_)
    # a short block at the end of the shard is chosen only with all the others
    full = F.call_function("div", F.col("shard_size"), F.lit(block).cast("long"))
    quotas = quotas.withColumn("blocks", F.when(F.col("rest_words") > full * block, full + 1).otherwise(F.greatest(full, F.lit(1))))
    quotas = quotas.select(
        F.struct("source", "shard").alias("place"),
        "source_size",
        "target",
        "blocks",
        "passes",
        "rest_words",
        F.call_function("div", F.col("rest_words") + (block - 1), F.lit(block).cast("long")).alias("rest"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "source", "shard"), F.col("blocks")).alias("offset"),
    )
    quotas = staged(quotas, "quotas")
    order = Window.partitionBy("place").orderBy("_order", "_id", "_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = named.withColumn("place", F.struct(F.col("_source").alias("source"), shard.alias("shard")))
    rows = rows.withColumn("_order", F.xxhash64(F.lit(seed + 2), "_key"))
    rows = rows.withColumn("start", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    rows = rows.alias("d").join(quotas.alias("q"), F.col("d.place").eqNullSafe(F.col("q.place")))
    return rows.select(
        F.col("_id").alias(id_col),
        *([F.col("_row").alias("row")] if keep else []),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (_taken_before(F.col("start") + F.col("_size"), block) - _taken_before(F.col("start"), block)).alias("taken"),
        "start", "passes", "rest_words", "rest", "blocks", "offset",
    )


def mix_documents(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars", block: int = BLOCK, **options) -> DataFrame:
    """The mixed corpus with the columns of `docs`: a row per whole pass over a document, and a row of
    the chosen blocks of words, with the white space after them, where the last pass takes only some.
    Of a text without words nothing can be taken.
    """
    planned = plan_mix(docs, text_col=text_col, keep=docs.columns, block=block, **options)
    text = F.col("row")[text_col]
    pieces = F.regexp_extract_all(text, F.lit(f"([^\\x20\\x09-\\x0D]+{SPACE_CLASS}*)"), 1)

    def taken(_: Column, k: Column) -> Column:
        before, here = _chosen_before(F.col("start") + k, block)
        return here & (before < F.col("rest_words"))

    part = F.filter(pieces, taken)
    rest = F.col("taken") - F.col("passes") * F.col("size")
    copies = F.when(F.col("size") > 0, F.col("passes")).otherwise(0)
    texts = F.concat(
        F.array_repeat(text, copies.cast("int")),
        F.when((rest == F.col("size")) & (rest > 0), F.array(text))
        .when(rest > 0, F.array(F.array_join(part, "")))
        .otherwise(F.array().cast("array<string>")),
    )
    rows = planned.select("row", F.explode(texts).alias("mixed"))
    new = {text_col: F.col("mixed"), n_chars_col: F.length("mixed").cast("long")}
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
