"""Mixing sources to target weights: a low-discrepancy schedule of equal blocks of each source's shuffled words.

The mix is a schedule of slots, each for one block. A source's words, its documents shuffled by a digest of their ids, are
cut into blocks of equal size: ``BLOCK`` words, or a ``FINE``-th of the source's target if that is less, so that a small
source is met as closely as a large one. Slot number i sits at the i-th golden-ratio point, which the numbers of blocks that
the sources are to give divide among them; so every stretch of the schedule has the sources in about their shares. The
slots of a source are ranked, and rank r is joined to block r, over again from the first block after the last; no block is
used more often than ``REPEATS``. What a document gives is what its words lie in; a block may end inside it.

The points are exact in whole numbers. Sources, slots and blocks meet in equi-joins only: the interval of a source is
listed under the cells it touches. Running sums and ranks are taken in parts (``common.sums_before``), as one source may
hold most rows. A block holds words of at most so many documents, so no join key is hot.

Defined results: a null text has size 0 and is never taken. A null source is a source of its own, the last one. Rows
that repeat a document are separate. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import BLANKS, by_weight, free, in_order, same, stored, sums_before, words_in

#: weights in the order of the sources, repeated; words of the mix for each word there is; most uses of a document
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
#: words of a block at most, and blocks that a target has at least (while they hold a word each)
BLOCK, FINE = 1024, 10_000
#: beyond so many slots the blocks of large sources grow, as the points have 31 bits
MOST_SLOTS, BITS = 1 << 28, 31
#: the golden ratio's fractional part in that many bits
GOLDEN = 1_327_217_885
#: cells that slots meet the sources in
CELLS = 4096
#: rows that one task sums over
PART = 20_000


def _shuffled(doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit("mix "), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Adds nth (place among the sources), target and points (whole words of the target) to source, source_size.

    Water-filling: sources in the order of the level at which they are full; all that are full below the level at
    which the whole amount is given out stop at ``repeats`` times their size, the others get their weight's share.
    """
    numbered = in_order(sources, [F.col("source").asc_nulls_last()], nth=F.lit(1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("nth", F.lit(len(weights))) + 1).cast("int"))
    numbered = numbered.withColumns({"weight": weight.cast("long"), "most": F.col("source_size") * repeats})
    by_level = stored(
        in_order(numbered, [F.col("most") / F.col("weight"), F.col("nth")], most_before=F.col("most"), weight_before=F.col("weight")),
        "levels",
    )
    all_sizes, all_weights = by_level.agg(F.sum("source_size"), F.sum("weight")).first()
    amount = share * (all_sizes or 0)
    at_level = F.col("most_before") + F.col("most") / F.col("weight") * (F.lit(all_weights or 0) - F.col("weight_before"))
    full_most, full_weight = by_level.where(at_level <= amount).agg(F.sum("most"), F.sum("weight")).first()
    left = (all_weights or 0) - (full_weight or 0)
    level = (amount - (full_most or 0)) / left if left else 0.0
    target = F.when(at_level <= amount, F.col("most").cast("double")).otherwise(F.lit(float(level)) * F.col("weight"))
    found = by_level.withColumns({"target": target, "points": F.floor(target)})
    return found.drop("most_before", "weight_before")


def schedule(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(nth, block, use, slot): the schedule, each slot with the block it gets and how often that was used before.

    ``sources`` has nth, source_size, target and words (of a block).
    """
    spark = sources.sparkSession
    planned = sources.where("target > 0 AND source_size > 0").select(
        "nth", F.ceil(F.col("target") / F.col("words")).alias("points"), F.ceil(F.col("source_size") / F.col("words")).alias("blocks")
    )
    spans = stored(in_order(planned, [F.col("nth")], low=F.col("points")), "spans")
    n = spans.agg(F.sum("points")).first()[0] or 0
    cell = lambda at: F.expr(f"{at} * {CELLS} div {max(n, 1)}")
    listed = spans.select(
        "nth", "blocks", "low", (F.col("low") + F.col("points")).alias("high"),
        F.explode(F.sequence(cell("low"), cell("(low + points - 1)"))).alias("cell"),
    )
    place = F.expr(f"id % {1 << BITS} * {GOLDEN} % {1 << BITS} * {n} div {1 << BITS}")
    slots = spark.range(n).select(F.col("id").alias("slot"), place.alias("place")).withColumn("cell", cell("place"))
    placed = slots.join(listed, "cell").where("place >= low AND place < high").select("nth", "slot", "blocks")
    ranked = sums_before(placed, ["nth"], F.expr(f"slot div {PART}"), ["slot"], rank=F.lit(1))
    return ranked.select(
        "nth", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("use"), "slot"
    ).where(F.col("use") < repeats)


def _used(docs: DataFrame, weights, share: float, repeats: int) -> tuple[DataFrame, DataFrame]:
    """The sized rows with their source's target, and (_row, use, position, words): what each use of a row gives.

    The position is the slot that the use begins in; its words are the row's first ones.
    """
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source")))
    sized = stored(
        docs.select("doc_id", "source", "text").withColumns({
            "size": words_in(F.col("text")), "_key": key,
            "_order": _shuffled(F.col("doc_id")), "_row": F.monotonically_increasing_id(), "tag": F.xxhash64("text"),
        }).drop("text"),
        "mix-sizes",
    )
    sources = sized.groupBy("_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    planned = stored(targets(sources, weights, share, repeats), "mix-targets")
    rows, all_words = sized.count(), planned.agg(F.sum("source_size")).first()[0] or 0
    most = max(BLOCK, -(-int(share * all_words) // MOST_SLOTS))
    words = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("target") / FINE))).cast("long")
    known = stored(planned.select("_key", "nth", "source_size", "target", "rows", words.alias("words")), "mix-sources")
    placed = by_weight(sized, known, "_key", "rows", rows)
    # parts follow the leading digits of the digest, and so its order
    parts = max(1, -(-rows // PART))
    part = F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / float(1 << 32) * parts)
    placed = stored(sums_before(placed, ["nth"], part, ["_order", "_row"], before=F.col("size")), "mix-placed")
    first, last = F.expr("before div words"), F.expr("(before + size - 1) div words")
    pieces = placed.where("size > 0").select("_row", "nth", "before", "size", "words", F.explode(F.sequence(first, last)).alias("block"))
    held = F.least(F.expr("before + size"), F.expr("(block + 1) * words")) - F.greatest(F.col("before"), F.expr("block * words"))
    pieces = pieces.select("_row", "nth", "block", held.alias("held"))
    uses = pieces.join(schedule(known, repeats), ["nth", "block"])
    uses = uses.groupBy("_row", "use").agg(F.min("slot").alias("position"), F.sum("held").alias("words"))
    return placed.select("_row", "doc_id", "source", "tag", "size", "source_size", "target"), stored(uses, "mix-uses")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """doc_id, source, tag (a hash of the text), size, source_size, target and taken: words that the mix takes of it."""
    placed, uses = _used(docs, weights, share, repeats)
    taken = uses.groupBy("_row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0))).drop("_row")


def _first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word, as it is."""
    body = F.ltrim(text, F.lit(BLANKS))
    rest = F.get(F.split(body, r"[\x20\x09-\x0D]+", n + 1), n)
    return F.rtrim(F.left(body, F.length(body) - F.length(rest)), F.lit(BLANKS))


def uses(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The schedule by document: doc_id, source, tag, size, use, position (of its first slot) and words (its first ones)."""
    placed, used = _used(docs, weights, share, repeats)
    return placed.select("_row", "doc_id", "source", "tag", "size").join(used, "_row").drop("_row")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a row for each time a document is used; of one used in part its first words. ``uses`` has their positions."""
    tag, size, words = free(docs, "tag", "size", "words")
    found = uses(docs).select("doc_id", F.col("tag").alias(tag), F.col("size").alias(size), F.col("words").cast("int").alias(words))
    single = docs.withColumn(tag, F.xxhash64("text")).dropDuplicates(["doc_id", tag])  # rows that repeat a document: all their uses
    used = single.join(found, same(single, found, ["doc_id", tag])).select(*(single[c] for c in docs.columns), size, words)
    text = F.when(F.col(words) >= F.col(size), F.col("text")).otherwise(_first_words(F.col("text"), F.col(words)))
    changed = used.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)
