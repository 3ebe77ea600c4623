"""Lines that many documents share: explode, hash, count documents, drop, reassemble by position.

Only 16 bytes a line travel for counting. A line that every document has is counted before the shuffle and
joined by broadcast (``common.by_weight``), so no task gathers it. Dropped positions come back to their
document, and the remaining ones pick its lines in order: linear in the number of lines, however long the text.

Defined results: a null or empty text is one empty line. A line that is blank once stripped never goes. Rows that
share an id are one document for the count; a row without an id is a document of its own. What goes is decided alike for all.
Other columns pass through; one of the same name as a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import BLANKS, by_weight, free, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """A line stripped at both ends, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _counted(keyed: DataFrame) -> DataFrame:
    """(key, documents, n): distinct documents and rows that have a key."""
    keys = F.explode(F.array_distinct("keys")).alias("key")
    repeated = stored(keyed.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated-ids")
    once, n = keyed, F.count("*").alias("n")
    if repeated.isEmpty():  # a row is a document
        return once.select(keys).where("key IS NOT NULL").groupBy("key").agg(n).withColumn("documents", F.col("n"))
    # pairs are made distinct for these ids alone; all else is counted before the shuffle
    once = keyed.join(repeated, "id", "left_anti").select(keys).where("key IS NOT NULL").groupBy("key").agg(n)
    pairs = keyed.join(repeated, "id", "left_semi").select("id", keys).where("key IS NOT NULL").groupBy("key", "id").agg(n)
    several = pairs.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("documents"))
    both = once.withColumn("documents", F.col("n")).unionByName(several)
    return both.groupBy("key").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def drop_shared_lines(
    docs: DataFrame, min_documents: int = 10, min_points: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Adds ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    A line goes if its key has at least ``min_points`` code points and occurs in at least ``min_documents``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    id_, tag, lines_, out, place_id, place_tag = free(docs, "id", "tag", "lines", "out", "place_id", "place_tag")
    tagged = docs.withColumns({lines_: F.split(body, "\n", -1), id_: F.col(doc_id), tag: F.xxhash64(body)})
    keyed = tagged.select(
        F.col(id_).alias("id"), F.col(tag).alias("tag"),
        F.transform(
            lines_,
            lambda line: F.when(
                F.length(line_key(line)) >= F.lit(min_points), F.unhex(F.md5(line_key(line)))
            ),
        ).alias("keys"),
    )
    keyed = stored(keyed, "line-keys")
    lines = keyed.select("id", "tag", F.posexplode("keys").alias("pos", "key")).where("key IS NOT NULL")
    shared = stored(
        _counted(keyed).where(F.col("documents") >= min_documents), "line-counts"
    )
    places = (
        by_weight(lines, shared, "key", "n", keyed.count())
        .groupBy("id", "tag").agg(F.collect_set("pos").alias(out))
    )
    places = places.withColumnsRenamed({"id": place_id, "tag": place_tag})
    joined = tagged.join(places, F.col(id_).eqNullSafe(F.col(place_id)) & (F.col(tag) == F.col(place_tag)), "left")
    n_lines = F.size(lines_)
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col(out))
    picked = F.transform(kept, lambda at: F.get(F.col(lines_), at))
    return joined.withColumns({
        "kept_text": F.when(F.col(out).isNull(), body).otherwise(F.array_join(picked, "\n")),
        "n_lines": n_lines.cast("long"),
        "n_dropped": F.when(F.col(out).isNull(), 0).otherwise(F.size(out)).cast("long"),
    }).drop(lines_, id_, tag, place_id, place_tag, out)
