"""Near-duplicates by MinHash: an inverted join over signature coordinates, confirmed on full shingle sets.

1. Each text becomes its set of five-word shingles and a signature of ``COORDINATES`` minima. Texts with equal sets
   are one node from here on, however many there are.
2. Every node is posted under each (coordinate, value) pair, and the lengths of these lists are counted. Two texts
   over the similarity share at least ``matches`` coordinates (missed with a probability below one in a million at
   the very threshold). So a node with too few shared coordinates has no partner, and the others need only their
   rarest ones: two nodes with enough matches meet in their prefixes. The long lists, which common passages make,
   are skipped wherever a node has enough rarer ones.
3. A list's centre is the node whose coordinates are shared most, and each node is compared with the most shared centres
   of its lists: first the signatures, then the full sets of those that are left. Confirmed links give components. A list
   of one component is done: no pair inside it can change a result.
4. The other lists get a new centre, drawn by hash, and each node is compared with the centre of one of its lists, if that
   is of another component; this is repeated up to ``ROUNDS`` times, while it links many. A link between two components makes
   all their other pairs needless.
5. In lists that still hold several components, the pairs across them remain. A node's shingles that no other of these nodes
   has count against every partner, which rules out nearly all of them; the rest are compared as well. So a family of
   texts that are all alike, but none enough, does cost its pairs: nothing less tells that no two of them are linked.

Rows that share a list, a centre or a text are split by salt or broadcast of one row (``common.by_weight``). Defined results:
a null or empty text, or one without words, has an empty set and is linked with nothing. A null id is linked with nothing and
stays. Rows that repeat an id and a text have the same result. Different texts under one id are one document: whatever
one of them is linked with, the other is too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import by_weight, small_batches, stored
from tallywright.llm.components import components

WORDS, PERCENT = 5, 85
COORDINATES, MISSED = 64, 5e-7
#: pairs of one centre, and nodes of one list, that a task compares
TOGETHER = 500
#: centres that a node meets to begin with: those of all its lists
CENTRES = COORDINATES
#: times that lists of several components get a new centre, and share of the compared pairs that must link to go on
ROUNDS, WORTHWHILE = 4, 0.1
#: word hashes that a task keeps, and shingles it hashes at once
KEPT_WORDS, CHUNK = 50_000, 4096

_random = np.random.default_rng(20_240_501)
_SEEDS = _random.integers(0, 2**64, COORDINATES, np.uint64)
_FACTORS = _random.integers(0, 2**64, COORDINATES, np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def matches(percent: int) -> int:
    """Equal coordinates asked of a pair: one at the very threshold has fewer with a probability below ``MISSED``."""
    p, missed = percent / 100, 0.0
    for n in range(COORDINATES):
        missed += math.comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if missed >= MISSED:
            return max(n, 1)
    return COORDINATES


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: str | None, hashes: dict[bytes, int], words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; A-Z count as lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    span = min(words, len(each))
    mixed = np.full(len(each) - span + 1, span, np.uint64)
    for i in range(span):
        mixed = mixed * _STEP + each[i : len(each) - span + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """The smallest hash of a set in each coordinate."""
    least = np.full(COORDINATES, 2**32 - 1, np.uint64)
    for at in range(0, len(found), CHUNK):
        mixed = ((found[at : at + CHUNK, None] ^ _SEEDS) * _FACTORS) >> np.uint64(32)
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHashes()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            found = shingles(text, hashes)
            key = xxhash.xxh3_128_digest(found.tobytes())
            rows.append((doc_id, len(found), key, signature(found).astype(np.int64) if len(found) else None))
        yield pd.DataFrame(rows, columns=["doc_id", "n", "set_key", "coordinates"])


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = _WordHashes()
    for batch in batches:
        rows = []
        for node, text, key in zip(batch["node"], batch["text"], batch["set_key"]):
            found = shingles(text, hashes)
            if xxhash.xxh3_128_digest(found.tobytes()) == bytes(key):
                rows.append((node, len(found), found.view(np.int64), signature(found).astype(np.int64)))
        yield pd.DataFrame(rows, columns=["node", "n", "shingles", "coordinates"])


def _alike(inter, one, other, percent):
    """Whether an intersection of this size links sets of these sizes."""
    return inter * 100 >= (one + other - inter) * percent


def _prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, shared): the rarest coordinates of each node that can have a partner."""
    rows = nodes.select("node", "n", F.posexplode("coordinates").alias("at", "value"))
    rows = stored(rows.select("node", "n", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value")).alias("key")), "postings")
    lists = stored(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "lists")
    total = nodes.count()  # of the rows of any one coordinate
    met = by_weight(rows, lists, "key", "size", total)
    by_node = met.groupBy("node").agg(
        F.first("n").alias("n"), F.sum("size").alias("shared"), F.sort_array(F.collect_list(F.struct("size", "key"))).alias("keys")
    )  # at most COORDINATES of a node
    by_node = by_node.where(F.size("keys") >= matches(percent))
    rarest = F.slice("keys", 1, F.size("keys") - F.lit(matches(percent) - 1))
    return by_node.select("node", "n", "shared", F.explode(rarest.getField("key")).alias("key"))


def _paired(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """(a, b, salt) with the columns of both nodes, as x_a and x_b. A ``b`` has at most about ``TOGETHER`` pairs of one salt."""
    mine, theirs = (described.select(*(F.col(c).alias(side if c == "node" else f"{c}_{side}") for c in described.columns)) for side in "ab")
    needed = pairs.select("b", "salt").distinct().join(theirs, "b")
    return pairs.join(mine, "a").join(needed, ["b", "salt"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, by_signature: bool = True) -> DataFrame:
    """(a, b) of the pairs that are linked, by their full sets, which only pairs with enough equal coordinates meet.

    Pairs that were chosen by their shingles already go to the sets at once (``by_signature`` false). ``b`` may be shared by most pairs, which are split by salt.
    """
    pairs = stored(pairs, "pairs")
    counts = stored(pairs.groupBy("b").agg(F.count("*").alias("pairs")), "pair-counts")
    salt = F.pmod(F.xxhash64("a"), F.ceil(F.col("pairs") / TOGETHER)).alias("salt")
    salted = stored(by_weight(pairs, counts, "b", "pairs", pairs.count()).select("a", "b", salt), "salted-pairs")
    near = _signed(salted, sets, percent) if by_signature else salted
    met = _paired(near, sets.select("node", "n", "shingles"))
    return met.where(_alike(F.size(F.array_intersect("shingles_a", "shingles_b")), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _signed(salted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with enough equal coordinates, and sizes that allow a link."""
    signed = _paired(salted, sets.select("node", "n", "coordinates"))
    collisions = F.size(F.filter(F.zip_with("coordinates_a", "coordinates_b", lambda x, y: x == y), lambda same: same))
    sizes = _alike(F.least("n_a", "n_b"), F.least("n_a", "n_b"), F.greatest("n_a", "n_b"), percent)
    return stored(signed.where(sizes & (collisions >= matches(percent))).select("a", "b", "salt"), "near-pairs")


def _starred(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of nodes with the centres of their lists, the ``CENTRES`` whose coordinates are shared most."""
    centres = stored(
        prefixes.groupBy("key").agg(F.count("*").alias("size"), F.max(F.struct("shared", "node")).alias("centre"))
        .where("size > 1"),
        "centres",
    )
    met = by_weight(prefixes.select("key", "node"), centres, "key", "size", prefixes.count())
    # at most a node's prefix of them
    most = F.slice(F.sort_array(F.collect_set("centre"), asc=False), 1, CENTRES)
    pairs = met.groupBy(F.col("node").alias("a")).agg(most.alias("centres"))
    pairs = pairs.select("a", F.explode("centres.node").alias("b")).where("a <> b")
    return _confirmed(pairs, sets, percent)


def _labelled(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with the components of their nodes."""
    return stored(prefixes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")


def _merging(prefixes: DataFrame, labels: DataFrame, nth: int) -> DataFrame:
    """(a, b): each node of a list with several components, and another centre of one of its lists, of another component."""
    placed = _labelled(prefixes, labels)
    drawn = F.max(F.struct(F.xxhash64("node", F.lit(nth)).alias("drawn"), "node", "component"))
    mixed = stored(
        placed.groupBy("key").agg(
            F.count("*").alias("size"), F.min("component").alias("one"), F.max("component").alias("other"), drawn.alias("centre"),
        ).where("one <> other").select("key", "size", F.col("centre.node").alias("b"), F.col("centre.component").alias("of")),
        "mixed-centres",
    )
    pairs = by_weight(placed, mixed, "key", "size", placed.count()).where("component <> of")
    one = F.min(F.struct(F.xxhash64("key", F.lit(nth)).alias("drawn"), "b")).alias("one")
    return pairs.groupBy(F.col("node").alias("a")).agg(one).select("a", F.col("one.b").alias("b"))


def _remaining(prefixes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links across components, among lists that hold several of them."""
    placed = _labelled(prefixes, labels)
    mixed = stored(
        placed.groupBy("key").agg(
            F.count("*").alias("size"), F.min("component").alias("one"), F.max("component").alias("other"),
            F.max(F.struct("shared", "node", "component")).alias("centre"),
        ).where("one <> other").select("key", "size", F.col("centre.component").alias("centre_component")),
        "mixed-lists",
    )
    open_ = stored(by_weight(placed, mixed, "key", "size", placed.count()).drop("size"), "open")
    for _ in range(2):  # shingles shared only with nodes that are ruled out count as a node's own the second time
        nodes = open_.select("node").distinct()
        each = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
        own = (
            each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
            .groupBy("node").agg(F.count("*").alias("own"))
        )
        known = open_.drop("own").join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
        known = stored(known, "open")
        least = stored(known.groupBy("key").agg(F.count("*").alias("size"), F.min("n").alias("least_n")), "least")
        known = by_weight(known, least, "key", "size", known.count())
        # the smallest partner there can be: no smaller than what is shared, nor than the smallest of the list
        common = F.col("n") - F.col("own")
        viable = _alike(common, F.col("n"), F.greatest(common, F.col("least_n")), percent)
        open_ = stored(known.where(viable).drop("size", "least_n"), "open")
    sizes = stored(open_.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "open-lists")
    salts = F.ceil(F.col("size") / TOGETHER)
    sized = stored(by_weight(open_, sizes, "key", "size", open_.count()), "open-sized")
    lists = sized.groupBy("node").agg(F.collect_list("key").alias("lists"))  # at most a node's prefix
    sized = stored(sized.join(lists, "node"), "open-listed")
    strays = F.col("component") != F.col("centre_component")
    stray = sized.where(strays).select(
        "key", F.col("node").alias("b"), F.col("lists").alias("lists_b"), F.col("component").alias("component_b"),
        F.col("n").alias("n_b"), (F.col("n") - F.col("own")).alias("common_b"),
        F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"),
    )
    every = sized.select(
        "key", F.col("node").alias("a"), F.col("lists").alias("lists_a"), strays.alias("stray_a"),
        F.col("component").alias("component_a"), F.col("n").alias("n_a"), (F.col("n") - F.col("own")).alias("common_a"),
        F.pmod(F.xxhash64("node"), salts).alias("salt"),
    )
    # a pair is taken up once, in the first list that both are in
    first = F.col("x.key") == F.array_min(F.array_intersect("lists_a", "lists_b"))
    once = first & (~F.col("stray_a") | (F.col("a") < F.col("b")))
    pairs = every.alias("x").join(
        stray.alias("y"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("component_a") != F.col("component_b"))
        & _alike(F.least("common_a", "common_b"), F.col("n_a"), F.col("n_b"), percent) & once,
    )
    return _confirmed(pairs.select("a", "b"), sets, percent, by_signature=False)


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of nodes that are linked, given earlier components: one link to its component stands for a node."""
    return stored(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)), "components")


def _same_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the nodes of different texts that have the same id."""
    none = classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("one"), F.max("set_key").alias("other"))
    several = stored(several.where("one <> other").select("doc_id"), "repeated-ids")
    if several.isEmpty():
        return none
    texts = stored(rows.join(several, "doc_id").select("doc_id", "set_key").distinct(), "repeated-id-texts")
    nodes = stored(texts.join(classes.select("set_key", "node"), "set_key").select("doc_id", "node"), "repeated-id-nodes")
    firsts = stored(nodes.groupBy("doc_id").agg(F.min("node").alias("b"), F.count("*").alias("n")), "repeated-id-firsts")
    return by_weight(nodes, firsts, "doc_id", "n", nodes.count()).select(F.col("node").alias("a"), "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row; pairs with a Jaccard similarity of ``percent`` are linked."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # ids pass as text: pandas has no integer column with nulls
    described = plain.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _described, "doc_id string, n long, set_key binary, coordinates array<long>"
    )
    rows = described.withColumns({"doc_id": F.col("doc_id").cast("long"), "row": F.monotonically_increasing_id()})
    rows = stored(rows, "shingled")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    # a node is a set; its number is that of one of its rows
    classes = stored(
        rows.where(linked).groupBy("set_key").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("first_id"), F.count("*").alias("rows"),
            F.first("n").alias("n"), F.first("coordinates").alias("coordinates"),
        ),
        "classes",
    )
    prefixes = stored(_prefixes(classes, percent), "prefixes")
    sets = classes.select("node", "first_id", "set_key").join(prefixes.select("node").distinct(), "node", "left_semi")
    sets = plain.join(sets, plain["doc_id"] == sets["first_id"]).select("node", "text", "set_key")
    sets = stored(sets.mapInPandas(_sets, "node long, n long, shingles array<long>, coordinates array<long>").dropDuplicates(["node"]), "sets")
    links = stored(_starred(prefixes, sets, percent), "star-links").unionByName(_same_ids(rows.where(linked), classes))
    labels = stored(components(links), "star-components")
    late = links.limit(0)
    for nth in range(ROUNDS):
        pairs = stored(_merging(prefixes, labels, nth), "merging-pairs")
        late = stored(_confirmed(pairs, sets, percent), "merging-links")
        if late.count() < WORTHWHILE * pairs.count() or late.isEmpty():
            break
        labels, late = _with_links(labels, late), late.limit(0)
    more = stored(_remaining(prefixes, sets, labels, percent).unionByName(late), "other-links")
    if not more.isEmpty():
        labels = _with_links(labels, more)
    found = classes.join(labels, "node", "left").select("set_key", "rows", "first_id", F.coalesce("component", "node").alias("component"))
    found = stored(found, "found")
    named = found.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    found = by_weight(found, stored(named, "component-ids"), "component", "n", found.count()).select("set_key", "rows", "component_id")
    parts = rows.select("doc_id", "n", "set_key")
    alone = parts.where(~linked).withColumn("component_id", F.col("doc_id"))
    joined = by_weight(stored(parts.where(linked), "linked"), stored(found, "found-ids"), "set_key", "rows", rows.count())
    whole = joined.select(alone.columns).unionByName(alone)
    return whole.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, with all their columns: one of each component, and all without words."""
    gone = near_duplicates(docs, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
