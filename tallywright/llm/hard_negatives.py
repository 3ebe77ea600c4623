"""Hard negatives from blocks of vectors in Hilbert-curve order, chosen by zone maps and interval arithmetic.

The vectors are sorted by label, then along a Hilbert curve through their ``AXES`` most varying dimensions, and written
to Parquet as blocks of ``BLOCK`` vectors: one row a block, with the packed vectors beside the least and greatest value of
each dimension (the zone map) and the range of labels. A query reads zone maps first and, of the blocks, only those
that can matter: with a+ and a- the positive and negative parts of an anchor, every product with a vector of a block lies
between a+ . least + a- . greatest and a+ . greatest + a- . least.

An anchor asks for windows of scores. One window over its own label, without limits, gives the positives; each positive
opens a window over the other labels. For both, the most promising block of an anchor is read first, and its k-th score
in a window is a floor. Then every block is read whose interval meets a window above its floor. Products are exact
integers; the k best of each block meet once more by anchor and window.

Zone maps meet anchors, and blocks meet their anchors, in pieces of bounded size: at most ``ZONES`` maps, ``CHUNK`` anchors and
one block at a time. Work is split by blocks only, so that one label or vector may fill most rows.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part. A shorter
vector counts as padded with zeros. Rows that repeat an id are candidates, and anchors, each; the own row alone is left out.
Ids order ties, null last. A positive below zero has an empty window. Scores beyond 64 bits are cut to the limit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import stored
from tallywright.operators.ranking import with_position

BLOCK, ZONES, CHUNK = 1024, 256, 512
#: dimensions and bits of the Hilbert curve; their product must stay below 63
AXES, BITS = 8, 6
SCALE = 256  # components are floored after scaling
_SLACK = 1e-9  # relative, of bounds in floating point

_FOUND = "row long, at long, cand long, vec_id long, no_id boolean, score long"
_LEAST, _MOST = -(2**63), 2**63 - 1


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer cells in 0 .. 2^bits - 1.

    By Gray code: from the highest bit down, each axis' bit either flips the lower bits of the first axis or
    exchanges them with its own; the bits of all axes, interleaved, then count along the curve.
    """
    x = cells.astype(np.int64).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            on = (x[i] & bit) > 0
            swapped = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swapped)
            x[i] = x[i] if i == 0 else x[i] ^ swapped
        bit >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flips = np.where((x[-1] & bit) > 0, flips ^ (bit - 1), flips)
        bit >>= 1
    x ^= flips
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << 1) | ((axis >> b) & 1)
    return place


def _placer(axes: list[int], low: list[float], high: list[float]):
    def place(ints: pd.Series) -> pd.Series:
        values = np.array([[v[a] if a < len(v) else 0 for a in axes] for v in ints], float).reshape(len(ints), len(axes))
        span = np.maximum(np.array(high) - np.array(low), 1e-300)
        cells = np.clip((values - np.array(low)) / span * (1 << BITS), 0, (1 << BITS) - 1)
        return pd.Series(hilbert_place(cells.astype(np.int64), BITS))

    return F.pandas_udf(place, "long")


def _axes(vectors: DataFrame) -> tuple[list[int], list[float], list[float]]:
    """The dimensions that vary most with their ranges; one row a dimension goes through the driver."""
    value = F.col("value").cast("double")
    spread = vectors.select(F.posexplode("ints").alias("axis", "value")).groupBy("axis").agg(
        F.var_pop(value).alias("spread"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    rows = spread.orderBy(F.desc("spread"), "axis").limit(AXES).collect()
    return [r.axis for r in rows], [r.low for r in rows], [r.high for r in rows]


def _matrix(rows, width: int) -> np.ndarray:
    made = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        made[i, : len(row)] = row
    return made


def _pack(vectors: pd.DataFrame) -> pd.DataFrame:
    vectors = vectors.sort_values("position")
    ints = _matrix(vectors["ints"], max(1, max(map(len, vectors["ints"]))))
    return pd.DataFrame({
        "block": [int(vectors["block"].iat[0])], "least": [ints.min(axis=0)], "greatest": [ints.max(axis=0)],
        "first_label": [vectors["label"].min()], "last_label": [vectors["label"].max()],
        "rows": [vectors["row"].to_numpy()], "labels": [vectors["label"].to_numpy()],
        "ids": [vectors["vec_id"].to_numpy()], "no_ids": [vectors["no_id"].to_numpy()], "width": [ints.shape[1]],
        "packed": [ints.astype("<i8").tobytes()],
    })


def write_blocks(vectors: DataFrame) -> DataFrame:
    """The blocks, stored; ``vectors`` has row, vec_id (0 where ``no_id`` holds), label and ints."""
    axes, low, high = _axes(vectors)
    place = _placer(axes, low, high)(F.col("ints")) if axes else F.lit(0).cast("long")
    ordered = with_position(vectors.withColumn("place", place), [F.col("label"), F.col("place"), F.col("row")], "position")
    blocks = ordered.select("row", "vec_id", "no_id", "label", "ints", "position", F.expr(f"(position - 1) div {BLOCK}").alias("block"))
    return stored(
        blocks.groupBy("block").applyInPandas(
            _pack,
            "block long, least array<long>, greatest array<long>, first_label long, last_label long, "
            "rows array<long>, labels array<long>, ids array<long>, no_ids array<boolean>, width int, packed binary",
        ),
        "vector-blocks",
    )


def _parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(values, 0), np.minimum(values, 0)


def bounds(anchors: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and block, an interval that holds all their products."""
    plus, minus = _parts(anchors.astype(float))
    least, greatest = least.astype(float), greatest.astype(float)
    low = plus @ least.T + minus @ greatest.T
    high = plus @ greatest.T + minus @ least.T
    slack = _SLACK * (np.abs(anchors).astype(float) @ np.maximum(np.abs(least), np.abs(greatest)).T)
    return low - slack, high + slack


def _meets_label(asked: pd.DataFrame, zones: pd.DataFrame, same: bool) -> np.ndarray:
    label = asked["label"].to_numpy()[:, None]
    first, last = zones["first_label"].to_numpy(), zones["last_label"].to_numpy()
    return (first <= label) & (label <= last) if same else (first != label) | (last != label)


def _intervals(asked: pd.DataFrame, zones: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    width = max(max(map(len, asked["ints"])), max(map(len, zones["least"])))
    return bounds(_matrix(asked["ints"], width), _matrix(zones["least"], width), _matrix(zones["greatest"], width))


def _begin(same: bool):
    """The block with the greatest upper bound that may hold a wanted label, for each anchor."""

    def choose(asked: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(zones):
            return pd.DataFrame({"row": [], "block": [], "bound": []}).astype({"row": "int64", "block": "int64", "bound": "float64"})
        high = np.where(_meets_label(asked, zones, same), _intervals(asked, zones)[1], -np.inf)
        best = high.argmax(axis=1)
        found = pd.DataFrame({
            "row": asked["row"].to_numpy(), "block": zones["block"].to_numpy()[best], "bound": high[np.arange(len(best)), best],
        })
        return found[found["bound"] > -np.inf]

    return choose


def _choose(same: bool):
    """All blocks whose interval meets one of an anchor's windows, from the window's floor up."""

    def choose(asked: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(zones):
            return pd.DataFrame({"row": [], "block": []}).astype("int64")
        low, high = _intervals(asked, zones)
        wanted = np.zeros(low.shape, bool)
        for i, (tops, floors) in enumerate(zip(asked["tops"], asked["floors"])):
            for top, floor in zip(tops, floors):
                wanted[i] |= (low[i] <= float(top)) & (high[i] >= float(floor))
        row, block = np.nonzero(wanted & _meets_label(asked, zones, same))
        return pd.DataFrame({"row": asked["row"].to_numpy()[row], "block": zones["block"].to_numpy()[block]})

    return choose


def _products(asked: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point is used only while it is exact."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (asked, vectors)]
    if most[0] * most[1] * max(1, asked.shape[1]) < 2**53:
        return (asked.astype(float) @ vectors.T.astype(float)).astype(np.int64)
    return np.clip(asked.astype(object) @ vectors.T.astype(object), -(2**63), 2**63 - 1).astype(np.int64)


def _reader(same: bool, k: int):
    """The k best rows of a block in each window of each anchor."""

    def read(asked: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {c: [np.array([], kind)] for c, kind in zip(("row", "at", "cand", "vec_id", "no_id", "score"), "qqqq?q")}
        if len(asked) and len(blocks):
            block = blocks.iloc[0]
            width = max(int(block["width"]), max(map(len, asked["ints"])))
            ints = np.zeros((len(block["rows"]), width), np.int64)
            ints[:, : block["width"]] = np.frombuffer(block["packed"], "<i8").reshape(-1, block["width"])
            rows, labels, ids, no_ids = (np.asarray(block[c]) for c in ("rows", "labels", "ids", "no_ids"))
            scores = _products(_matrix(asked["ints"], width), ints)
            for i, (row, label, tops, floors) in enumerate(zip(asked["row"], asked["label"], asked["tops"], asked["floors"])):
                wanted = (rows != row) & ((labels == label) == same)
                for at, (top, floor) in enumerate(zip(tops, floors)):
                    places = np.flatnonzero(wanted & (scores[i] <= top) & (scores[i] >= floor))
                    if len(places) > k:  # the k-th score and its ties
                        own = scores[i][places]
                        places = places[own >= np.partition(own, len(own) - k)[len(own) - k]]
                    order = np.lexsort((rows[places], ids[places], no_ids[places], ~scores[i][places]))
                    places = places[order[:k]]
                    n = len(places)
                    made = np.full(n, row), np.full(n, at), rows[places], ids[places], no_ids[places], scores[i][places]
                    for column, values in zip(found.values(), made):
                        column.append(values)
        return pd.DataFrame({c: np.concatenate(values) for c, values in found.items()})

    return read


class ZoneSearch:
    """Exact best rows within windows of scores, for anchors against stored blocks."""

    def __init__(self, blocks: DataFrame, anchors: DataFrame):
        """``anchors`` has row, label and ints, and is stored."""
        self.blocks, self.anchors = blocks, anchors
        n_blocks, n_anchors = blocks.count(), anchors.count()
        self.parts, self.chunks = max(1, -(-n_blocks // ZONES)), max(1, -(-n_anchors // CHUNK))
        zones = blocks.select("block", "least", "greatest", "first_label", "last_label")
        self.zones = zones.select(
            F.expr(f"block div {ZONES}").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(self.chunks - 1))).alias("chunk"), "*"
        )

    def _chunk(self) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(self.chunks)).cast("int").alias("chunk")

    def _with_zones(self, asked: DataFrame, function, schema: str) -> DataFrame:
        keys = ["part", "chunk"]
        asked = asked.select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.parts - 1).cast("long"))).alias("part"), self._chunk(), "*"
        )
        return asked.groupBy(*keys).cogroup(self.zones.groupBy(*keys)).applyInPandas(function, schema)

    def _read(self, asked: DataFrame, pairs: DataFrame, same: bool, k: int) -> DataFrame:
        """Reads the chosen blocks, and no others, for the anchors that chose them."""
        sent = asked.join(pairs, "row").withColumn("chunk", self._chunk())
        # new names for the same columns, as both sides of the cogroup come from the pairs
        needed = pairs.select(F.col("block").alias("wanted"), self._chunk()).distinct().toDF("wanted", "part")
        needed = needed.join(self.blocks, F.col("wanted") == F.col("block"))
        return sent.groupBy("block", "chunk").cogroup(needed.groupBy("wanted", "part")).applyInPandas(_reader(same, k), _FOUND)

    def best(self, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """row, at (number of the window), cand, vec_id, no_id, score, rank: the k best of each window.

        ``windows`` has row, label, ints and the arrays tops and floors, a pair for each window. ``same`` asks for rows of
        the anchor's label, otherwise for those of other labels.
        """
        first = self._with_zones(windows, _begin(same), "row long, block long, bound double")
        first = stored(first.groupBy("row").agg(F.max_by("block", F.struct("bound", F.negate("block"))).alias("block")), "begin-blocks")
        begun = self._read(windows, first, same, k)
        kth = begun.groupBy("row", "at").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        kths = kth.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("at", "kth"))).alias("kths"))
        raised = stored(
            windows.join(kths, "row", "left").withColumn(
                "floors",
                F.transform("floors", lambda floor, at: F.greatest(floor, F.try_element_at("kths", at.cast("long")))),
            ).drop("kths"),
            "windows",
        )
        pairs = stored(self._with_zones(raised, _choose(same), "row long, block long"), "chosen-blocks")
        found = self._read(raised, pairs, same, k)
        order = Window.partitionBy("row", "at").orderBy(F.desc("score"), "no_id", "vec_id", "cand")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))


def hard_negatives(
    vectors: DataFrame,
    asks: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row for which ``asks`` holds: its best ``positives`` rows of the same label, and for each of these the best
    ``negatives`` rows of other labels that score between the given percents of the positive.
    """
    vector = F.col("embedding")
    rows = stored(
        vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), asks.alias("asks"), vector.alias("vector"))
        .where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", _is_finite))
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("id", F.lit(0).cast("long")).alias("vec_id"), F.col("id").isNull().alias("no_id"), "label", "asks",
            F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE)).alias("ints"),
        ),
        "vectors",
    )
    anchors = rows.where("asks").drop("asks")
    search = ZoneSearch(write_blocks(rows.drop("asks")), anchors)
    whole = anchors.withColumns({"tops": F.array(F.lit(_MOST)), "floors": F.array(F.lit(_LEAST))})
    liked = stored(search.best(whole, True, positives).select("row", "rank", "vec_id", "no_id", "score"), "positives")

    score = F.col("score").cast("decimal(38,0)")
    lowest, highest = F.ceil(score * least_percent / 100), F.floor(score * most_percent / 100)
    windows = liked.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("rank", highest.cast("long").alias("top"), lowest.cast("long").alias("floor")))).alias("w")
    )
    windows = stored(
        anchors.join(windows, "row").withColumns({"tops": F.col("w.top"), "floors": F.col("w.floor")}).drop("w"), "negative-windows"
    )
    disliked = search.best(windows, False, negatives)
    named = anchors.select("row", F.col("vec_id").alias("anchor_id")).join(liked, "row").select(
        "row", (F.col("rank") - 1).cast("long").alias("at"), "anchor_id",
        F.when(~F.col("no_id"), F.col("vec_id")).alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return disliked.join(named, ["row", "at"]).select(
        "anchor_id", "positive_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
