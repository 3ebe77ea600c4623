"""Merkle manifest of a dataset: a hash tree for each source, one over the sources, proofs and folded roots by row.

A parent is the SHA-256 of its children's hex digests, up to ``RUN`` of them. While it is hashed, the state of the
hash is copied before each child's slot and kept. To fold a changed child upwards, the state before its slot is
resumed and only the replacement and the siblings to its right are hashed; nothing to its left is read again.

Leaves are numbered by one distributed sort, and ``SPAN`` consecutive ones (``LEVELS`` levels) make a subtree that one
task holds. Subtrees' tops are grouped the same way, round by round, until a source has one node; the sources' nodes
form a last sequence. On the way down each subtree gets one row with its path to the root (siblings left and right of
it at each level), so that every leaf is folded where its subtree is. States cannot leave their process: those of the
levels above a subtree are made once for it from the left siblings, and resumed for each of its leaves.

Defined results: a null field is written ``-``. A null source is a source of its own, before all others; sources
order by their UTF-8 bytes. Null ids come first, rows that repeat an id follow by their leaf. An empty table has no
root and gives no rows. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import by_weight, stored
from tallywright.operators.ranking import with_position

RUN, LEVELS = 16, 3
SPAN = RUN**LEVELS

#: what a leaf covers, in order
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "seq long, pos long, n long, digest string"
_PATH = "seq long, pos long, finished int, subroot string, root string, lefts array<string>, rights array<string>"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
_SOURCES = -1  # the sequence of the sources' nodes


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field with its length in bytes before it, so that no two rows read alike."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(written, fields.values())), 256)


class Subtree:
    """Up to ``SPAN`` consecutive nodes of a sequence of ``n`` nodes, and the levels above them in one task."""

    def __init__(self, digests: list[bytes], n: int):
        self.levels: list[tuple[list[bytes], list]] = []
        nodes = digests
        while n > 1 and len(self.levels) < LEVELS:
            parents, states = [], []
            for at in range(0, len(nodes), RUN):
                state = hashlib.sha256()
                for child in nodes[at : at + RUN]:
                    states.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.levels.append((nodes, states))
            nodes, n = parents, -(-n // RUN)
        self.top, self.n = nodes[0], n

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """The siblings left and right of a node, then of its parent, up to the top."""
        found = []
        for nodes, _ in self.levels:
            start = at // RUN * RUN
            found.append((b"".join(nodes[start:at]), b"".join(nodes[at + 1 : start + RUN])))
            at //= RUN
        return found

    def fold(self, at: int, digest: bytes, siblings: list[tuple[bytes, bytes]]) -> bytes:
        """The top with another digest in one place: resumes the states before its slots."""
        for (_, states), (_, right) in zip(self.levels, siblings):
            digest = resume(states[at], digest, right)
            at //= RUN
        return digest


def resume(before, digest: bytes, right: bytes) -> bytes:
    state = before.copy()
    state.update(digest)
    state.update(right)
    return state.hexdigest().encode()


def _subtree(children: pd.DataFrame) -> tuple[pd.DataFrame, Subtree]:
    children = children.sort_values("pos")
    return children, Subtree([d.encode() for d in children["digest"]], int(children["n"].iat[0]))


def _top(children: pd.DataFrame) -> pd.DataFrame:
    children, tree = _subtree(children)
    first = children.iloc[0]
    return pd.DataFrame({"seq": [first["seq"]], "pos": [first["pos"] // SPAN], "n": [tree.n], "digest": [tree.top.decode()]})


def _paths(children: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """The path of each child: its own levels in the subtree, then those of the subtree."""
    children, tree = _subtree(children)
    path, rows = above.iloc[0], []
    for at, child in enumerate(children.itertuples()):
        own = tree.siblings(at)
        rows.append((
            child.seq, child.pos, child.finished, path["subroot"] if path["subroot"] is not None else child.digest, path["root"],
            [left.decode() for left, _ in own] + list(path["lefts"]), [right.decode() for _, right in own] + list(path["rights"]),
        ))
    return pd.DataFrame(rows, columns=["seq", "pos", "finished", "subroot", "root", "lefts", "rights"])


def _proofs(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    leaves, tree = _subtree(leaves)
    path, rows = above.iloc[0], []
    outer = [(left.encode(), right.encode()) for left, right in zip(path["lefts"], path["rights"])]
    kept = [hashlib.sha256(left) for left, _ in outer]
    for at, (digest, replaced) in enumerate(zip(leaves["digest"], leaves["replaced"])):
        own = tree.siblings(at)
        proof = hashlib.sha256()
        for left, right in own + outer:
            proof.update(left)
            proof.update(right)
        folded = tree.fold(at, (replaced or digest).encode(), own)
        for before, (_, right) in zip(kept, outer):
            folded = resume(before, folded, right)
        rows.append((digest, path["subroot"], path["root"], proof.hexdigest(), folded.decode()))
    done = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root"])
    done.insert(0, "doc_id", leaves["doc_id"].to_numpy())
    return done


def _by_subtree(nodes: DataFrame):
    return nodes.groupBy("seq", F.expr(f"pos div {SPAN}"))


def _rise(nodes: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Round by round to one node a sequence: the nodes that went into each round, and the sequences' last nodes.

    ``most`` is the length of the longest sequence, which gives the number of rounds.
    """
    rounds, finished = [], []
    while True:
        rounds.append(nodes)
        tops = stored(_by_subtree(nodes.select("seq", "pos", "n", "digest")).applyInPandas(_top, _NODE), "merkle-tops")
        finished.append(tops.where("n = 1").withColumn("finished", F.lit(len(rounds))))
        nodes, most = tops.where("n > 1"), -(-most // SPAN)
        if most <= 1:
            return rounds, finished


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Paths of the nodes of a round from the paths of their subtrees."""
    nodes = nodes if "finished" in nodes.columns else nodes.withColumn("finished", F.lit(None).cast("int"))
    return stored(
        _by_subtree(nodes).cogroup(above.groupBy("seq", "pos")).applyInPandas(_paths, _PATH), "merkle-paths"
    )


def prove(docs: DataFrame, replaced: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    ``replaced`` has the fields that a later copy of the row holds otherwise; ``folded_root`` is the root with that
    row's leaf in place of the recorded one, and ``verified`` tells whether it is the recorded root.
    """
    fields = {name: F.col(name) for name in FIELDS}
    # a key without null, in the order of the sources
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source")))
    now = leaf(fields | replaced) if replaced else F.lit(None).cast("string")
    # stored before the sort, which reads its input twice
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), leaf(fields).alias("digest"), now.alias("replaced"))
    placed = with_position(stored(rows, "merkle-digests"), [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("digest")], "at")
    counted = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    sources = stored(with_position(counted, [F.col("key")], "seq"), "merkle-sources")
    total, n_sources, most = sources.agg(F.sum("n"), F.count("*"), F.max("n")).first()
    if not total:
        return docs.sparkSession.createDataFrame([], f"{_PROOF}, verified boolean")

    numbered = by_weight(placed, sources, "key", "n", total)
    leaves = stored(numbered.select("seq", (F.col("at") - F.col("start")).alias("pos"), "n", "digest", "replaced", "doc_id"), "merkle-leaves")
    rounds, finished = _rise(leaves, most)
    subroots = finished[0]
    for later in finished[1:]:
        subroots = subroots.unionByName(later)
    heads = stored(
        subroots.select(
            F.lit(_SOURCES).cast("long").alias("seq"), (F.col("seq") - 1).alias("pos"), F.lit(n_sources).cast("long").alias("n"), "digest", "finished"
        ),
        "merkle-heads",
    )
    head_rounds, ends = _rise(heads, n_sources)
    nothing = F.array().cast("array<string>")
    above = ends[-1].select(
        "seq", "pos", "finished", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
        nothing.alias("lefts"), nothing.alias("rights"),
    )
    for nodes in reversed(head_rounds[1:]):
        above = _down(nodes, above).withColumn("subroot", F.lit(None).cast("string"))
    # the path of each source's node, under the number of the source
    heads_paths = _down(head_rounds[0], above).withColumns({"seq": F.col("pos") + 1, "pos": F.lit(0).cast("long")})
    paths = heads_paths.where(F.col("finished") == len(rounds))
    for nth in range(len(rounds) - 1, 0, -1):
        paths = _down(rounds[nth], paths).unionByName(heads_paths.where(F.col("finished") == nth))
    proofs = _by_subtree(leaves).cogroup(paths.groupBy("seq", "pos")).applyInPandas(_proofs, _PROOF)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
