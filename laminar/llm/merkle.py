"""Merkle manifest of a dataset: persist every few levels, recompute the rest when a proof is asked for.

Each row is a leaf (sha256 over its length-prefixed fields). Leaves of a group (here: a language) ascend by
the order key; ``fanout`` consecutive nodes (the last run: fewer, even one) are hashed into their parent
until one node, the group's subroot, remains. The subroots, in group order, are the leaves of the top tree.

Checkpoint. Only the levels 0, ``every``, 2 x ``every``, ... are written. Between two of them lie aligned
subtrees of at most fanout ** every nodes; each is one small row of digests, so a group with a third or all
of the rows is spread over as many rows as any other.

Recompute. Proofs go from the top down: a node of a written level has its path to the root; its subtree's
stored descendants are gathered, the interior nodes in between are made again, every descendant's siblings are
emitted in front of the node's path, and the interior nodes are forgotten. A step is one equi-join on
(group, subtree) between two written levels.

A path is bytes: per level the number of siblings before and after the node (one byte each) and the siblings'
raw digests. ``fold`` recomputes the root from any digest and a path.

Edge cases: NULL fields are hashed as ``-``, so they differ from empty ones; NULL groups form a group that
comes first; NULL order keys come first; rows with the same key are ordered by their leaf, equal rows take
neighbouring places in either order, which gives the same rows out; a group of one row has its leaf as subroot;
an empty table gives no rows. Columns that are not named in ``columns`` are not read.
"""

from __future__ import annotations

import binascii
import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.llm.common import materialise

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, EVERY = 2, 10


def combine(nodes: Sequence[bytes]) -> bytes:
    """Parent of some raw digests: sha256 over their concatenated hex texts."""
    return hashlib.sha256(binascii.hexlify(b"".join(nodes))).digest()


def climb(nodes: list[bytes], levels: int, fanout: int) -> list[list[bytes]]:
    """The nodes and ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        nodes = [combine(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def paths(levels: list[list[bytes]], fanout: int) -> list[bytes]:
    """For each node of the lowest level its siblings on the way to the top level, as path bytes."""
    above = [b""] * len(levels[-1])
    for nodes in reversed(levels[:-1]):
        own = []
        for i in range(len(nodes)):
            run = nodes[i - i % fanout:i - i % fanout + fanout]
            at = i % fanout
            own.append(bytes((at, len(run) - 1 - at)) + b"".join(run[:at] + run[at + 1:]) + above[i // fanout])
        above = own
    return above


def siblings(path: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(siblings before, siblings after) level by level."""
    at = 0
    while at < len(path):
        before, after = path[at], path[at + 1]
        found = [path[k:k + 32] for k in range(at + 2, at + 2 + 32 * (before + after), 32)]
        yield found[:before], found[before:]
        at += 2 + 32 * (before + after)


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for before, after in siblings(path):
        digest = combine([*before, digest, *after])
    return digest


def height(count: int, fanout: int) -> int:
    """Levels above ``count`` nodes until one remains."""
    levels = 0
    while count > 1:
        count, levels = -(-count // fanout), levels + 1
    return levels


def leaf(columns: Sequence[Column]) -> Column:
    """Hex digest of length-prefixed fields; NULL is ``-``."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


@dataclass
class Manifest:
    """Written levels of the groups' trees and of the top tree above their subroots, lowest first."""
    groups: list[DataFrame]
    top: list[DataFrame]
    fanout: int
    every: int


def numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` (with _group) written in ranges of the order, with ``idx`` in the group and the group's size ``n``."""
    at = leaves.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))   # splits a hot run of equal rows
    by = [F.col(c).asc_nulls_first() for c in ("_group", *order, "_salt")]
    dealt = materialise(at.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
                        .withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()), "leaves")
    # one row per partition and per group in it
    runs = dealt.groupBy("_part", "_group").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = W.partitionBy("_group")
    runs = runs.select("_part", "_group", "_first", F.sum("_rows").over(own).alias("n"),
                       F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (dealt.join(runs, ["_part", "_group"])
            .withColumn("idx", F.col("_before") + F.col("_seq") - F.col("_first")).drop("_part", "_seq", "_first", "_before"))


def _subtrees(nodes: DataFrame, width: int, payload: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree: its nodes in order (at most ``width``), each with its payload."""
    return (nodes.groupBy("_group", "n", F.floor(F.col("idx") / width).cast("bigint").alias("sub"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "node", *payload))).alias("nodes")))


def _build(level0: DataFrame, fanout: int, every: int, name: str) -> list[DataFrame]:
    """Levels 0, every, 2 x every, ... up to the one where each group has one node."""
    levels = [level0]
    tallest = height(level0.agg(F.max("n")).first()[0] or 1, fanout)
    for low in range(0, tallest, every):
        def roots(batches, low=low):
            for batch in batches:
                group, n, sub, nodes = (batch.column(c).to_pylist() for c in ("_group", "n", "sub", "nodes"))
                made = [climb([x["node"] for x in run], min(every, max(0, height(count, fanout) - low)), fanout)[-1][0]
                        for run, count in zip(nodes, n, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.string()), pa.array(n, pa.int64()), pa.array(sub, pa.int64()),
                                                  pa.array(made, pa.binary())], names=["_group", "n", "idx", "node"])
        levels.append(materialise(_subtrees(levels[-1].select("_group", "n", "idx", "node"), fanout ** every)
                                  .mapInArrow(roots, "_group string, n bigint, idx bigint, node binary"), f"{name}-{low + every}"))
    return levels


def build(leaves: DataFrame, group: str, order: Sequence[str], fanout: int = FANOUT, every: int = EVERY,
          node: str = "leaf") -> Manifest:
    """The written levels over ``leaves`` (hex digests in column ``node``; other columns are carried to the proofs)."""
    if not 2 <= fanout <= 256 or every < 1:
        raise ValueError("fanout is 2 to 256 and every at least 1")
    marked = leaves.withColumn("_group", F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n")))   # NULL first
    rows = materialise(numbered(marked.withColumn("node", F.unhex(F.col(node))), [*order, node]), "level-0")
    groups = _build(rows, fanout, every, "level")
    subroots = groups[-1].select(F.lit("").alias("_group"), F.col("_group").alias("member"), "node")
    top = materialise(numbered(subroots, ["member"]), "top-0")
    return Manifest(groups, _build(top, fanout, every, "top"), fanout, every)


def _descend(levels: list[DataFrame], tips: DataFrame, payload: Sequence[str], fanout: int, every: int) -> DataFrame:
    """Paths of the lowest level's nodes; tips: (_group, path, root...) of each group's single top node."""
    keep = [c for c in tips.columns if c not in ("_group", "path")]
    kinds = {c: t for c, t in tips.dtypes}
    known = tips.withColumn("sub", F.lit(0).cast("bigint"))
    for k in range(max(0, len(levels) - 2), -1, -1):
        low, carried = k * every, payload if k == 0 else ()
        types = {c: t for c, t in levels[k].dtypes if c in carried}
        out = ", ".join(["_group string", "sub bigint", "node binary", "path binary", *[f"`{c}` {kinds[c]}" for c in keep],
                         *[f"`{c}` {t}" for c, t in types.items()]])

        def emit(batches, low=low, carried=carried, single=len(levels) == 1):
            for batch in batches:
                schema = dict(zip(batch.schema.names, batch.schema.types, strict=True))
                inner = schema["nodes"].value_type
                column = {c: [] for c in ("_group", "sub", "node", "path", *keep, *carried)}
                for row in batch.to_pylist():
                    count = 0 if single else min(every, max(0, height(row["n"], fanout) - low))
                    digests = [x["node"] for x in row["nodes"]]
                    for x, path in zip(row["nodes"], paths(climb(digests, count, fanout), fanout), strict=True):
                        column["_group"].append(row["_group"])
                        column["sub"].append(x["idx"])
                        column["node"].append(x["node"])
                        column["path"].append(path + row["path"])
                        for c in keep:
                            column[c].append(row[c])
                        for c in carried:
                            column[c].append(x[c])
                kind = {"_group": pa.string(), "sub": pa.int64(), "node": pa.binary(), "path": pa.binary(),
                        **{c: schema[c] for c in keep}, **{c: inner.field(c).type for c in carried}}
                yield pa.RecordBatch.from_arrays([pa.array(column[c], kind[c]) for c in column], names=list(column))

        stored = _subtrees(levels[k], fanout ** every, carried)
        known = stored.join(known.drop("node"), ["_group", "sub"]).mapInArrow(emit, out)
    return known


def proofs(manifest: Manifest, payload: Sequence[str] = ()) -> DataFrame:
    """One row per leaf: the carried columns, idx, node, subroot, root (raw digests) and its path to the root."""
    options = (manifest.fanout, manifest.every)
    crown = manifest.top[-1].select("_group", F.lit(b"").alias("path"), F.col("node").alias("root"))
    tops = _descend(manifest.top, crown, ["member"], *options)
    tips = tops.select(F.col("member").alias("_group"), "path", F.col("node").alias("subroot"), "root")
    return _descend(manifest.groups, tips, payload, *options).withColumnRenamed("sub", "idx").drop("_group")


def verify(proven: DataFrame, claim: str = "claim") -> DataFrame:
    """``proven`` (from ``proofs``) with proof_sha256, folded_root (both hex; from the hex digest in ``claim``) and verified."""
    base = [c for c in proven.columns if c not in ("path", "node", "subroot", "root")]
    out = ", ".join([*[f"`{c}` {t}" for c, t in proven.dtypes if c in base],
                     "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"])

    def check(batches):
        for batch in batches:
            path = batch.column("path").to_pylist()
            root = batch.column("root").to_pylist()
            folded = [fold(bytes.fromhex(c), p) for c, p in zip(batch.column(claim).to_pylist(), path, strict=True)]
            sha = [hashlib.sha256(b"".join(binascii.hexlify(x) for pair in siblings(p) for part in pair for x in part)).hexdigest()
                   for p in path]
            texts = [[x.hex() for x in batch.column(c).to_pylist()] for c in ("node", "subroot")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in base], *[pa.array(t, pa.string()) for t in texts],
                 pa.array([x.hex() for x in root], pa.string()), pa.array(sha, pa.string()),
                 pa.array([x.hex() for x in folded], pa.string()),
                 pa.array([a == b for a, b in zip(folded, root, strict=True)], pa.bool_())],
                names=[*base, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return proven.mapInArrow(check, out)


def tampered_leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, tamper: str = "n_chars", id_col: str = "doc_id",
                    modulus: int = 7) -> DataFrame:
    """(id, group columns, leaf, claim): the claim is the leaf after adding 1 to ``tamper`` where ``modulus`` divides the
    crc32 of the id as text (a NULL id is never tampered with, a NULL value stays)."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == 0
    changed = [F.col(c) + 1 if c == tamper else F.col(c) for c in columns]
    own = leaf([F.col(c) for c in columns])
    return docs.select(F.col(id_col).alias("doc_id"), F.col("lang"), own.alias("leaf"),
                       F.when(hit, leaf(changed)).otherwise(own).alias("claim"))
