"""Merkle manifest of a dataset: few stored levels, interior nodes recomputed for proofs.

A tree stands over the rows of each group, another one over the groups' roots.
Of a tree only every third level is stored. Whoever needs a proof takes the
aligned subtree below a stored node, hashes its missing levels again from the
stored descendants, and forgets them once the siblings are read off.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.shared import map_batches, stored

#: Nodes that make one parent, and levels from one stored level to the next.
FAN = 16
LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """A value with its length in bytes, so that neighbouring fields cannot run into each other."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 in hex over the fields of a row."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def with_positions(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with their ``position`` (from 0) in their group and the group's size ``n``; stored.

    Rows are range-partitioned, so a large group spreads over many tasks. Places
    in a partition become positions by adding the group's rows in the partitions before: a row for
    each group and partition. Ties are broken by where a row was read.
    """
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*by, *order, "tie").sortWithinPartitions(*by, *order, "tie").drop("tie")
    rows = rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    rows = stored(rows, "ordered")
    runs = rows.groupBy(*by, "part").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(*by)  # a row for each partition that holds some of the group
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        *by, "part", "begin", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("n")
    )
    placed = rows.join(runs, [*by, "part"]).withColumn("position", F.col("before") + F.col("at") - F.col("begin"))
    return placed.drop("part", "at", "begin", "before")


def _runs(nodes: list[bytes], fan: int) -> list[bytes]:
    return [b"".join(nodes[i:i + fan]) for i in range(0, len(nodes), fan)]


def _hex(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def heights(n: int, fan: int, levels: int) -> int:
    """Levels that a subtree of a tree with ``n`` nodes has above them: all of them, or as many as lead to one node."""
    if n > fan**levels:
        return levels
    found = 0
    while n > 1:
        n, found = -(-n // fan), found + 1
    return found


def subtree(nodes: list[bytes], n: int, fan: int, levels: int) -> tuple[bytes, list[list[bytes]]]:
    """The top of an aligned subtree, and for each of its levels the runs, joined, that became a parent."""
    runs = []
    for _ in range(heights(n, fan, levels)):
        runs.append(_runs(nodes, fan))
        nodes = [_hex(r) for r in runs[-1]]
    return nodes[0], runs


def siblings(runs: list[list[bytes]], at: int, fan: int, begin: int = 0) -> list[tuple[bytes, bytes]]:
    """What stands before and after a node on each level from ``begin`` up to the subtree's top."""
    path = []
    for run in runs[begin:]:
        whole, i = run[at // fan], at % fan
        path.append((whole[:64 * i], whole[64 * (i + 1):]))
        at //= fan
    return path


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (grp, block) after another; at most fan^levels nodes and a row with their path."""
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            place = (row["grp"], row["block"])
            if place != last and rows:
                yield rows
                rows = []
            last = place
            rows.append(row)
    if rows:
        yield rows


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "position")


def _parents(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """The nodes ``levels`` higher, or the root of a tree that has no more levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            n = rows[0]["n"]
            top, _ = subtree([r["digest"].encode() for r in rows], n, fan, levels)
            size = fan**levels
            yield pa.RecordBatch.from_pydict({
                "grp": [rows[0]["grp"]], "position": [rows[0]["block"]], "n": [-(-n // size)], "digest": [top.decode()],
            })

    rows = nodes.where("n > 1").select("grp", F.expr(f"position div {fan**levels}").alias("block"), "position", "n", "digest")
    return map_batches(_dealt(rows), run, "grp string, position bigint, n bigint, digest string")


def build(leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """The stored levels of the trees over stored rows (grp, position, n, digest), leaves first.

    A tree leaves off where it has one node; the number of rounds is that of the
    largest tree.
    """
    found = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        found.append(stored(_parents(found[-1], fan, levels), "nodes"))
        most = -(-most // fan**levels)
    return found


def roots(tree: list[DataFrame]) -> DataFrame:
    """grp and digest of the root of each tree."""
    tops = [level.where("n = 1").select("grp", "digest") for level in tree]
    out = tops[0]
    for one in tops[1:]:
        out = out.unionByName(one)
    return out


_PATH = "top string, befores array<string>, afters array<string>"


def _with_paths(nodes: DataFrame, paths: DataFrame, size: int, payload: Sequence[str] = ()) -> DataFrame:
    """The nodes, dealt by block, and before those of each block a row with the path above it."""
    rows = nodes.select("grp", F.expr(f"position div {size}").alias("block"), "position", "n", "digest", *payload)
    heads = paths.select("grp", F.col("position").alias("block"), "top", "befores", "afters")
    return _dealt(rows.unionByName(heads.withColumn("position", F.lit(-1).cast("bigint")), allowMissingColumns=True))


def _parsed(rows: list[dict], fan: int, levels: int):
    """The block's path above, its nodes, and the runs of its levels, hashed anew."""
    head, nodes = rows[0], rows[1:]
    above = [(b.encode(), a.encode()) for b, a in zip(head["befores"], head["afters"], strict=True)]
    _, runs = subtree([r["digest"].encode() for r in nodes], nodes[0]["n"], fan, levels)
    return head["top"], above, nodes, runs


def _paths(nodes: DataFrame, paths: DataFrame, fan: int, levels: int) -> DataFrame:
    """The path of each node, from the paths of the stored nodes above (or of the roots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            top, above, own, runs = _parsed(rows, fan, levels)
            full = [siblings(runs, i, fan) + above for i in range(len(own))]
            yield pa.RecordBatch.from_pydict({
                "grp": [r["grp"] for r in own], "position": [r["position"] for r in own], "top": [top] * len(own),
                "befores": [[b.decode() for b, _ in p] for p in full], "afters": [[a.decode() for _, a in p] for p in full],
            }, schema=pa.schema([
                ("grp", pa.string()), ("position", pa.int64()), ("top", pa.string()),
                ("befores", pa.list_(pa.string())), ("afters", pa.list_(pa.string())),
            ]))

    return map_batches(_with_paths(nodes, paths, fan**levels), run, f"grp string, position bigint, {_PATH}")


def above_leaves(tree: list[DataFrame], tops: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The paths that stand above the blocks of leaves: grp, position (of the block) and the path.

    ``tops`` has for each tree (grp) what stands above its root. Goes down the stored levels;
    only those paths are written that lead to stored nodes, one for thousands of leaves.
    """
    below = None
    for level in reversed(range(len(tree))):
        ends = tree[level].where("n = 1").select("grp", F.lit(0).cast("bigint").alias("position")).join(tops, "grp")
        paths = ends if below is None else ends.unionByName(below)
        if level == 0:
            return paths
        below = stored(_paths(tree[level], paths, fan, levels), "paths")


def proofs(leaves: DataFrame, paths: DataFrame, root: str | None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of each leaf.

    A block of leaves is hashed up to its stored node, each leaf's siblings are read off from the leaf to the root, left to
    right, and hashed; ``changed``, where it is not null, is folded in place of the leaf.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            top, above, own, runs = _parsed(rows, fan, levels)
            out: dict[str, list] = {"key": [], "leaf": [], "subroot": [], "proof_sha256": [], "folded_root": []}
            higher, joined, parent = [], b"", -1
            for i, row in enumerate(own):
                if i // fan != parent:
                    parent = i // fan
                    higher = siblings(runs, parent, fan, 1) + above
                    joined = b"".join(b + a for b, a in higher)
                first = siblings(runs[:1], i, fan)
                node = (row["changed"] or row["digest"]).encode()
                for before, after in first + higher:
                    node = _hex(before + node + after)
                out["key"].append(row["key"])
                out["leaf"].append(row["digest"])
                out["subroot"].append(top)
                out["proof_sha256"].append(sha256(b"".join(b + a for b, a in first) + joined).hexdigest())
                out["folded_root"].append(node.decode())
            yield pa.RecordBatch.from_pydict(out, schema=shape)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = leaves.schema["key"].dataType
    text = [(c, pa.string()) for c in ("leaf", "subroot", "proof_sha256", "folded_root")]
    shape = pa.schema([("key", to_arrow_type(kind)), *text])
    rows = map_batches(
        _with_paths(leaves, paths, fan**levels, ["key", "changed"]), run,
        f"key {kind.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string",
    )
    root = F.lit(root).cast("string")
    return rows.select(
        "key", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "source", columns: Sequence[str] = COLUMNS,
    text: str = "text", tampered: Column | None = None, fan: int = FAN, levels: int = LEVELS,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    A leaf is the hash of the row's ``columns``. The leaves of a ``group``, ascending by key
    (null first), form a tree of ``fan`` children, whose root is subroot; the subroots, ordered by group (null first,
    bytewise), form the tree of root. proof_sha256 is the hash over all siblings from leaf to root, and folded_root
    what they and the leaf lead to. Rows for which ``tampered`` is true are folded with the
    letters A-Z of their text lower-cased, so that verified tells whether the change shows.

    Rows of equal group and key are ordered by leaf; equal rows are leaves of their own, next to each other.
    Null values are part of the leaf. Other columns are not read. An empty table gives no rows. Groups
    of any size are spread: leaves are dealt in blocks of fan^levels.
    """
    value = {c: docs[c] for c in columns}
    changed = {c: F.translate(v.cast("string"), UPPER, LOWER) if c == text else v for c, v in value.items()}
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    name = F.when(docs[group].isNull(), "").otherwise(F.concat(F.lit("="), docs[group].cast("string")))
    leaves = docs.select(
        name.alias("grp"), docs[key].alias("key"), leaf_digest(list(value.values())).alias("digest"),
        F.when(tampered, leaf_digest(list(changed.values()))).alias("changed"),
    )
    leaves = stored(with_positions(leaves, ["grp"], ["key", "digest"]), "leaves")
    tree = build(leaves.select("grp", "position", "n", "digest"), fan, levels)
    names = roots(tree).select(F.col("grp").alias("name"), "digest")
    groups = stored(with_positions(names.withColumn("grp", F.lit("")), ["grp"], ["name"]), "groups")
    over = build(groups.select("grp", "position", "n", "digest"), fan, levels)
    root = roots(over).first()
    root = root["digest"] if root else None
    none = F.array().cast("array<string>")
    start = docs.sparkSession.range(1).select(
        F.lit("").alias("grp"), F.lit(root).cast("string").alias("top"), none.alias("befores"), none.alias("afters")
    )
    size = fan**levels
    up = above_leaves(over, start, fan, levels)
    up = _group_paths(groups, up, fan, levels, size)
    return proofs(leaves, above_leaves(tree, up, fan, levels), root, fan, levels).withColumnRenamed("key", key)


def _group_paths(groups: DataFrame, paths: DataFrame, fan: int, levels: int, size: int) -> DataFrame:
    """For each group (grp): top, its own subroot, and what stands above it."""
    found = stored(_paths(groups.select("grp", "position", "n", "digest"), paths, fan, levels), "group-paths")
    found = found.join(groups.select("position", "name", "digest"), "position")
    return found.select(F.col("name").alias("grp"), F.col("digest").alias("top"), "befores", "afters")
