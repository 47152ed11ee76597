"""Merkle manifest of a table by cogrouped subtree exchange.

Each part of the table (a language) is a tree over its rows in order of their
id, eight children a node; the parts' roots are the leaves of one more tree.  A
superblock is a run of 8 ** LEVELS consecutive nodes of one level, so its
inner nodes need no other rows.  Upwards, each superblock is reduced to one digest
(``applyInPandas``), and these digests are the leaves of the next tree, until one
is left.  Downwards, the nodes of a superblock are cogrouped with what stands
outside it on the way to the root: in one ``applyInPandas`` the superblock is
reduced again, each node's siblings inside are joined to the siblings outside,
and at the bottom the proof is hashed and folded.  No group is larger than a
superblock, however many rows one part holds; positions come from a range
partitioning and sums over its partitions, so no task sees a whole part.

Digests are SHA-256 in lowercase hex, of the children's digests as text.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstream.llm.common import quoted
from trendstream.session import materialize

FANOUT = 8
LEVELS = 3                  # of a superblock: 512 nodes
SUPERBLOCK = FANOUT ** LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def reduced(digests: list[str], levels: int) -> list[list[str]]:
    """The levels above ``digests``, at most ``levels`` of them."""
    out = [digests]
    for _ in range(levels):
        at = out[-1]
        out.append([sha("".join(at[i:i + FANOUT])) for i in range(0, len(at), FANOUT)])
    return out


def sides(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """For each step up from node i: what stands left and right of it in its run."""
    out = []
    for at in levels[:-1]:
        run = i - i % FANOUT
        out.append(("".join(at[run:i]), "".join(at[i + 1:run + FANOUT])))
        i //= FANOUT
    return out


def folded(digest: str, path) -> str:
    for left, right in path:
        digest = sha(left + digest + right)
    return digest


def positioned(rows: DataFrame, part: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 inside the part, in ``order``; nulls first) and ``size`` of the part."""
    keys = [part, *order]
    spread = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), "merkle-rows")
    placed = materialize(
        spread.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*keys, "_tie"]])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in [*keys, "_tie"]])
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.spark_partition_id()), "merkle-placed")
    runs = placed.groupBy(F.col(part).alias("_part"), F.col("_task").alias("_run")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_part").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs.select(
        "_part", "_run", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_part")).alias("size")), "merkle-runs")
    same = F.col(part).eqNullSafe(F.col("_part")) & (F.col("_task") == F.col("_run"))
    return (placed.join(runs.hint("merge"), same)
            .select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "size"))


def _block(df: DataFrame) -> DataFrame:
    return df.withColumn("block", F.floor(F.col("pos") / SUPERBLOCK).cast("long"))


def _steps(size: int) -> int:
    """Levels until one node is left, at most those of a superblock."""
    steps = 0
    while size > 1 and steps < LEVELS:
        size, steps = -(-size // FANOUT), steps + 1
    return steps


def _tops(nodes: DataFrame) -> DataFrame:
    """(part, pos, digest, size): one node for each superblock of (part, pos, digest, size)."""
    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iloc[0])
        last = reduced(block["digest"].tolist(), _steps(size))[-1]
        return pd.DataFrame({"part": block["part"].iloc[:1], "pos": block["block"].iloc[:1], "digest": last,
                             "size": [-(-size // SUPERBLOCK)]})
    return _block(nodes).groupBy("part", "block").applyInPandas(top, nodes.select("part", "pos", "digest", "size").schema)


_PATH = "array<struct<left: string, right: string>>"


def _paths(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """(part, pos, path): the steps from each node to the root.

    ``outer`` (part, pos = number of the superblock, path) holds the steps above each superblock.
    """
    def down(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels = reduced(block["digest"].tolist(), _steps(int(block["size"].iloc[0])))
        rest = [(p["left"], p["right"]) for p in above["path"].iloc[0]]
        return pd.DataFrame({"part": block["part"], "pos": block["pos"], "path": [
            [{"left": a, "right": b} for a, b in sides(levels, i) + rest] for i in range(len(block))]})
    return (_block(nodes).groupBy("part", "block")
            .cogroup(outer.withColumnRenamed("pos", "block").groupBy("part", "block"))
            .applyInPandas(down, f"part {nodes.schema['part'].dataType.simpleString()}, pos long, path {_PATH}"))


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round (the given ones first) and the roots (part, digest)."""
    rounds = [nodes]
    while True:
        tops = materialize(_tops(rounds[-1]), "merkle-tops")
        if tops.filter("size > 1").isEmpty():
            return rounds, tops.select("part", "digest")
        rounds.append(tops)


def _descend(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """The steps above each superblock of the first round, from those above the roots (part, path)."""
    outer = outer.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(rounds[1:]):
        outer = materialize(_paths(nodes, outer), "merkle-paths")
    return outer


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             id_col: str = "doc_id", part_col: str = "lang", tampered: dict[str, Column] | None = None,
             where: Column | None = None, keep_path: bool = False) -> DataFrame:
    """(id, part, pos, leaf, subroot, root, proof, folded_root, verified), one row per row of ``docs``.

    A leaf is the digest of the ``fields`` (see ``field``).  Leaves of a part stand
    in order of the id, nulls first, rows of one id in order of their leaves;
    parts in order of their value, null first, bytewise.  pos counts
    a part's leaves from 0.  ``tampered`` replaces fields by expressions in the
    rows that ``where`` holds for; folded_root is what each row's leaf, made from
    the replaced fields, gives with the original siblings of its path, and
    verified says whether that is the root.  proof is the digest of all
    siblings, from the leaf to the root; ``keep_path`` adds them as ``path``, an
    array of what stands left and right of each step's node.  Repeated rows are
    leaves of their own; an empty table gives an empty result.  Other columns of
    ``docs`` are not read.
    """
    spark = docs.sparkSession
    own = {f: F.col(quoted(f)) for f in fields}
    changed = leaf([{**own, **(tampered or {})}[f] for f in fields])
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(part_col)).cast("string").alias("part"),
                       leaf([own[f] for f in fields]).alias("digest"),
                       F.when(F.lit(False) if where is None else where, changed).alias("seen"))
    leaves = materialize(positioned(rows, "part", ["id", "digest"]), "merkle-leaves")
    schema = ("id long, part string, pos long, leaf string, subroot string, root string, proof string, "
              "folded_root string, verified boolean" + f", path {_PATH}" * keep_path)
    if leaves.isEmpty():
        return spark.createDataFrame([], schema)

    rounds, subroots = _tree(leaves)
    upper = materialize(positioned(subroots.select(F.lit(0).alias("part"), F.col("part").alias("name"), "digest"),
                                   "part", ["name"]), "merkle-parts")
    upper_rounds, top = _tree(upper.select("part", "pos", "digest", "size"))
    root = top.first()["digest"]                           # one row
    above = _paths(upper_rounds[0], _descend(upper_rounds, top.select("part", F.array().cast(_PATH).alias("path"))))
    subroots = materialize(upper.join(above.hint("merge"), ["part", "pos"]).select(
        F.col("name").alias("part"), F.col("digest").alias("subroot"), "path"), "merkle-subroots")
    outer = _descend(rounds, subroots.select("part", "path"))
    blocks = (outer.alias("o").join(subroots.alias("s").hint("merge"), F.col("o.part").eqNullSafe(F.col("s.part")))
              .select("o.part", F.col("o.pos").alias("block"), "o.path", "s.subroot"))

    def finish(block: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        digests = block["digest"].tolist()
        levels = reduced(digests, _steps(int(block["size"].iloc[0])))
        rest = [(p["left"], p["right"]) for p in outside["path"].iloc[0]]
        paths = [sides(levels, i) + rest for i in range(len(digests))]
        roots = [folded(was if now is None else now, path) for now, was, path in zip(block["seen"], digests, paths)]
        out = block[["id", "part", "pos"]].assign(
            leaf=digests, subroot=outside["subroot"].iloc[0], root=root,
            proof=[sha("".join(a + b for a, b in path)) for path in paths], folded_root=roots,
            verified=[r == root for r in roots])
        if keep_path:
            out["path"] = [[{"left": a, "right": b} for a, b in path] for path in paths]
        return out

    # ids travel as text: pandas has no nullable long of its own
    return (_block(leaves).withColumn("id", F.col("id").cast("string")).groupBy("part", "block")
            .cogroup(blocks.groupBy("part", "block")).applyInPandas(finish, schema.replace("id long", "id string"))
            .withColumn("id", F.col("id").cast("long")))
