"""Merkle manifest of a table, with a proof for every row.

Every row is a leaf. Per tree (a value of the group column) the leaves stand in order; runs of
`RUN` consecutive nodes become one node of the next level until one is left, the subroot.
Subroots, in order of their trees, become the root in the same way.

A superblock holds `RUN ** LEVELS` consecutive nodes, so a tree is reduced superblock by
superblock, and the nodes on top of those likewise, as often as it takes. What a row's proof needs
from outside its superblock is the same for all rows of it: one list of outer siblings. Leaves and
outer siblings are cogrouped by superblock, and there the local reduction is finished, proofs are
joined and digests are folded up to the root.
"""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored

RUN = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<before string, after string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of the values, each as its length in bytes and itself, so that no two rows read alike."""
    return F.sha2(F.concat(*[_encoded(value) for value in values]), 256)


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds `place` (from 0) and `size` of each row in its `tree`, in order of `order`.

    Rows are dealt and sorted by range, so a tree may span many tasks; only one row per task and
    tree is looked at across tasks. Rows that are equal in all of `order` may be in several.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order]
    dealt = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("task"), within.alias("nth")), name)
    spans = dealt.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("rows"), F.min("nth").alias("first"))
    tree = W.partitionBy("tree")
    earlier = F.sum("rows").over(tree.orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    spans = spans.select(
        "tree", "task", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("size")
    )
    joined = dealt.join(spans, ["tree", "task"]).withColumn("place", F.col("nth") + F.col("shift"))
    return joined.drop("task", "nth", "shift")


def _height(size: int) -> int:
    """Levels between `size` nodes and the one they become."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def _climb(digests: list[str], size: int, levels: int) -> list[list[str]]:
    """The nodes of a superblock level by level, of a tree with `size` nodes below."""
    nodes = [digests]
    for _ in range(min(levels, _height(size))):
        below = nodes[-1]
        nodes.append([digest("".join(below[at : at + RUN])) for at in range(0, len(below), RUN)])
    return nodes


def _siblings(nodes: list[str], at: int) -> tuple[str, str]:
    """The other nodes of the run, those before and those after."""
    first = at - at % RUN
    return "".join(nodes[first:at]), "".join(nodes[at + 1 : first + RUN])


def _paths(nodes: list[list[str]], outer: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """By node of the lowest level: its siblings level by level, then the outer ones."""
    above = [outer]
    for level in reversed(nodes[:-1]):
        above = [[_siblings(level, at), *above[at // RUN]] for at in range(len(level))]
    return above


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """One row per superblock of `tree, place, size, node`: the node it becomes, in the tree of such nodes."""
    span = RUN**levels

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        size = int(rows["size"].iloc[0])
        top = _climb(rows["node"].tolist(), size, levels)[-1][0]
        place = int(rows["place"].iloc[0]) // span
        return pd.DataFrame([[rows["tree"].iloc[0], place, -(-size // span), top]], columns=["tree", "place", "size", "node"])

    blocks = nodes.groupBy("tree", F.floor(F.col("place") / span).alias("block"))
    return blocks.applyInPandas(run, "tree string, place long, size long, node string")


def _outer(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """`tree, place, steps, top` of stored `tree, place, size, node`: siblings up to the one node of the tree, and that node."""
    if not nodes.where("size > 1").head(1):
        none = F.array().cast(STEPS)
        return nodes.select("tree", "place", none.alias("steps"), F.col("node").alias("top"))
    span = RUN**levels
    tops = stored(_tops(nodes, levels), name)
    above = _outer(tops, levels, name).withColumnRenamed("place", "block")

    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        climbed = _climb(rows["node"].tolist(), int(rows["size"].iloc[0]), levels)
        outer = [(step["before"], step["after"]) for step in block["steps"].iloc[0]]
        paths = [[{"before": b, "after": a} for b, a in path] for path in _paths(climbed, outer)]
        return pd.DataFrame({"tree": rows["tree"], "place": rows["place"], "steps": paths, "top": block["top"].iloc[0]})

    left = nodes.groupBy("tree", F.floor(F.col("place") / span).alias("block"))
    joined = left.cogroup(above.groupBy("tree", "block"))
    return stored(joined.applyInPandas(run, f"tree string, place long, steps {STEPS}, top string"), name)


def _finish(levels: int):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        leaves = rows["node"].tolist()
        outer = [(step["before"], step["after"]) for step in block["steps"].iloc[0]]
        paths = _paths(_climb(leaves, int(rows["size"].iloc[0]), levels), outer)
        subroot, root = block["subroot"].iloc[0], block["root"].iloc[0]
        out = []
        for doc_id, leaf, offered, path in zip(rows["doc_id"], leaves, rows["offered"], paths, strict=True):
            folded = offered
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join([side for step in path for side in step]))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
        table = pd.DataFrame(out, columns=columns)
        return table.assign(doc_id=table["doc_id"].astype("Int64"))

    return run


def prove(leaves: DataFrame, order: list[str], levels: int = LEVELS) -> DataFrame:
    """`doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` of `tree, doc_id, node, offered` rows.

    `tree` sorts the trees. `node` is the leaf that the manifest is made of and `offered` the one that
    is folded up to the root with the proof of its place.
    """
    span = RUN**levels
    nodes = placed(leaves, order, "merkle-leaves")
    tops = stored(_tops(nodes, levels), "merkle-tops")
    within = _outer(tops, levels, "merkle-outer")
    trees = placed(within.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), "top"), ["name"], "merkle-trees")
    trees = stored(trees, "merkle-trees")
    roots = _outer(trees.select("tree", "place", "size", F.col("top").alias("node")), levels, "merkle-roots")
    rooted = trees.select("place", "name", "top").join(roots.select("place", F.col("steps").alias("last"), F.col("top").alias("root")), "place")
    outer = within.join(rooted.select(F.col("name").alias("tree"), F.col("top").alias("subroot"), "last", "root"), "tree").select(
        "tree", F.col("place").alias("block"), F.concat("steps", "last").alias("steps"), "subroot", "root"
    )
    left = nodes.select("tree", "place", "size", "doc_id", "node", "offered")
    left = left.groupBy("tree", F.floor(F.col("place") / span).alias("block"))
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return left.cogroup(outer.groupBy("tree", "block")).applyInPandas(_finish(levels), schema)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """The manifest of `docs` (`doc_id, source, lang, n_chars, text`) with a proof per row, by language.

    Where `tampered` holds, the row is offered with its text in lower case; a null condition is none.
    The null language comes first. Leaves of a language ascend by doc_id (null first), equal ids by
    digest, so repeated rows stand side by side, each a leaf with a place and proof of its own. Null
    and empty values have different digests. An empty table has no root and gives no rows. Other
    columns are ignored.
    """
    values = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(*values.values())
    if tampered is None:
        offered = F.col("node")
    else:
        changed = leaf_digest(*{**values, "text": lower_ascii(F.col("text"))}.values())
        offered = F.coalesce(F.when(tampered, changed), F.col("node"))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    # The text is read here and not again: the shuffles below move digests.
    hashed = docs.select(*FIELDS, tree.alias("tree"), leaf.alias("node")).select(
        "tree", "doc_id", "node", offered.alias("offered"), F.monotonically_increasing_id().alias("row")
    )
    return prove(stored(hashed, "merkle-hashed"), ["doc_id", "node", "row"], levels)
