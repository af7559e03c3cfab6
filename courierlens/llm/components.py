"""Connected components by contraction.

Each round, every task shrinks the links that it holds to stars. A node then meets the
centres of all its stars in one grouping: they are linked to one of them, and a node that
is itself no centre leaves the graph as a child of that one. Ranks drawn anew each
round decide which node of a star is its centre, so that chains shrink however they are
numbered. A node brings one row from each batch of links, whatever its degree. The trees
of those that left are flattened by jumping to the parent's parent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import attach, written

#: Links that a task shrinks at once, and that a task reads from the second round on.
BATCH = 200_000
STAR = pa.schema([("node", pa.int64()), ("centre", pa.int64()), ("rank", pa.int64())])


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give what the links a-b connect one label, the least index."""
    while len(a):
        la, lb = label[a], label[b]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars that connect what the links connect: each node's centre, null for centres themselves."""

    def shrunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v, u_rank, v_rank = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(4))
        rank, first, at = np.unique(np.r_[u_rank, v_rank], return_index=True, return_inverse=True)
        node = np.r_[u, v][first]
        label = np.arange(len(node))
        merge(label, at[: len(u)], at[len(u) :])
        own = label == np.arange(len(node))
        columns = [pa.array(node), pa.array(node[label], mask=own), pa.array(rank[label], mask=own)]
        return pa.RecordBatch.from_arrays(columns, schema=STAR)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= BATCH:
            yield shrunk(held)
            held, size = [], 0
    if size:
        yield shrunk(held)


def _contracted(edges: DataFrame, turn: int) -> DataFrame:
    """``u, v, left``: the links that remain, and where ``left`` each node that left with its parent."""
    ranks = [F.xxhash64(F.col(end).cast("long"), F.lit(turn)).alias(f"{end}_rank") for end in ("u", "v")]
    stars = edges.select(F.col("u").cast("long"), F.col("v").cast("long"), *ranks).mapInArrow(
        _stars, "node long, centre long, rank long"
    )
    met = stars.groupBy("node").agg(
        F.min_by("centre", "rank").alias("parent"),
        F.collect_set("centre").alias("centres"),
        (F.count("centre") == F.count(F.lit(1))).alias("left"),
    )
    own = F.struct(F.col("node").alias("u"), F.col("parent").alias("v"), "left")
    others = F.transform(
        F.filter("centres", lambda c: c != F.col("parent")),
        lambda c: F.struct(c.alias("u"), F.col("parent").alias("v"), F.lit(False).alias("left")),
    )
    return met.where("parent is not null").select(F.inline(F.concat(F.array(own), others)))


def rooted(edges: DataFrame) -> DataFrame:
    """``node, root`` for edges ``u, v`` of whole numbers: root is one node of the component, the same for all.

    Roots themselves and nodes without an edge to another node aren't listed. Repeated
    edges and loops change nothing.
    """
    links, trees, many = edges.select("u", "v").where("u != v"), [], -1
    while many:
        found = written(_contracted(links, len(trees)), "edges")
        trees.append(found.where("left").select(F.col("u").alias("node"), F.col("v").alias("root")))
        links = found.where("not left")
        many = links.count()
        links = links.coalesce(1 + many // BATCH)
    tree = reduce(DataFrame.unionByName, trees)
    for _ in range((len(trees) - 1).bit_length()):  # a parent left in a later round or never: so many jumps reach roots
        above = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = attach(tree, above, "root", "node", how="left")
        tree = written(jumped.select("node", F.coalesce("above", "root").alias("root")), "trees")
    return tree


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for edges ``u, v`` of whole numbers: root is the least node of the component.

    Nodes without an edge to another node aren't listed. Repeated edges and loops
    change nothing.
    """
    tree = rooted(edges)
    least = tree.groupBy("root").agg(F.least(F.min("node"), F.col("root")).alias("least"))
    named = attach(tree, least, "root", "node").select("node", F.col("least").alias("root"))
    return named.unionByName(least.select(F.col("root").alias("node"), F.col("least").alias("root")))
