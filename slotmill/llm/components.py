"""Connected components of a link table by repeated contraction; nothing is collected."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotmill.llm.common import materialise


def spanning_links(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, node) that connect exactly what the links (u, v) connect, one per node but the roots."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[child]], nodes[child]


def connected(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of a link (u, v); root is one node of the component.

    Each round points every node at its smallest neighbour, if that is smaller than itself, and
    carries the links over to what their ends point at. Stars and short ways, which near copies make,
    take a few rounds; a way of steadily growing ids takes as many as it has links. Self links and
    repeated links do no harm; null ends are ignored. The maps of the rounds are then chained backwards.
    """
    links = links.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    maps = []
    while True:
        links = materialise(links, label)
        if links.isEmpty():
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
        parents = materialise(parents.select("node", F.least("node", "near").alias("parent")), label)
        maps.append(parents)
        of_u = parents.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        of_v = parents.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        moved = links.join(of_u, "u").join(of_v, "v")
        low, high = F.least("pu", "pv"), F.greatest("pu", "pv")
        links = moved.filter("pu <> pv").select(low.alias("u"), high.alias("v")).distinct()
    if not maps:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = maps[-1].select("node", F.col("parent").alias("root"))
    for parents in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("parent"), "root")
        roots = parents.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return roots
