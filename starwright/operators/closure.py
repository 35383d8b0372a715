"""Lineage closure (L-1): what is reachable from the sources of many graphs at once.

A run's manifest is a graph of its own, and runs mostly share a few of them.
``graph_of_run`` names a graph by its content, so each distinct one is labelled
once: its nodes are taken in topological order and every node's label is the union
of its parents' labels, bit sets of the sources above it.  One grouping labels all
graphs, whatever their depth; a graph is one project's manifest, which arrived as
one document, so a group is as small as that.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def graph_of_run(nodes: DataFrame, run_col: str = "orchestrator_run_id") -> DataFrame:
    """(``run_col``, ``graph``): the same ``graph`` for runs whose nodes agree in all
    other columns, whatever the rows' order."""
    content = F.sort_array(F.collect_set(F.struct(
        *sorted(c for c in nodes.columns if c != run_col))))
    return nodes.groupBy(run_col).agg(F.sha2(F.to_json(content), 256).alias("graph"))


def labels(parents: dict[str, set[str]], roots: set[str]) -> dict[str, int]:
    """Each node's bit set of the roots above it (its own included), bit i for the
    i-th root in order.  Parents that are no nodes are ignored."""
    bit = {root: 1 << i for i, root in enumerate(sorted(roots))}
    label = {node: bit.get(node, 0) for node in parents}
    children: dict[str, list[str]] = {node: [] for node in parents}
    missing = {}
    for node, above in parents.items():
        known = [p for p in above if p in parents]
        missing[node] = len(known)
        for p in known:
            children[p].append(node)
    ready = deque(node for node, n in missing.items() if n == 0)
    while ready:
        node = ready.popleft()
        for child in children[node]:
            label[child] |= label[node]
            missing[child] -= 1
            if missing[child] == 0:
                ready.append(child)
    # what is left lies on cycles or below them: labels go round until they stay
    left = deque(node for node, n in missing.items() if n > 0)
    while left:
        node = left.popleft()
        for child in children[node]:
            if label[child] | label[node] != label[child]:
                label[child] |= label[node]
                left.append(child)
    return label


def reachable(nodes: DataFrame) -> DataFrame:
    """``nodes(graph, node, is_root, depends_on)`` → ``(graph, root, node)`` for every
    node reachable from a root of its graph, the root itself included, each once.

    A null ``depends_on`` is an empty one, a repeated node has all its rows'
    parents, and a cycle is reached as a whole; no rows give no rows."""
    def one(graph: pd.DataFrame) -> pd.DataFrame:
        parents: dict[str, set[str]] = {}
        for node, above in zip(graph["node"], graph["depends_on"], strict=True):
            parents.setdefault(node, set()).update(() if above is None else above)
        roots = sorted(set(graph.loc[graph["is_root"], "node"]))
        found = [(roots[i], node) for node, bits in labels(parents, set(roots)).items()
                 for i in range(len(roots)) if bits >> i & 1]
        return pd.DataFrame({"graph": graph["graph"].iloc[0], "root": [r for r, _ in found],
                             "node": [n for _, n in found]})

    return (nodes.select("graph", "node", "is_root", "depends_on")
            .groupBy("graph").applyInPandas(one, "graph string, root string, node string"))


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``edges(parent, child)``, ``roots(root)`` of one graph → ``(root, node)``."""
    parents = edges.groupBy("child").agg(F.collect_set("parent").alias("above"))
    ends = (edges.select(F.col("child").alias("node"))
            .union(edges.select("parent")).union(roots.select("root")).distinct())
    nodes = (ends.join(parents, ends.node == parents.child, "left")
             .join(roots.select("root").distinct(), F.col("node") == F.col("root"), "left")
             .select(F.lit("").alias("graph"), "node", F.col("root").isNotNull().alias("is_root"),
                     F.col("above").alias("depends_on")))
    return reachable(nodes).select("root", "node")
