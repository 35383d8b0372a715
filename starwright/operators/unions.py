"""Union of many DataFrames as a balanced tree.

Each ``union`` call analyses the plan built so far, so a left-deep chain of n
unions costs O(n²) analysis work on the driver; pairing them up keeps it at
O(n log n).  Catalyst flattens the nested unions into one ``Union`` node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame], by_name: bool = True) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    level = list(frames)
    while len(level) > 1:
        nxt = []
        for i in range(0, len(level) - 1, 2):
            a, b = level[i], level[i + 1]
            nxt.append(a.unionByName(b) if by_name else a.union(b))
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]
