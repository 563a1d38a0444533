"""right-closed binning with the lowest edge included (pandas ``cut`` rules).

``(e0, e1] -> l0, (e1, e2] -> l1, ...`` and ``e0`` itself falls in the first bin;
values outside ``[e0, e_last]`` (and nulls) become null.  ``ml.Bucketizer`` is
left-closed, so it is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_right_closed(col: Column | str, edges, labels) -> Column:
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(labels) == len(edges) - 1")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (c >= F.lit(lo)) & (c <= F.lit(hi)) if i == 0 else (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_sql(col: str, edges, labels) -> str:
    """The same binning as a SQL CASE expression (for oracles and SQL users)."""
    parts = []
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lit = f"'{label}'" if isinstance(label, str) else str(label)
        op = ">=" if i == 0 else ">"
        parts.append(f"WHEN {col} {op} {lo} AND {col} <= {hi} THEN {lit}")
    return "CASE " + " ".join(parts) + " END"


# Player-table bins (edges, labels) used by the reference's demos.
PLAYER_BINS = {
    "Age": ([0, 22, 28, 35, 50], ["Young", "Prime", "Experienced", "Veteran"]),
    "Potential": ([0, 75, 85, 90, 100], ["Low", "Medium", "High", "Elite"]),
    "Wage_Numeric": ([-1, 30000, 80000, 150000, 1000000], ["Low", "Medium", "High", "Elite"]),
    "Overall": ([0, 70, 80, 85, 100], ["Low", "Medium", "High", "Elite"]),
}
