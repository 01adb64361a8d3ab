"""A small forest and a small kernel machine of stated values.

Queries score with them, so that another engine can compute the same scores from the same numbers.
"""

from __future__ import annotations

import pandas as pd

from acctpulse import schema
from acctpulse.models.forest import ForestModel
from acctpulse.models.ocsvm import OcsvmModel

#: Rows below a leaf, or (feature, threshold, part up to it, part above it).
Tree = int | tuple

SAMPLES = 64
TREES: list[Tree] = [
    (
        "amount_zscore_account", 0.5,
        ("txn_count_30s", 2.0, 40, 12),
        ("cumulative_amount_10min", 400.0, 9, 3),
    ),
    (
        "time_since_last_txn", 30.0,
        ("same_amount_frequency", 3.0, 25, 20),
        ("hour_of_day", 6.0, 4, 15),
    ),
    ("min_time_gap_last_10txn", 1.0, 2, ("descr_encoded", 1.0, 30, 32)),
    (
        "avg_time_gap_last_5txn", 90.0,
        ("duplicate_streak", 1.0, 50, 6),
        ("dc_alternation_count_10txn", 4.0, 7, 1),
    ),
]
#: Feature, centre and width of the kernel machine; its weights, gamma and seed.
SVM_SCALES = [
    ("amount_zscore_account", 0.0, 1.0),
    ("time_since_last_txn", 60.0, 45.0),
    ("cumulative_amount_10min", 500.0, 300.0),
]
SVM_WEIGHTS = [0.5, -0.25, 0.75, 0.1]
SVM_GAMMA, SVM_SEED = 0.3, 11


def rows_of(tree: Tree) -> int:
    return tree if isinstance(tree, int) else rows_of(tree[2]) + rows_of(tree[3])


def forest() -> ForestModel:
    """The trees as a model; its cut-off is not set."""
    nodes: list[tuple] = []

    def add(no: int, tree: Tree, node: int, depth: int) -> None:
        if isinstance(tree, int):
            nodes.append((no, node, -1, 0.0, tree, depth))
            return
        feature, threshold, low, high = tree
        nodes.append((no, node, schema.FEATURE_COLUMNS.index(feature), threshold, rows_of(tree), depth))
        add(no, low, 2 * node + 1, depth + 1)
        add(no, high, 2 * node + 2, depth + 1)

    for no, tree in enumerate(TREES):
        add(no, tree, 0, 0)
    columns = ["tree", "node", "feature", "threshold", "rows", "depth"]
    table = pd.DataFrame(nodes, columns=columns).sort_values(["tree", "node"]).reset_index(drop=True)
    return ForestModel(list(schema.FEATURE_COLUMNS), table, len(TREES), SAMPLES)


def svm() -> OcsvmModel:
    names, centres, widths = zip(*SVM_SCALES, strict=True)
    return OcsvmModel(list(names), list(SVM_WEIGHTS), SVM_GAMMA, list(centres), list(widths), SVM_SEED)
