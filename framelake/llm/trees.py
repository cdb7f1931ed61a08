"""Trained Spark ML trees as conditions and column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cond:
    """``feature <= threshold`` (or ``>``)."""

    feature: str
    below: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c <= F.lit(self.threshold) if self.below else c > F.lit(self.threshold)


def _children(node):
    return None if node.subtreeDepth() == 0 else (node.leftChild(), node.rightChild())


def paths(tree_model, features: list[str]) -> list[tuple[Cond, ...]]:
    """Every path from the root to an inner node or leaf, as a tuple of conditions."""
    out: list[tuple[Cond, ...]] = []

    def walk(node, path: tuple[Cond, ...]) -> None:
        if path:
            out.append(path)
        if (kids := _children(node)) is not None:
            name, at = features[node.split().featureIndex()], float(node.split().threshold())
            walk(kids[0], (*path, Cond(name, True, at)))
            walk(kids[1], (*path, Cond(name, False, at)))

    walk(tree_model._call_java("rootNode"), ())
    return out


def tree_column(tree_model, features: list[str]) -> Column:
    """A regression tree as nested CASE expressions over its feature columns."""

    def build(node) -> Column:
        if (kids := _children(node)) is None:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.col(features[split.featureIndex()]) <= F.lit(float(split.threshold())), build(kids[0])).otherwise(build(kids[1]))

    return build(tree_model._call_java("rootNode"))


def all_of(conds: tuple[Cond, ...]) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in conds])
