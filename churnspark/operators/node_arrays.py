"""Values of tree nodes as constant arrays, read by position.

Node ids of a model are consecutive, so a batch of trees needs no map: each model
has a range of slots in one array a value. A lookup costs the same at 31 nodes
and at 10,000, where a literal map is searched from its front. The arrays are
constants that the optimizer folds once; generated code refers to them, so plans
of later levels reuse it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Model ids may leave so many gaps in an array before a map holds them.
GAPS = 1024


def constant_array(values: list, kind: str) -> Column:
    """A constant ``array<kind>`` of numbers, booleans or nulls; one expression, however long the list."""
    def shown(v: object) -> str:
        return "" if v is None else repr(float(v)) if kind == "double" else str(v)
    return F.split(F.lit(",".join(map(shown, values))), ",").try_cast(f"array<{kind}>")


def by_model(values: dict[int, object], kind: str, model: Column) -> Column:
    """The model's value, null for a model without one."""
    if not values:
        return F.lit(None).cast(kind)
    low, high = min(values), max(values)
    if high - low < len(values) + GAPS:
        dense = constant_array([values.get(m) for m in range(low, high + 1)], kind)
        return F.when(model.between(low, high), F.get(dense, model - low))
    keys = constant_array(list(values), "bigint")
    return F.element_at(F.map_from_arrays(keys, constant_array(list(values.values()), kind)), model.cast("bigint"))


class NodeArrays:
    """Slots for the node ids of each model, from its smallest to its largest in ``keys``."""

    def __init__(self, keys: Iterable[tuple[int, int]]):
        self.ends: dict[int, tuple[int, int]] = {}
        for m, n in keys:
            low, high = self.ends.get(m, (n, n))
            self.ends[m] = min(low, n), max(high, n)
        self.start, self.size = {}, 0
        for m, (low, high) in sorted(self.ends.items()):
            self.start[m] = self.size - low
            self.size += high - low + 1

    def offset(self, model: Column) -> Column:
        """What turns the model's node ids into slots."""
        return by_model(self.start, "bigint", model)

    def slot(self, model: Column, node: Column) -> Column:
        """The node's slot, null for a model or a node out of range."""
        low = by_model({m: e[0] for m, e in self.ends.items()}, "bigint", model)
        high = by_model({m: e[1] for m, e in self.ends.items()}, "bigint", model)
        return F.when(node.between(low, high), self.offset(model) + node)

    def array(self, values: dict[tuple[int, int], object], kind: str) -> Column:
        dense: list = [None] * self.size
        for (m, n), v in values.items():
            dense[self.start[m] + n] = v
        return constant_array(dense, kind)

    def value(self, values: dict[tuple[int, int], object], kind: str, model: Column, node: Column) -> Column:
        """The value of (model, node), null where there is none."""
        return F.get(self.array(values, kind), self.slot(model, node))


class Routes:
    """Steps of rows from node to child through the splits ``(model, node) -> (feature, threshold, left child)``."""

    def __init__(self, splits: dict[tuple[int, int], tuple[int, float, int]]):
        children = [(m, left + side) for (m, _), (_, _, left) in splits.items() for side in (0, 1)]
        self.nodes = NodeArrays([*splits, *children])
        self.features = self.nodes.array({k: v[0] for k, v in splits.items()}, "int")
        self.thresholds = self.nodes.array({k: v[1] for k, v in splits.items()}, "double")
        self.lefts = self.nodes.array({k: self.nodes.start[k[0]] + v[2] for k, v in splits.items()}, "bigint")

    def root(self, model: Column) -> Column:
        """The slot of node 1, null for a model without splits."""
        return self.nodes.offset(model) + 1

    def child(self, slot: Column, x: Column) -> Column:
        """The slot of the child that a row goes to; the same slot at a leaf."""
        right = (F.get(x, F.get(self.features, slot)) > F.get(self.thresholds, slot)).cast("bigint")
        return F.coalesce(F.get(self.lefts, slot) + right, slot)

    def node(self, slot: Column, model: Column) -> Column:
        return F.coalesce(slot - self.nodes.offset(model), F.lit(1).cast("bigint"))
