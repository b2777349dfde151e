"""Flatten nested resources into rows. A view is declared once and compiles to one projection.

Elements of one resource multiply within its own row (``explode``), so no view needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.functions.paths import Node
from medloom.session import written
from medloom.schema import fhir

# Declared column types that are not text.
_TYPES: dict[str, T.DataType] = {
    "decimal": T.DecimalType(38, 10),
    "double": T.DecimalType(38, 10),
    "number": T.DecimalType(38, 10),
    "integer": T.IntegerType(),
    "positiveInt": T.IntegerType(),
    "unsignedInt": T.IntegerType(),
    "boolean": T.BooleanType(),
}

Path = Callable[[Node], Node]


@dataclass(frozen=True)
class Col:
    name: str
    path: Path
    type: str = "string"
    collection: bool = False

    def value(self, node: Node) -> Column:
        found = self.path(node)
        if self.collection:
            return found.col if found.is_list else F.array(found.col)
        target = _TYPES.get(self.type, T.StringType())
        value = found.single()
        return value.col if value.dtype == target else value.col.try_cast(target)


@dataclass(frozen=True)
class Columns:
    cols: tuple[Col, ...]


@dataclass(frozen=True)
class ForEach:
    path: Path
    select: tuple
    or_null: bool = False


@dataclass(frozen=True)
class UnionAll:
    branches: tuple


@dataclass(frozen=True)
class Repeat:
    """Descend along ``path`` from each found node, as deep as the typed schema goes; :func:`descend` has no such limit."""

    path: Path
    select: tuple


@dataclass(frozen=True)
class View:
    name: str
    resource: str
    select: tuple
    where: tuple[Path, ...] = field(default=())


def column_names(part) -> list[str]:
    """Names in declaration order. Union branches must agree on them."""
    if isinstance(part, Columns):
        return [c.name for c in part.cols]
    if isinstance(part, UnionAll):
        lists = [column_names(b) for b in part.branches]
        if any(names != lists[0] for names in lists):
            raise ValueError(f"union branches differ in their columns: {lists}")
        return lists[0]
    return [n for p in part.select for n in column_names(p)]


def _rows(part, node: Node) -> Column:
    """The rows of one part as an array of structs."""
    if isinstance(part, Columns):
        return F.array(F.struct(*[c.value(node).alias(c.name) for c in part.cols]))
    if isinstance(part, UnionAll):
        column_names(part)
        return F.concat(*[_rows(b, node) for b in part.branches])
    if isinstance(part, ForEach):
        found = part.path(node)
        items = found.col if found.is_list else F.filter(F.array(found.col), lambda x: x.isNotNull())
        element = found.dtype.elementType if found.is_list else found.dtype
        items = F.coalesce(items, F.array().cast(T.ArrayType(element)))
        if part.or_null:
            empty = F.array(F.lit(None).cast(element))
            items = F.when(F.size(items) == 0, empty).otherwise(items)
        return F.flatten(F.transform(items, lambda x: _product(part.select, Node(x, element))))
    if isinstance(part, Repeat):
        return _descend(part, node)
    raise TypeError(f"not a view part: {part!r}")


def _descend(part: Repeat, node: Node) -> Column | None:
    try:
        found = part.path(node)
    except KeyError:  # the schema goes no deeper
        return None
    if not found.is_list:
        found = Node(F.filter(F.array(found.col), lambda x: x.isNotNull()), T.ArrayType(found.dtype))
    element = found.dtype.elementType

    def one(x: Column) -> Column:
        here = _product(part.select, Node(x, element))
        below = _descend(part, Node(x, element))
        return here if below is None else F.concat(here, below)

    return F.flatten(F.transform(F.coalesce(found.col, F.array().cast(found.dtype)), one))


def _product(parts: Sequence, node: Node) -> Column:
    rows, names = _rows(parts[0], node), column_names(parts[0])
    for part in parts[1:]:
        right = column_names(part)
        rows = F.flatten(F.transform(rows, _pairing(part, node, tuple(names), tuple(right))))
        names = names + right
    return rows


def _pairing(part, node: Node, left: tuple, right: tuple) -> Callable[[Column], Column]:
    def one(a: Column) -> Column:
        kept = [a.getField(n).alias(n) for n in left]
        return F.transform(_rows(part, node), lambda b: F.struct(*kept, *[b.getField(n).alias(n) for n in right]))

    return one


def flatten_parsed(df: DataFrame, view: View, root: str, schema: T.DataType) -> DataFrame:
    """Rows of the view over a column of already parsed resources."""
    node = Node(F.col(root), schema)
    for predicate in view.where:
        found = predicate(node).single()
        if not isinstance(found.dtype, T.BooleanType):
            raise TypeError("a where path must be boolean")
        df = df.where(F.coalesce(found.col, F.lit(False)))
    out: list[Column] = []
    for i, part in enumerate(view.select):
        if isinstance(part, Columns):
            out += [c.value(node).alias(c.name) for c in part.cols]
            continue
        slot = f"_part{i}"
        if isinstance(part, ForEach) and all(isinstance(p, Columns) for p in part.select):
            found = part.path(node)
            items = found.col if found.is_list else F.array(found.col)
            if not found.is_list:
                items = F.filter(items, lambda x: x.isNotNull())
            element = found.dtype.elementType if found.is_list else found.dtype
            df = df.withColumn(slot, F.explode_outer(items) if part.or_null else F.explode(items))
            inner = Node(F.col(slot), element)
            out += [c.value(inner).alias(c.name) for p in part.select for c in p.cols]
        else:
            df = df.withColumn(slot, F.explode(_rows(part, node)))
            out += [F.col(slot).getField(n).alias(n) for n in column_names(part)]
    return df.select(*out)


def flatten(resources: DataFrame, view: View) -> DataFrame:
    """Rows of the view over ``(resource_type, id, resource)``; the type filter prunes partitions."""
    schema = fhir.schema(view.resource)
    # The one-element explode keeps later filters above the parser: pushed below it, each would parse again.
    parsed = resources.where(F.col("resource_type") == view.resource).select(
        F.explode(F.array(F.from_json("resource", schema))).alias("_r")
    )
    return flatten_parsed(parsed, view, "_r", schema)


def descend(
    resources: DataFrame, resource_type: str, paths: Sequence[str], columns: dict[str, tuple[str, str]], keep: Sequence[str] = ("id",)
) -> DataFrame:
    """One row per node found by going down ``paths`` again and again, however deep the resources are nested.

    ``paths`` are element names (``item``, ``answer.item``) tried on the resource and then on every node found; lists on the way
    are followed element by element. ``columns`` maps each result column to (element path within the node, SQL type); a value that
    does not fit its type is NULL. Added are ``depth`` (from 1) and ``place``, which sorts the nodes of a resource in document
    order: (index of the path, position) for each level. Resources that are not JSON, NULL or without such elements give no rows.

    Each level is one narrow job over what the level above left, without a shuffle, and is written, so a lost executor costs one
    level only. There are as many jobs as the deepest resource has levels.
    """
    names = [*columns, "depth", "place", *keep]
    if len(set(names)) < len(names):
        raise ValueError(f"column names repeat: {names}")
    level = resources.where(F.col("resource_type") == resource_type).select(
        *keep, F.try_parse_json("resource").alias("_node"), F.array().cast("array<int>").alias("place")
    )
    found: list[DataFrame] = []
    while True:
        below = F.flatten(F.array(*[_children(F.col("_node"), path, i) for i, path in enumerate(paths)]))
        level = level.select(*keep, "place", F.explode(below).alias("_child")).select(
            *keep, F.concat("place", F.col("_child.place")).alias("place"), F.col("_child.node").alias("_node")
        )
        level = written(level)
        if level.isEmpty():
            break
        values = [F.try_variant_get("_node", f"$.{path}", kind).alias(name) for name, (path, kind) in columns.items()]
        found.append(level.select(*keep, *values, F.lit(len(found) + 1).alias("depth"), "place"))
    if not found:
        values = [F.try_variant_get("_node", f"$.{path}", kind).alias(name) for name, (path, kind) in columns.items()]
        return level.select(*keep, *values, F.lit(0).alias("depth"), "place")
    return reduce(DataFrame.unionByName, found)


def _children(node: Column, path: str, index: int) -> Column:
    """The nodes that ``path`` finds below ``node``, with their places."""
    nodes = F.array(node)
    for name in path.split("."):
        nodes = F.flatten(F.transform(nodes, _step(name)))
    return F.transform(nodes, lambda x, i: F.struct(F.array(F.lit(index), i).alias("place"), x.alias("node")))


def _step(name: str) -> Callable[[Column], Column]:
    def one(x: Column) -> Column:
        many = F.try_variant_get(x, f"$.{name}", "array<variant>")
        single = F.try_variant_get(x, f"$.{name}", "variant")
        some = F.filter(F.coalesce(many, F.array(single)), lambda v: v.isNotNull() & ~F.is_variant_null(v))
        return F.coalesce(some, F.array().cast("array<variant>"))

    return one
