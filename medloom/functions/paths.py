"""Element access on parsed resources. A node is a Column plus its type; every step returns a new node.

All steps are built-in Column expressions, so a view compiles to one projection with no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _key_of(reference: Column, resource: str | None) -> Column:
    path = F.substring_index(F.replace(reference, F.lit("//"), F.lit("")), "/_history", 1)
    key = F.substring_index(path, "/", -1)
    is_urn = reference.startswith("urn:")
    if resource is None:
        key = F.when(is_urn, F.substring_index(reference, ":", -1)).otherwise(key)
    else:
        same = F.substring_index(F.substring_index(path, "/", -2), "/", 1) == resource
        key = F.when(~is_urn & path.contains("/") & same, key)
    return F.when(reference != "", key)


@dataclass(frozen=True)
class Node:
    col: Column
    dtype: T.DataType

    @property
    def is_list(self) -> bool:
        return isinstance(self.dtype, T.ArrayType)

    def get(self, path: str) -> Node:
        """Member access; goes through lists, dropping absent members and flattening nested lists."""
        node = self
        for name in path.split("."):
            node = node._member(name)
        return node

    def _member(self, name: str) -> Node:
        struct = self.dtype.elementType if self.is_list else self.dtype
        if not isinstance(struct, T.StructType) or name not in struct.names:
            raise KeyError(f"no element '{name}' in the schema")
        inner = struct[name].dataType
        value = self.col.getField(name)
        if not self.is_list:
            return Node(value, inner)
        value = F.filter(value, lambda x: x.isNotNull())
        if isinstance(inner, T.ArrayType):
            return Node(F.flatten(value), inner)
        return Node(value, T.ArrayType(inner))

    def choice(self, base: str, kind: str) -> Node:
        """A value[x] element in the given type: ('onset', 'dateTime') reads onsetDateTime."""
        return self.get(base + kind[0].upper() + kind[1:])

    def at(self, index: int) -> Node:
        if not self.is_list:
            return self if index == 0 else Node(F.lit(None).cast(self.dtype), self.dtype)
        return Node(F.get(self.col, F.lit(index)), self.dtype.elementType)

    def first(self) -> Node:
        return self.at(0)

    def keep(self, test: Callable[[Node], Column]) -> Node:
        """Elements for which the test holds; an undefined test counts as false."""
        if not self.is_list:
            return Node(F.when(test(self), self.col), self.dtype)
        element = self.dtype.elementType
        return Node(F.filter(self.col, lambda x: F.coalesce(test(Node(x, element)), F.lit(False))), self.dtype)

    def where(self, name: str, value: str) -> Node:
        return self.keep(lambda n: n.get(name).col == value)

    def where_prefix(self, name: str, prefix: str) -> Node:
        return self.keep(lambda n: n.get(name).col.startswith(prefix))

    def extension(self, url: str) -> Node:
        return self.get("extension").where("url", url)

    def extension_named(self, suffix: str) -> Node:
        """An extension by the last part of its url, whoever publishes it."""
        return self.get("extension").keep(lambda n: n.get("url").col.endswith(suffix))

    def union(self, other: Node) -> Node:
        """Both lists without duplicates; an absent list counts as empty."""
        left = F.coalesce(self.col, F.array().cast(self.dtype))
        right = F.coalesce(other.col.cast(self.dtype), F.array().cast(self.dtype))
        return Node(F.array_union(left, right), self.dtype)

    def join(self, separator: str) -> Node:
        return Node(F.when(F.size(self.col) > 0, F.array_join(self.col, separator)), T.StringType())

    def equals(self, value) -> Node:
        return Node(self.col == value, T.BooleanType())

    def single(self) -> Node:
        """The only value of a list. Two values are an error, not a silent pick."""
        if not self.is_list:
            return self
        many = F.raise_error(F.lit("more than one value where one is expected")).cast(self.dtype.elementType)
        return Node(F.when(F.size(self.col) > 1, many).otherwise(F.get(self.col, F.lit(0))), self.dtype.elementType)

    def reference_key(self, resource: str | None = None) -> Node:
        """Logical id behind a reference; with ``resource``, only when the reference is of that type."""
        ref = self.get("reference")
        if not ref.is_list:
            return Node(_key_of(ref.col, resource), T.StringType())
        keys = F.transform(ref.col, lambda x: _key_of(x, resource))
        return Node(F.filter(keys, lambda x: x.isNotNull()), T.ArrayType(T.StringType()))

    def lookup(self, system: str) -> Node:
        """First code of the given system in a CodeableConcept."""
        return self.get("coding").where("system", system).get("code").first()
