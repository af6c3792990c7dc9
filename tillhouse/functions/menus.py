"""Access to recursive menu documents, which only a variant can hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def member(node: Column, path: str, kind: str = "string") -> Column:
    """`$.path` of a variant, null when it is absent or of another kind."""
    return F.try_variant_get(node, f"$.{path}", kind)


def children(node: Column, *names: str) -> Column:
    """The first of the named lists that has elements."""
    lists = F.array(*[member(node, name, "array<variant>") for name in names])
    # Taking a list out of a variant copies everything below it, so each is mentioned once.
    return F.get(F.filter(lists, lambda items: F.size(items) > 0), F.lit(0))


def list_or_text(node: Column, path: str) -> Column:
    """A list becomes comma-separated text, a scalar its text; empty becomes null."""
    # A null inside the list prints as the text "None".
    joined = F.array_join(member(node, path, "array<string>"), ",", "None")
    text = F.when(member(node, path, "array<variant>").isNotNull(), joined).otherwise(member(node, path))
    return F.nullif(text, F.lit(""))
