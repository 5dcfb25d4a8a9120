"""Reading nested JSON text through VARIANT. All arguments and results are SQL expressions as text,
which keeps wide projections short to write and quick to build."""

from __future__ import annotations

import re
from collections.abc import Iterable


def parsed(text: str) -> str:
    """JSON text as VARIANT; NULL for NULL or malformed text."""
    return f"try_parse_json({text})"


def path_text(variant: str, path: str) -> str:
    """String at a path; a missing path and a JSON null both give NULL."""
    return f"try_variant_get({variant}, '{path}', 'string')"


def path_as(variant: str, path: str, data_type: str) -> str:
    """Typed value at a path. A value that does not convert is an error, as in a plain cast."""
    return f"variant_get({variant}, '{path}', '{data_type}')"


def elements(variant: str, path: str = "$") -> str:
    """Elements of an array, or the member values of an object, as ARRAY<VARIANT>.

    The change logs store a list either as a JSON array or as an object with the keys
    ``_0``, ``_1``, ...; both give the same elements here. NULL when there is no such container.
    """
    return (f"coalesce(try_variant_get({variant}, '{path}', 'array<variant>'), "
            f"map_values(try_variant_get({variant}, '{path}', 'map<string,variant>')))")


def member_count(text: str) -> str:
    """Number of keys of a JSON object; NULL for NULL or non-object text."""
    return f"if(json_object_keys({text}) IS NOT NULL, size(json_object_keys({text})), NULL)"


def records(variant: str, places: Iterable[str], path: str = "$") -> str:
    """Elements as ``elements`` gives them, each a struct of the members at the places: a dotted path below the element,
    with a type behind a blank, or text without one. All are read in one pass; a missing member, a JSON null and a value of
    another type give NULL, as does an element that is no object. Without places, the elements as they are."""
    tree: dict = {}
    for place in places:
        dotted, _, kind = place.partition(" ")
        *outer, last = dotted.split(".")
        inside = tree
        for member in outer:
            inside = inside.setdefault(member, {})
        inside[last] = kind or "string"

    def shape(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return f"struct<{', '.join(f'`{name}`: {shape(below)}' for name, below in node.items())}>"

    element = shape(tree) if tree else "variant"
    return (f"coalesce(try_variant_get({variant}, '{path}', 'array<{element}>'), "
            f"map_values(try_variant_get({variant}, '{path}', 'map<string, {element}>')))")


def places_read(row: str, texts: Iterable[str]) -> set[str]:
    """Dotted paths below `row` that the expressions read."""
    return set(re.findall(rf"\b{re.escape(row)}\.([\w.]+)", " ".join(texts)))
