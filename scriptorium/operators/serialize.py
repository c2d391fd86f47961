"""Nested records as XML, JSON, YAML or lists of name and value, from one description of their parts.

A part is a ``Field`` with a value, a ``Group`` of parts, or ``Many`` of an array's items. Names, order and attributes are the
description's; the values are Columns, so every format is one expression over a row, whatever its nesting. Null
fields, empty arrays and groups whose condition fails are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    value: Column
    attrs: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Group:
    name: str
    parts: list
    attrs: dict = field(default_factory=dict)
    when: Column | None = None


@dataclass(frozen=True)
class Many:
    """``make`` has the parts of an item, or its value; attributes may be functions of the item."""

    name: str
    items: Column
    make: Callable[[Column], list | Column]
    attrs: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Written:
    """XML that is there already; other formats have no use for it."""

    text: Column


Part = Field | Group | Many | Written


_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value)


def _escaped(value, quotes: bool = False) -> Column:
    """Text for the content of an element, or for an attribute; constants are escaped here and now."""
    for a, b in (*_ESCAPES, ('"', "&quot;"))[: 4 if quotes else 3]:
        value = F.replace(_text(value), F.lit(a), F.lit(b)) if isinstance(value, Column) else value.replace(a, b)
    return _text(value)


def _element(name: str, attrs: dict, body: Column, item: Column | None = None) -> Column:
    """Attributes that are null are left out."""
    given = {k: _escaped(v(item) if callable(v) and not isinstance(v, Column) else v, quotes=True) for k, v in attrs.items()}
    marks = [F.coalesce(F.concat(F.lit(f' {k}="'), v, F.lit('"')), F.lit("")) for k, v in given.items()]
    return F.concat(F.lit(f"<{name}"), *marks, F.lit(">"), body, F.lit(f"</{name}>"))


def xml(part: Part) -> Column:
    """The part as XML, without white space between elements; null if there is nothing to say."""
    if isinstance(part, Written):
        return part.text
    if isinstance(part, Field):
        return F.when(part.value.isNotNull(), _element(part.name, part.attrs, _escaped(part.value)))
    if isinstance(part, Group):
        whole = _element(part.name, part.attrs, F.concat_ws("", *map(xml, part.parts)))
        return F.when(part.when, whole) if part.when is not None else whole

    def one(x: Column) -> Column:
        made = part.make(x)
        return _element(part.name, part.attrs, F.concat_ws("", *map(xml, made)) if isinstance(made, list) else _escaped(made), x)

    return F.when(F.size(part.items) > 0, F.array_join(F.transform(part.items, one), ""))


def value_of(part: Part) -> Column:
    """The part as a value for to_json; attributes have no place there."""
    if isinstance(part, Field):
        return part.value
    if isinstance(part, Group):
        whole = struct_of(part.parts)
        return F.when(part.when, whole) if part.when is not None else whole

    def one(x: Column) -> Column:
        made = part.make(x)
        return struct_of(made) if isinstance(made, list) else made

    return F.when(F.size(part.items) > 0, F.transform(part.items, one))


def struct_of(parts: list[Part]) -> Column:
    return F.struct(*[value_of(p).alias(p.name) for p in parts])


def json(parts: list[Part]) -> Column:
    """The parts as a JSON object on one line."""
    return F.to_json(struct_of(parts))


def _scalar(c: Column) -> Column:
    """A value in JSON's spelling, which YAML reads as the same."""
    written = F.to_json(F.array(c))
    return F.substring(written, 2, 2147483647).substr(F.lit(1), F.length(written) - 2)


def yaml_lines(parts: list[Part]) -> Column:
    """The parts as an array of YAML lines."""
    indented = lambda lines, by: F.transform(lines, lambda x: F.concat(F.lit(by), x))

    def lines(part: Part) -> Column:
        if isinstance(part, Field):
            return F.when(part.value.isNotNull(), F.array(F.concat(F.lit(f"{part.name}: "), _scalar(part.value))))
        if isinstance(part, Group):
            whole = F.concat(F.array(F.lit(f"{part.name}:")), indented(yaml_lines(part.parts), "  "))
            return F.when(part.when, whole) if part.when is not None else whole

        def one(x: Column) -> Column:
            made = part.make(x)
            if not isinstance(made, list):
                return F.array(F.concat(F.lit("- "), _scalar(made)))
            return F.transform(yaml_lines(made), lambda line, i: F.concat(F.when(i == 0, "- ").otherwise("  "), line))

        return F.when(F.size(part.items) > 0, F.concat(F.array(F.lit(f"{part.name}:")), indented(F.flatten(F.transform(part.items, one)), "  ")))

    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(lines(p), empty) for p in parts])


def yaml(parts: list[Part]) -> Column:
    return F.array_join(yaml_lines(parts), "\n")


def pairs(parts: list[Part]) -> Column:
    """Structs (name, value) of all fields in order; those of a group and of an item have its place."""
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), _text(value).alias("value"))
    none = F.array().cast("array<struct<name:string,value:string>>")

    def found(part: Part) -> Column:
        if isinstance(part, Field):
            return F.when(part.value.isNotNull(), F.array(pair(part.name, part.value)))
        if isinstance(part, Group):
            return F.when(part.when, pairs(part.parts)) if part.when is not None else pairs(part.parts)

        def one(x: Column) -> Column:
            made = part.make(x)
            return pairs(made) if isinstance(made, list) else F.array(pair(part.name, made))

        return F.flatten(F.transform(part.items, one))

    return F.concat(*[F.coalesce(found(p), none) for p in parts])


def joined(parts: list[Part], form: Callable[[Column, Column], Column], by: str) -> Column:
    """All fields, each written by form(name, value), with ``by`` between."""
    return F.array_join(F.transform(pairs(parts), lambda p: form(p["name"], p["value"])), by)


def joined_rows(df: DataFrame, key: str, text: str, run: int = 1000) -> DataFrame:
    """(key, text): the texts of each key end to end, in the order of the rows; rows of a key must follow each other in one partition.

    A text of hundreds of megabytes would be held by Spark as its pieces, as a whole and in a row at once. Here it grows in one buffer, by ``run`` pieces at a time.
    """

    def join(batches):
        at, buffer, begun, pieces = None, bytearray(), False, []

        def add():
            nonlocal buffer
            buffer += b"".join(pieces)
            pieces.clear()

        def whole():
            offsets = pa.array([0, len(buffer)], pa.int32()).buffers()[1]
            return pa.RecordBatch.from_arrays([pa.array([at], kind), pa.StringArray.from_buffers(1, offsets, pa.py_buffer(buffer))], names=[key, text])

        for batch in batches:
            kind, keys = batch.schema.field(0).type, batch.column(0).to_pylist()
            for k, piece in zip(keys, batch.column(1)):
                if begun and k != at:
                    add()
                    yield whole()
                    buffer = bytearray()
                at, begun = k, True
                if piece.is_valid:
                    pieces.append(piece.as_buffer())
                if len(pieces) >= run:
                    add()
        if begun:
            add()
            yield whole()

    kinds = dict(df.dtypes)
    return df.select(key, text).mapInArrow(join, f"`{key}` {kinds[key]}, `{text}` string")
