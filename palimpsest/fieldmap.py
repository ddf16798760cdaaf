"""Declared columns: one field map drives shredding, width checks, change tests, cascades and re-projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Field:
    """A column, the JSON path that fills it, its Spark type and, for text, the most characters it may have."""

    column: str
    path: str
    type: str = "string"
    width: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Collection:
    """A child table: the array that fills it, the columns of an element (paths from the element), and its own collections.

    ``ordinal`` is the column of an element's zero-based place. The path of a field of a bare array is ``$``.
    """

    name: str
    path: str
    fields: tuple[Field, ...] = ()
    children: tuple[Collection, ...] = ()
    ordinal: str = "pos"

    @property
    def payload(self) -> list[str]:
        return [f.column for f in self.fields]


@dataclass(frozen=True)
class FieldMap:
    """The columns of a record table, its natural key, and the tree of its child collections."""

    keys: tuple[str, ...]
    fields: tuple[Field, ...]
    collections: tuple[Collection, ...] = ()
    name: str = "record"

    @property
    def payload(self) -> list[str]:
        return [f.column for f in self.fields if f.column not in self.keys]

    @property
    def widths(self) -> dict[str, int]:
        return {f.column: f.width for f in self.fields if f.width}

    def wide(self) -> FieldMap:
        """The map of the columns that have a width, and the key; a collection that has none, nor any below it, is left out."""

        def kept(found: tuple[Collection, ...]) -> tuple[Collection, ...]:
            own = (replace(c, fields=tuple(f for f in c.fields if f.width), children=kept(c.children)) for c in found)
            return tuple(c for c in own if c.fields or c.children)

        return replace(self, fields=tuple(f for f in self.fields if f.width or f.column in self.keys), collections=kept(self.collections))

    def walk(self) -> Iterator[tuple[Collection, Collection | None, list[str]]]:
        """Every collection with the one above it (None: the record) and the key of its rows, parents first."""

        def below(found: tuple[Collection, ...], above: Collection | None, keys: list[str]) -> Iterator[tuple[Collection, Collection | None, list[str]]]:
            for c in found:
                own = [*keys, c.ordinal]
                yield c, above, own
                yield from below(c.children, c, own)

        yield from below(self.collections, None, list(self.keys))
