"""The attribute notation of data-mart and select specs."""

from __future__ import annotations

from dataclasses import dataclass

SEPARATOR = "+"
# Functions of the notation, with the number of arguments before the alias.
FUNCTIONS = {
    "id_esri": 0, "area": 1, "sum_area": 1, "array": 1, "array_length": 1, "sum": 1, "min": 1, "min_init_cap": 1,
    "hex_id": 1, "hex_id_parent": 1, "hex_id_children": 0, "geom": 2, "geom_parent": 2, "geom_children": 0, "date": 2,
    "sum_area_adaptatif": None,
}
FIXED_ALIAS = {"id_esri": "id_esri", "hex_id": "hex_id", "hex_id_parent": "hex_id", "hex_id_children": "hex_id",
               "geom": "geometry", "geom_parent": "geometry", "geom_children": "geometry"}
AGGREGATES = {"sum_area", "sum_area_adaptatif", "array", "array_length", "sum", "min", "min_init_cap"}


@dataclass(frozen=True)
class Attr:
    """One output attribute: a plain column or ``fn`` of ``args``, optionally grouped (!) or ordered (?) by."""

    alias: str
    column: str | None = None
    fn: str | None = None
    args: tuple[str, ...] = ()
    group: bool = False
    order: bool = False

    @property
    def aggregate(self) -> bool:
        return self.fn in AGGREGATES

    @staticmethod
    def of(text: Attr | str) -> Attr:
        """``"!objectid"``, ``"nom AS commune"``, ``"!date+begdate+year+annee"``, ``"sum+pop+total"``."""
        if isinstance(text, Attr):
            return text
        marks, body = text[:2], text.lstrip("!?")
        group, order = "!" in marks, "?" in marks
        if SEPARATOR not in body:
            column, _, alias = (part.strip() for part in body.partition(" AS "))
            return Attr(alias or column, column=column, group=group, order=order)
        fn, *args = body.split(SEPARATOR)
        if fn not in FUNCTIONS:
            raise ValueError(f"unknown function {fn!r} in attribute {text!r}")
        if fn in FIXED_ALIAS:
            return Attr(FIXED_ALIAS[fn], fn=fn, args=tuple(a for a in args if a), group=group, order=order)
        return Attr(args[-1], fn=fn, args=tuple(args[:-1]), group=group, order=order)
