"""Row images: a tuple and its column list become one JSON object.

Everything here is a ``Column`` expression, so images are built by Spark's own
functions and NUMERIC digits never pass through a floating-point value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A handler takes the cell text and returns a JSON literal, or null for texts it
#: cannot render, which are then quoted.
Handler = Callable[[Column], Column]

# Source type ids with a handler of their own.
INTEGER_OIDS = (20, 21, 23)
FLOAT_OIDS = (700, 701)
NUMERIC_OID = 1700
BOOLEAN_OID = 16

# Texts of the markers and of the booleans.
TOAST_TEXT = "<TOAST>"
TRUE_TEXTS = ("t", "true", "1")
FALSE_TEXTS = ("f", "false", "0")

# Accepted number forms.
JSON_NUMBER = r"\A-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?\z"
DECIMAL_FLOAT = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
SIGNED_DIGITS = r"\A[+-]?[0-9]+\z"
# Characters a JSON string must escape, and the usual escapes.
NEEDS_ESCAPE = r'["\\\x00-\x1f]'
OTHER_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r"))


def quoted(text: Column) -> Column:
    """JSON string literal of a text."""
    usual = text
    for plain, escape in ESCAPES:
        usual = F.replace(usual, F.lit(plain), F.lit(escape))
    # Rare control characters take the general but slower way through an array,
    # whose content is always quoted: trimming brackets cannot touch the text.
    rare = F.btrim(F.to_json(F.array(text)), F.lit("[]"))
    quote = F.lit('"')
    return (
        F.when(~text.rlike(NEEDS_ESCAPE), F.concat(quote, text, quote))
        .when(text.rlike(OTHER_CONTROLS), rare)
        .otherwise(F.concat(quote, usual, quote))
    )


def integer_literal(text: Column) -> Column:
    """A bigint rendered again, so that ``+5`` and ``007`` are valid."""
    return F.when(text.rlike(SIGNED_DIGITS), text.try_cast("bigint").cast("string"))


def float_literal(text: Column) -> Column:
    """A finite number; NaN and the infinities are strings."""
    value = text.try_cast("double")
    number = F.when(text.rlike(JSON_NUMBER), text).when(text.rlike(DECIMAL_FLOAT), value.cast("string"))
    return F.when(F.abs(value) < F.lit(float("inf")), number)


def numeric_literal(text: Column) -> Column:
    """The digits exactly as sent."""
    return F.when(text.rlike(JSON_NUMBER), text)


def boolean_literal(text: Column) -> Column:
    return F.when(text.isin(*TRUE_TEXTS), "true").when(text.isin(*FALSE_TEXTS), "false")


@dataclass(frozen=True)
class TypeRegistry:
    """Which handler renders the text of which source type."""

    handlers: Mapping[int, Handler] = field(default_factory=dict)

    def with_handler(self, type_oid: int, handler: Handler) -> TypeRegistry:
        """A registry that also knows ``type_oid`` (replacing any earlier handler)."""
        return TypeRegistry({**self.handlers, type_oid: handler})

    def literal(self, type_oid: Column, text: Column) -> Column:
        """JSON literal of a text cell: its handler's, else the text as a string."""
        by_handler: dict[Handler, list[int]] = {}
        for oid, handler in self.handlers.items():
            by_handler.setdefault(handler, []).append(oid)
        handled = F.lit(None).cast("string")
        for handler, oids in by_handler.items():
            handled = F.when(type_oid.isin(*oids), handler(text)).otherwise(handled)
        return F.coalesce(handled, quoted(text))


DEFAULT_TYPES = TypeRegistry(
    {
        **dict.fromkeys(INTEGER_OIDS, integer_literal),
        **dict.fromkeys(FLOAT_OIDS, float_literal),
        NUMERIC_OID: numeric_literal,
        BOOLEAN_OID: boolean_literal,
    }
)


def layout(columns: Column) -> Column:
    """What a column list contributes to every image, prepared once per relation.

    Entries are sorted by column name, with the cell position, the JSON key
    (quoted, with its colon) and the type, so that no row sorts or quotes keys.
    """
    entries = F.transform(
        F.coalesce(columns, F.array().cast("array<struct<name:string,type_oid:bigint>>")),
        lambda column, at: F.struct(
            column["name"].alias("name"),
            at.alias("at"),
            F.concat(quoted(column["name"]), F.lit(":")).alias("key"),
            column["type_oid"].alias("type_oid"),
        ),
    )
    return F.transform(
        F.array_sort(entries),
        lambda e: F.struct(e["at"].alias("at"), e["key"].alias("key"), e["type_oid"].alias("type_oid")),
    )


def image(
    relation_layout: Column,
    cells: Column,
    registry: TypeRegistry = DEFAULT_TYPES,
    key_only: Column | bool = False,
) -> Column:
    """JSON object of a tuple; ``{}`` if there is no tuple or no column list.

    Cells past the column list have no name and are left out, as are cells of an
    unknown kind.  ``key_only`` also leaves out null cells.
    """
    key_only = key_only if isinstance(key_only, Column) else F.lit(key_only)

    def member(entry: Column) -> Column:
        cell = F.get(cells, entry["at"])
        kind = cell["kind"]
        value = (
            F.when(kind == "t", registry.literal(entry["type_oid"], F.coalesce(cell["text"], F.lit(""))))
            .when((kind == "n") & ~key_only, F.lit("null"))
            .when(kind == "u", F.lit(f'"{TOAST_TEXT}"'))
            .when(kind == "b", F.concat(F.lit('"binary('), F.coalesce(cell["n_bytes"], F.lit(0)), F.lit(' bytes)"')))
        )
        return F.concat(entry["key"], value)

    # A member without a value is null, and array_join skips nulls.
    members = F.array_join(F.transform(relation_layout, member), ",")
    return F.concat(F.lit("{"), F.coalesce(members, F.lit("")), F.lit("}"))
