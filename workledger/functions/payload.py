"""Strict JSON parsing and typed field access on variant values.

Spark's parsers stop after the first JSON value and ignore what follows it. To
notice trailing text the line is also read as the first element of an array
whose second element is the line's own digest: only a line that is exactly one
JSON value leaves the digest in second place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from workledger.functions.text import once

# How a nested value that counts as "nothing there" prints.
_EMPTY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")


# Only what the JSON standard allows.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def document(raw: Column) -> Column:
    """The first JSON value of a line as a variant, or NULL if there is none."""
    return F.from_json(raw, "variant", _STRICT)


def is_single_json(doc: Column, raw: Column) -> Column:
    digest = F.md5(raw)
    second = F.get_json_object(F.concat(F.lit("["), raw, F.lit(',"'), digest, F.lit('"]')), "$[1]")
    return F.coalesce(doc.isNotNull() & (second == digest), F.lit(False))


def is_object_text(raw: Column) -> Column:
    """Whether a line known to be valid JSON holds an object."""
    return F.ltrim(raw, F.lit(" \t\r\n")).startswith("{")


def fields(doc: Column, names: Sequence[str]) -> Column:
    """The named top-level fields as one struct of variants, in one pass."""
    return F.try_variant_get(doc, "$", "struct<" + ", ".join(f"`{name}`: variant" for name in names) + ">")


def member(value: Column, name: str) -> Column:
    """A field of a nested object; NULL if absent or if the value is no object."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def json_type(value: Column) -> Column:
    """Type name of a value: NULL when absent, ``VOID`` for JSON null."""
    return F.schema_of_variant(value)


def texts(raw: Column, schema: str) -> Column:
    """Scalars as text, whatever their JSON type; NULL for absent and null.

    Reads all fields in one pass, which is far cheaper than casting variants to
    strings one by one. Says nothing about types or about text after the value.
    """
    return F.from_json(raw, schema, _STRICT)


def if_string(value: Column, text: Column) -> Column:
    """``text`` where the JSON value is a string, NULL for every other type."""
    return F.when(json_type(value) == "STRING", text)


def is_given(value: Column) -> Column:
    """Present and not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def is_object(value: Column, inner: Column) -> Column:
    """An object; one that has the member ``inner`` need not have its type printed."""
    return inner.isNotNull() | F.coalesce(json_type(value).startswith("OBJECT<"), F.lit(False))


def is_object_or_empty(value: Column, inner: Column) -> Column:
    """An object, absent, or an empty value such as ``0``, ``""`` or ``[]``."""
    is_empty = F.coalesce(F.to_json(value).isin(*_EMPTY_JSON), F.lit(False))
    return value.isNull() | is_object(value, inner) | is_empty


# A line without this holds no number that a variant would not print as it is.
_MAY_HOLD_FLOAT = r"[0-9](?:[.eE]|[0-9]{37})"
_FLOAT = r"^-?[0-9]+[.eE]"
_TOKEN = r"\"[^\"]*+\"|-?[0-9][-+.0-9eE]*+|[^\"\s0-9-]++"


def _spelled(text: Column) -> Column:
    """A JSON text with escaped quotes and back slashes spelled by number, so that a string ends at the next quote."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))


def _tokens(text: Column) -> Column:
    """Strings, numbers, and what is between them, of a JSON text."""
    return F.regexp_extract_all(_spelled(text), F.lit(_TOKEN), F.lit(0))


def _is_number(token: Column) -> Column:
    return token.rlike(r"^-?[0-9]")


def _by_value(raw: Column) -> Column:
    """Compact JSON with sorted keys in which numbers are printed by their value.

    For the sorting every number becomes a string, so that none passes
    through a variant: a float is the text of its double, a whole number its digits.
    """

    def marked(token: Column) -> Column:
        number = F.when(token.rlike(_FLOAT), token.try_cast("double").cast("string")).otherwise(F.regexp_replace(token, "^-0$", "0"))
        return (
            F.when(token.startswith('"'), F.concat(F.lit('"s'), F.substr(token, F.lit(2))))
            .when(_is_number(token), F.concat(F.lit('"n'), number, F.lit('"')))
            .otherwise(token)
        )

    def plain(token: Column) -> Column:
        rest = F.substr(token, F.lit(3))
        return (
            F.when(token.startswith('"s'), F.concat(F.lit('"'), rest))
            .when(token.startswith('"n'), F.replace(rest, F.lit('"'), F.lit("")))
            .otherwise(token)
        )

    ordered = F.to_json(F.from_json(F.array_join(F.transform(_tokens(raw), marked), ""), "variant", _STRICT))
    return F.array_join(F.transform(_tokens(ordered), plain), "")


# Outside strings: a number that a variant would not print by its value, and one whose double may be infinite or that has more digits than a variant keeps.
_SPELLED_OTHERWISE = r"[0-9][.eE]|[0-9-][0-9]{38}"
_EXTREME = r"[eE][-+]?[0-9]{3}|[0-9-][0-9]{38}"


def _with_doubles(parts: Column) -> Column:
    """The JSON text cut at its quotes, with an exponent for every number with a point: a variant reads it as a double then."""

    def spelled(part: Column, index: Column) -> Column:
        point = (index % 2 == 0) & F.contains(part, F.lit("."))
        return F.when(point, F.regexp_replace(part, r"(\.[0-9]++)(?![eE])", "$1e0")).otherwise(part)

    return F.array_join(F.transform(parts, spelled), '"')


def canonical_text(doc: Column, raw: Column) -> Column:
    """Compact JSON with sorted keys; equal for texts that mean the same values.

    A number with a point or an exponent is a double, any other one a whole number:
    ``1e1`` and ``10.0`` are alike, ``10`` is another value. Variants do not keep
    them apart, so a line that holds such a number is spelled anew, and one with
    a number that no variant prints is taken apart itself.
    """

    def by_numbers(parts: Column) -> Column:
        outside = F.array_join(F.filter(parts, lambda part, index: index % 2 == 0), " ")
        doubles = _spelled(F.to_json(F.from_json(_with_doubles(parts), "variant", _STRICT)))
        plain = F.when(~outside.rlike(_SPELLED_OTHERWISE), F.to_json(doc))
        return plain.when(~outside.rlike(_EXTREME), doubles).otherwise(_by_value(raw))

    # Only looked at where the first test holds.
    return F.when(raw.rlike(_MAY_HOLD_FLOAT), once(F.split(_spelled(raw), '"'), by_numbers)).otherwise(F.to_json(doc))


def payload_hash(doc: Column, raw: Column) -> Column:
    """SHA-256 of the canonical text of a line whose JSON value is ``doc``."""
    return F.sha2(canonical_text(doc, raw), 256)
