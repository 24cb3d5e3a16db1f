"""JSON under an exact type contract, over VARIANT values.

`from_json` and a plain variant cast are lax (a number becomes text, 1.0 becomes 1), so the
JSON kind is tested before a value is taken. A missing key is SQL NULL, a JSON null is the
variant null, and the two are told apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON kind to the type name used in error messages.
TYPE_NAMES = {
    "STRING": "str",
    "BIGINT": "int",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "OBJECT": "dict",
    "ARRAY": "list",
}
SQL_TYPE = {"STRING": "string", "BIGINT": "bigint", "BOOLEAN": "boolean"}

INVALID = "invalid JSON"

_CHECKSUM = "line checksum"
# The reader's own bound on a string is 20 million characters.
_STRICT = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": str(2**31 - 1),
}


def parse_line(line: Column, checksum: Column, members: str) -> Column:
    """One pass over a line: the array `[object, {checksum}]`, members as declared.

    The JSON reader stops at the end of the first value and ignores what follows. With an
    object holding the line's checksum behind it, any text after the line's object shows: it
    would have to close the array early (one element) or add elements (three).
    """
    tail = F.concat(F.lit(f',{{"{_CHECKSUM}":'), checksum.cast("string"), F.lit("}]"))
    return F.from_json(
        F.concat(F.lit("["), line, tail),
        f"array<struct<{members}, `{_CHECKSUM}`: bigint>>",
        _STRICT,
    )


def members(text: Column, declared: str) -> Column:
    """The declared members of a text known to be one JSON object."""
    return F.from_json(text, f"struct<{declared}>", _STRICT)


def is_whole(parsed: Column, checksum: Column) -> Column:
    """True when the line is exactly one JSON value, with nothing after it."""
    return (F.size(parsed) == 2) & F.try_element_at(parsed, F.lit(2))[_CHECKSUM].eqNullSafe(
        checksum
    )


def whole_variant(line: Column) -> Column:
    """The line as a variant, null unless it is exactly one JSON value. Parses the line twice,
    each time closed in another way: text after the value breaks one or the other."""
    in_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"line":'), line, F.lit("}")))
    return F.when(
        in_array.isNotNull() & F.try_variant_get(in_array, "$[1]", "variant").isNull(),
        F.try_variant_get(in_object, "$.line", "variant"),
    )


def object_text(text: Column, line: Column, key: str) -> Column:
    """True when a member taken as text is an object, not a string that looks like one.

    An object's text is `{}` or begins with a brace and a quote. A string of that form has its
    quote escaped in the line, so only lines with such a mark, and `{}`, are looked at again.
    """
    mark = F.contains(line, F.lit('{\\"')) | F.contains(line, F.lit("\\u00"))
    again = members(line, f"{key}: variant")[key]
    return (F.startswith(text, F.lit('{"')) & ~mark) | (
        F.startswith(text, F.lit("{")) & is_object(again)
    )


def shallow(value: Column, path: str, *keys: str) -> Column:
    """The named members of an object as variants; null when the value is not an object."""
    members = ", ".join(f"`{key}` variant" for key in keys)
    return F.try_variant_get(value, path, f"struct<{members}>")


def is_object(value: Column, path: str = "$") -> Column:
    """Object test that walks one level of keys and copies no content."""
    return shallow(value, path, "is_object").isNotNull()


def kind(value: Column) -> Column:
    """JSON kind of a value: STRING, BIGINT, BOOLEAN, VOID, DOUBLE, DECIMAL(..), ..."""
    return F.schema_of_variant(value)


def taken(value: Column, sql_kind: str) -> Column:
    """The value where its kind is exact, else null."""
    return F.when(kind(value) == sql_kind, F.try_variant_get(value, "$", SQL_TYPE[sql_kind]))


def member_error(value: Column, sql_kind: str, path: str) -> Column:
    """Error of a required member, null when its kind is exact. A number that is not a 64-bit
    integer counts as a float."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    found = F.try_element_at(names, F.regexp_extract(kind(value), r"^\w+", 0))
    wrong = F.concat(
        F.lit(f"field '{path}' must be {TYPE_NAMES[sql_kind]}, got "),
        F.coalesce(found, F.lit("float")),
    )
    return F.when(value.isNull(), F.lit(f"field '{path}' is required")).when(
        kind(value) != sql_kind, wrong
    )


def first_error(errors: Sequence[Column]) -> Column:
    """The first error that is not null.

    Same as coalesce, but evaluated without generated code: the many messages would make a
    method too long for the JVM to compile, and few rows need them.
    """
    return F.get(F.filter(F.array(*errors), lambda error: error.isNotNull()), F.lit(0))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value worked out once per row, however often the body uses it;
    like `first_error`, outside generated code."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def object_error(container: Column, path: str, name: str) -> Column:
    """Error of a required object, null when it is one."""
    missing = F.try_variant_get(container, path, "variant").isNull()
    return F.when(
        ~is_object(container, path),
        F.when(missing, F.lit(f"field '{name}' is required")).otherwise(
            F.lit(f"field '{name}' must be dict")
        ),
    )


def optional_object_error(member: Column, name: str) -> Column:
    """Error of an optional object: absent and JSON null are fine, other kinds are not."""
    absent = member.isNull() | F.is_variant_null(member)
    return F.when(~absent & ~is_object(member), F.lit(f"field '{name}' must be dict"))


def opaque(value: Column) -> Column:
    """The same value, which filters do not look through.

    The optimizer rewrites a filter on a projected column into a filter on its expression
    below the projection, which here would parse each line again for every member an error
    looks at. It leaves expressions alone that depend on the partition.
    """
    return F.when(F.spark_partition_id() >= 0, value)
