"""Column expressions replacing the reference's per-row Python helpers.

All are built-in Catalyst expressions: they run inside whole-stage codegen
and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from egoline.functions.constants import CREATED_AT_FORMATS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def object_with(c, key: str) -> Column:
    """Whether a text is exactly one JSON object that has ``key`` (even with a
    null value). Wrapped in brackets, text after the object makes the parse fail
    and a second value makes the array longer."""
    one = F.json_array_length(F.concat(F.lit("["), _c(c), F.lit("]"))) == 1
    return F.coalesce(one & F.array_contains(F.json_object_keys(_c(c)), key), F.lit(False))


def login_from_json(c) -> Column:
    """``login`` of a JSON object held as text; null when the text is not one
    JSON object or has no ``login`` (malformed JSON gives null, not an error)."""
    return F.when(object_with(c, "login"), F.get_json_object(_c(c), "$.login"))


def name_from_json(c) -> Column:
    """``name`` of a JSON object held as text; null when absent or malformed."""
    return F.get_json_object(_c(c), "$.name")


def owner_slash_name(owner, name) -> Column:
    """``owner/name``; null if either part is null (``concat`` propagates null,
    unlike ``concat_ws`` which would silently skip the missing part)."""
    return F.concat(_c(owner), F.lit("/"), _c(name))


def parse_created_at(c) -> Column:
    """Text in one of the timeline's time formats to a timestamp; null when
    it is in none (try_ variant: no failure under ANSI mode)."""
    return F.coalesce(*[F.try_to_timestamp(_c(c), F.lit(f)) for f in CREATED_AT_FORMATS])


def strip_first(c) -> Column:
    """Drop the first character unconditionally (``s[1:]``)."""
    return F.substring(_c(c), 2, 2147483647)


def follows_from_json(arr) -> Column:
    """array<JSON text> -> array<login>, all-or-nothing.

    One element that is not a JSON object with a ``login`` key turns the whole
    list null; a null login is kept as a null element; an empty list stays
    empty; a null list stays null.
    """
    a = _c(arr)
    return F.when(~F.exists(a, lambda x: ~object_with(x, "login")), F.transform(a, lambda x: F.get_json_object(x, "$.login")))


def follows_from_structs(arr) -> Column:
    """array<struct<login>> -> array<login>.

    A null element makes the whole list null (the reference's attribute access
    on it fails and the list is dropped); a struct with a null login keeps a
    null element; empty stays empty; null stays null.
    """
    a = _c(arr)
    logins = F.transform(a, lambda x: x.getField("login"))
    return F.when(~F.exists(a, lambda x: x.isNull()), logins)


def follows_until_bad(arr) -> Column:
    """array<struct<login>> -> array<login>, keeping the prefix before the first
    bad (null) element: the fetch-on-miss parser stops at a bad element but
    keeps what it collected, unlike the batch parser. Empty or null -> [].
    """
    a = _c(arr)
    logins = F.transform(a, lambda x: x.getField("login"))
    first_bad = F.array_position(F.transform(a, lambda x: x.isNull()), True)
    kept = F.when(first_bad == 0, logins).otherwise(F.slice(logins, F.lit(1), first_bad - 1))
    return F.coalesce(kept, F.array().cast("array<string>"))
