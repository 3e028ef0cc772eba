"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: everything up to the space character counts as blank.
BLANKS = "".join(chr(code) for code in range(33))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def has_text(c: Column) -> Column:
    """Neither null nor blank. After trimming spaces, a text starting with a printable character
    is decided at once; only one that starts with a control character is searched."""
    plain = F.trim(c)
    rare = (plain != "") & c.rlike(r"[^\x00-\x20]")
    return F.coalesce((plain >= "!") | rare, F.lit(False))


def is_empty(c: Column) -> Column:
    """Null or blank. The word "null" is not empty here, unlike in ``is_not_empty``."""
    return ~has_text(c)


def is_not_empty(c: Column) -> Column:
    """Neither null, blank nor the word "null" in any case."""
    lower = F.lower(c)
    return has_text(c) & ~(lower.contains("null") & (strip(lower) == "null"))


def trim_comma(c: Column) -> Column:
    """Drop one leading and one trailing comma."""
    rest = F.when(c.startswith(","), F.substr(c, F.lit(2))).otherwise(c)
    return F.when(rest.endswith(","), F.left(rest, F.length(rest) - 1)).otherwise(rest)


def pad2(c: Column) -> Column:
    """Prefix "0" unless the text has exactly two characters."""
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def split_ids(c: Column) -> Column:
    """``a|b|c`` as an array; blank parts are removed, the others kept untrimmed."""
    return F.filter(F.split(c, r"\|"), has_text)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def get_field(c: Column, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in ``k=v|k=v``; null if it is absent or has no single value."""
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    edge = "\\" + delimiter
    pattern = f"(?:^|{edge}){_quoted(field)}=([^={edge}]+)=*(?:{edge}|$)"
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def _with_value(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it: inside a
    higher-order function an outer expression is computed anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def set_field(c: Column, field: str, value: Column | str, delimiter: str = "|") -> Column:
    """Replace the first ``field``; the result is always joined by ``|``."""
    new_value = F.lit(value) if isinstance(value, str) else value
    entry = F.concat(F.lit(field + "="), new_value)

    def position(parts: Column) -> Column:
        names = F.transform(parts, lambda part: F.split_part(part, F.lit("="), F.lit(1)))
        return F.array_position(names, field) - 1

    def replace(parts: Column) -> Column:
        return _with_value(position(parts), lambda target: F.array_join(
            F.transform(parts, lambda part, i: F.when(i == target, entry).otherwise(part)), "|"))

    return _with_value(F.split(F.rtrim(c, F.lit(delimiter)), _quoted(delimiter)), replace)


def concat_id_name(id_: Column, name: Column) -> Column:
    return F.concat_ws(":", id_.cast("string"), name)


def json_string(c: Column, field: str) -> Column:
    return F.get_json_object(c, f"$.{field}")
