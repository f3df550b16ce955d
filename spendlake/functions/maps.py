"""JSON text holding a map: normalised text, and real map columns.

The functions take the text as a SQL expression (a column name, usually) and return a
column. Objects whose parsed form already says all (no true, false or null, no repeated name)
never leave generated code; the others go through lambdas, which are interpreted. Those are
written in SQL because ``let`` below nests them, and a lambda is far quicker to state and to plan
that way than call by call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How a JSON text becomes a column: an expression in generated code that is NULL where it does not
# settle the matter, and one with lambdas for the rest.
Ways = tuple[str, str]


def string_map(text: str) -> Column:
    """``map<string,string>`` of a JSON object, values as ``None`` / ``True`` / text.

    Text that is no JSON object gives NULL; NULL and empty text give an empty map.
    """
    return either(string_map_ways(text))


def double_map(text: str) -> Column:
    """``map<string,double>`` when every value is a number, else NULL (see ``discount_text``)."""
    return either(double_map_ways(text))


def map_text(text: str) -> Column:
    """Normalised JSON text with string values; text that is no object is kept as it is."""
    return either(map_text_ways(text))


def discount_text(text: str) -> Column:
    """Normalised JSON text with number values; strings for the row if any is no number."""
    return either(discount_text_ways(text))


def either(ways: Ways) -> Column:
    return F.expr("coalesce({}, {})".format(*ways))


def string_map_ways(text: str) -> Ways:
    quick = f"CASE WHEN {_plain_strings(text)} THEN {_only(text, 'string')} END"
    return quick, _let(text, "t", _strings("t"))


def double_map_ways(text: str) -> Ways:
    quick = f"CASE WHEN {_plain_numbers(text)} THEN {_only(text, 'double')} END"
    return quick, _let(text, "t", _let(_strings("t"), "m", _numbers("m")))


def map_text_ways(text: str) -> Ways:
    slow = f"coalesce({_let(_strings('t'), 'm', _string_text('m'))}, t)"
    odd = (r"\\", '{":"', ',":"', ':":"', '{","', ',","', ':","')  # a mark that is a name or value
    j = f"to_json({_only(text, 'string')})"
    spaced = f"""replace(replace({j}, '":"', '": "'), '","', '", "')"""
    return f"CASE WHEN {_plain_strings(text, odd)} THEN {spaced} END", _let(text, "t", slow)


def discount_text_ways(text: str) -> Ways:
    numbers = _let(_numbers("m"), "n", _number_text("n"))
    normalised = _let(_strings("t"), "m", f"coalesce({numbers}, {_string_text('m')})")
    odd = (r"\\", '{":', ',":', '{",', ',",')  # a mark that a name begins with
    j = f"to_json({_only(text, 'double')})"
    spaced = f"""replace(replace({j}, '":', '": '), ',"', ', "')"""
    return (
        f"CASE WHEN {_plain_numbers(text, odd)} THEN {spaced} END",
        _let(text, "t", f"coalesce({normalised}, t)"),
    )


def json_or_default(text: str) -> Column:
    """A map for any text: ``_empty`` for nothing, ``value`` for what is no object."""
    # The two keys, and JSON texts that hold nothing.
    found = "CASE WHEN size(m) = 0 THEN map('_empty', '') ELSE coalesce(m, map('value', t)) END"
    nothing = """trim(t) IN ('[]', '{}', '0', 'null', 'false', '""')"""
    return F.expr(
        _let(
            text,
            "t",
            f"CASE WHEN {_blank('t')} OR {nothing} THEN map('_empty', '') "
            f"ELSE {_let(_strings('t'), 'm', found)} END",
        )
    )


def _array(t: str, value: str) -> str:
    return f"from_json(concat('[', {t}, ']'), 'array<map<string,{value}>>')"


def _only(t: str, value: str) -> str:
    return f"get({_array(t, value)}, 0)"


def _plain(t: str, value: str) -> str:
    """The text is one object, and none of its names is written twice."""
    m = _only(t, value)
    return f"""size({_array(t, value)}) = 1 AND startswith(trim({t}), '{{') AND endswith(trim({t}), '}}')
        AND size(array_distinct(map_keys({m}))) = size({m})"""


# Both ask the text that the parsed map is written as, which repeats no work: equal parts of an
# expression are computed once. A value that only looks like the excluded ones takes the slow way.
def _plain_strings(t: str, odd: tuple[str, ...] = ()) -> str:
    return _without(t, "string", (":null", ':"true"', ':"false"', *odd))


def _plain_numbers(t: str, odd: tuple[str, ...] = ()) -> str:
    return _without(t, "double", (":null", ':"', *odd))


def _without(t: str, value: str, odd: tuple[str, ...]) -> str:
    j = f"to_json({_only(t, value)})"
    return " AND ".join([_plain(t, value), *(f"NOT contains({j}, '{x}')" for x in odd)])


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _blank(t: str) -> str:
    return f"({t} IS NULL OR {t} = '')"


def _parse(t: str, map_type: str) -> str:
    """The one object the text holds, else NULL.

    The text is parsed as the single element of an array, because a bare parse stops
    after the first object and would accept whatever follows it.
    """
    parsed = f"from_json(concat('[', {t}, ']'), 'array<{map_type}>')"
    only = _let(parsed, "a", "CASE WHEN size(a) = 1 THEN get(a, 0) END")
    return f"CASE WHEN startswith(trim({t}), '{{') AND endswith(trim({t}), '}}') THEN {only} END"


def _strings(t: str) -> str:
    pairs = _let(
        _parse(t, "map<string,string>"), "p", _let(_named(t, "p"), "d", _last_of_each_key("d"))
    )
    empty = "cast(map() AS map<string,string>)"
    return f"CASE WHEN {_blank(t)} THEN {empty} ELSE {pairs} END"


def _named(t: str, p: str) -> str:
    """Values of a parsed map under the names that nothing, true and false go by."""
    # JSON true and the text "true" look alike once read as strings; only maps that hold
    # such a value are read a second time with their JSON types.
    typed = f"""transform_values({_parse(t, "map<string,variant>")}, (k, v) ->
        CASE WHEN schema_of_variant(v) = 'BOOLEAN' THEN initcap(cast(v AS string))
             ELSE coalesce(cast(v AS string), 'None') END)"""
    return f"""CASE
        WHEN exists(map_values({p}), v -> v IN ('true', 'false')) THEN {typed}
        WHEN exists(map_values({p}), v -> v IS NULL)
          THEN transform_values({p}, (k, v) -> coalesce(v, 'None'))
        ELSE {p} END"""


def _last_of_each_key(p: str) -> str:
    """A key written twice in one object keeps its last value."""
    kept = _let(
        f"map_entries({p})",
        "es",
        "filter(es, (e, i) -> NOT exists(slice(es, i + 2, size(es)), x -> x.key = e.key))",
    )
    repeats = f"size(array_distinct(map_keys({p}))) < size({p})"
    return f"CASE WHEN {repeats} THEN map_from_entries({kept}) ELSE {p} END"


def _numbers(m: str) -> str:
    # A trailing d or f is a number to the JVM only.
    number = r"""CASE WHEN v = 'True' THEN 1D WHEN v = 'False' THEN 0D
        WHEN NOT rlike(v, r'[0-9.][dDfF]\s*$') THEN try_cast(v AS double) END"""
    values = f"transform_values({m}, (k, v) -> {number})"
    return _let(values, "q", "CASE WHEN NOT exists(map_values(q), v -> v IS NULL) THEN q END")


def _quoted(s: str) -> str:
    escaped = rf"regexp_replace(substr(to_json(array({s})), 2), r'\]$', '')"
    return rf"""CASE WHEN rlike({s}, r'["\\\x00-\x1f]') THEN {escaped}
        ELSE concat('"', {s}, '"') END"""


def _string_text(m: str) -> str:
    item = f"concat({_quoted('e.key')}, ': ', {_quoted('e.value')})"
    return f"concat('{{', array_join(transform(map_entries({m}), e -> {item}), ', '), '}}')"


def _number_text(m: str) -> str:
    item = f"concat({_quoted('e.key')}, ': ', cast(e.value AS string))"
    return f"concat('{{', array_join(transform(map_entries({m}), e -> {item}), ', '), '}}')"
