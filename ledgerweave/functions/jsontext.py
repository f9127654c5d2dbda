"""JSON text in the layout of Python's ``json.dumps``, built from expressions.

Separators are ``", "`` and ``": "``, non-ASCII characters are escaped, nulls are
kept and floats print as Python prints them.

The expressions are SQL text, parsed in one call: built node by node from
Python, the rows of many operators would take longer to plan than to run.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens of JSON text; the pieces of an encoded string, with
# escape sequences kept whole; and the characters that need no escaping at all.
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[^\s",:{}\[\]]+|[{}\[\],:]'
_PIECE = r"\\u[0-9A-Fa-f]{4}|\\.|[\x00-\x5B\x5D-\x7E]+|[^\x00-\x7E]+"
_PLAIN = r"\A[ !#-\[\]-~]*+\z"
_ASCII = r"\A[\x00-\x7E]*+\z"
_JAVA_REAL = r"\A-?[0-9.]+E-?[0-9]+\z"


def _sql(text: str) -> str:
    return "r'" + text + "'"


def _float_sql(x: str) -> str:
    """A double as Python's ``repr`` prints it.

    The digits are Java's, which before Java 19 can be one too many above 1e16.
    """
    text = f"CAST({x} AS STRING)"
    plain = (f"regexp_replace(CAST(try_cast({x} AS DECIMAL(38,20)) AS STRING), "
             f"{_sql(r'(\.\d+?)0+\z')}, '$1')")
    short = f"regexp_replace({text}, {_sql(r'\.0E')}, 'E')"
    padded = f"regexp_replace({short}, {_sql(r'E(-?)(\d)\z')}, 'E$10$2')"
    signed = f"replace(regexp_replace({padded}, {_sql(r'E(\d)')}, 'E+$1'), 'E', 'e')"
    return (f"CASE WHEN NOT contains({text}, 'E') THEN {text} "
            f"WHEN abs({x}) >= 1e-4 AND abs({x}) < 1e16 THEN {plain} ELSE {signed} END")


def _escape_sql(encoded: str) -> str:
    units = f"regexp_replace(lower(hex(encode(p, 'UTF-16BE'))), '(.{{4}})', {_sql(r'\\u$1')})"
    return (f"array_join(transform(regexp_extract_all({encoded}, {_sql(_PIECE)}, 0), p -> "
            f"CASE WHEN startswith(p, {_sql(chr(92) + 'u')}) THEN lower(p) "
            f"WHEN ascii(p) < 127 THEN p ELSE {units} END), '')")


def string_sql(x: str) -> str:
    """SQL text that gives the text ``x`` as a quoted JSON string."""
    encoded = f"trim(BOTH '[]' FROM to_json(array({x})))"
    return (f"CASE WHEN {x} RLIKE {_sql(_PLAIN)} THEN concat('\"', {x}, '\"') "
            f"ELSE {_escape_sql(encoded)} END")


def _key(name: str) -> str:
    return _sql(json.dumps(name) + ": ")


def _value_sql(x: str, data_type: T.DataType, depth: int = 0) -> str:
    v = f"v{depth}"
    if isinstance(data_type, T.StructType):
        fields = ", ".join(f"{_key(f.name)} || {_value_sql(f'{x}.`{f.name}`', f.dataType, depth)}"
                           for f in data_type.fields)
        text = f"concat('{{', concat_ws(', ', {fields}), '}}')"
    elif isinstance(data_type, T.ArrayType):
        item = _value_sql(v, data_type.elementType, depth + 1)
        text = f"concat('[', array_join(transform({x}, {v} -> {item}), ', '), ']')"
    elif isinstance(data_type, T.MapType):
        item = _value_sql(f"{v}.value", data_type.valueType, depth + 1)
        text = (f"concat('{{', array_join(transform(map_entries({x}), {v} -> "
                f"{string_sql(f'{v}.key')} || ': ' || {item}), ', '), '}}')")
    elif isinstance(data_type, (T.IntegralType, T.BooleanType)):
        text = f"CAST({x} AS STRING)"
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _float_sql(x)
    elif isinstance(data_type, T.NumericType):
        text = _float_sql(f"CAST({x} AS DOUBLE)")
    elif isinstance(data_type, T.VariantType):
        text = _spaced_sql(f"to_json({x})")
    elif isinstance(data_type, T.StringType):
        text = string_sql(x)
    else:
        text = string_sql(f"CAST({x} AS STRING)")
    return f"coalesce({text}, 'null')"


def json_string(name: str) -> Column:
    """A text column as a quoted JSON string; null stays null."""
    return F.expr(string_sql(name))


def json_value(name: str, data_type: T.DataType) -> Column:
    """A column of any type as JSON text; nulls become ``null``."""
    return F.expr(_value_sql(name, data_type))


def json_object(schema: T.StructType, names: Sequence[str] | None = None) -> Column:
    """The columns of a row, or the named ones, as one JSON object."""
    fields = [f for f in schema.fields if names is None or f.name in names]
    pairs = ", ".join(f"{_key(f.name)} || {_value_sql(f'`{f.name}`', f.dataType)}" for f in fields)
    return F.expr(f"concat('{{', concat_ws(', ', {pairs}), '}}')")


def _retold_sql(t: str) -> str:
    """A JSON token as Python would print it."""
    foreign = f"NOT {t} RLIKE {_sql(_ASCII)} OR contains({t}, {_sql(chr(92) + 'u')})"
    number = _float_sql(f"try_cast({t} AS DOUBLE)")
    return (f"CASE WHEN startswith({t}, '\"') AND ({foreign}) THEN {_escape_sql(t)} "
            f"WHEN {t} RLIKE {_sql(_JAVA_REAL)} THEN {number} ELSE {t} END")


def _tokens_sql(x: str) -> str:
    return f"regexp_extract_all({x}, {_sql(_TOKEN)}, 0)"


def _spaced_sql(x: str) -> str:
    """JSON text on one line with the separators of Python's printer; null stays null."""
    told = f"CASE k WHEN ',' THEN ', ' WHEN ':' THEN ': ' ELSE {_retold_sql('k')} END"
    return f"array_join(transform({_tokens_sql(x)}, k -> {told}), '')"


def _indented_sql(x: str, depth: int) -> str:
    """JSON text of any nesting, one item per line; ``depth`` is that of its first token.

    The tokens are told one after the other; ``d`` is the depth so far and ``l`` what came
    last: an opening bracket, a comma, a colon or anything else.
    """
    def line(depth: str) -> str:
        return f"concat(chr(10), repeat('  ', {depth}))"
    before = (f"CASE WHEN t IN ('}}', ']') THEN IF(s.l = 'o', '', {line('s.d - 1')}) "
              f"WHEN t NOT IN (',', ':') AND s.l IN ('o', ',') THEN {line('s.d')} ELSE '' END")
    told = f"CASE t WHEN ':' THEN ': ' ELSE {_retold_sql('t')} END"
    deeper = "CASE WHEN t IN ('{', '[') THEN s.d + 1 WHEN t IN ('}', ']') THEN s.d - 1 ELSE s.d END"
    last = "CASE WHEN t IN ('{', '[') THEN 'o' WHEN t IN (',', ':') THEN t ELSE 'v' END"
    return (f"aggregate({_tokens_sql(x)}, named_struct('x', '', 'd', {depth}, 'l', ''), (s, t) -> "
            f"named_struct('x', concat(s.x, {before}, {told}), 'd', {deeper}, 'l', {last}), s -> s.x)")


def indented_rows(rows: str, shown: int | None = None) -> Column:
    """A list of JSON objects of any nesting, one item per line, indented by two spaces.

    ``rows`` names the column.  With ``shown``, only that many rows are listed.
    """
    kept = rows if shown is None else f"slice({rows}, 1, {shown})"
    return F.expr(
        f"CASE WHEN size({rows}) = 0 THEN '[]' ELSE concat('[', chr(10), array_join("
        f"transform({kept}, j -> concat('  ', {_indented_sql('j', 1)})), concat(',', chr(10))), "
        f"chr(10), ']') END")


def strict_record(line: Column, fields: str) -> Column:
    """Parse one JSON object; null for anything Python's parser would refuse.

    A closing field after the line makes text behind the object an error, which
    a plain ``from_json`` would pass over.  The one-element array holds the
    parsed line, so that it is parsed once.  Text that does not start like an
    object never reaches the parser, where it would cost an exception.
    """
    wrapped = F.concat(F.lit('{"r":['), line, F.lit('],"_end":1}'))
    is_object = F.ltrim(line, F.lit(" \t\n\r")).startswith("{")
    parsed = F.from_json(F.when(is_object, wrapped), f"r array<{fields}>, _end int", {"allowSingleQuotes": "false"})
    return F.transform(F.array(parsed), lambda p: F.when(
        (p["_end"] == 1) & (F.size(p["r"]) == 1), p["r"][0]))[0]
