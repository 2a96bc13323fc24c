"""Value rules: how one source value becomes a document value.

The rules are tried in this order: bracketed text or struct, array, date, override,
decimal, default.  Which of them can apply is known from the source type, so each
column gets only the branches it needs.  A result is rendered as

* ``variant`` - the typed value, for the stored document,
* ``terms``   - ``array<string>``, one element per exact term,
* ``text``    - one string (array elements joined by commas), for ids and routing.

A null result means "leave the field out": the value is null, empty, or the word null.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from shardloom.spec import Rules

# fixed values: override types that convert the value (any other override only changes the
# mapping), and the texts an array and a map of entries begin with
CONVERTING = ("long", "integer", "double", "string")
ARRAY_TEXT = "WrappedArray("
MAP_TEXT = "Map("

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def java_text(c: Column, dtype: T.DataType, nested: bool = False) -> Column:
    """Text form of a value as the array and struct rules see it."""
    if isinstance(dtype, T.StringType):
        text = c
    elif isinstance(dtype, T.ArrayType):
        text = F.concat(F.lit(ARRAY_TEXT), _joined(c, dtype.elementType, ", "), F.lit(")"))
    elif isinstance(dtype, T.StructType):
        parts = [java_text(c[f.name], f.dataType, nested=True) for f in dtype.fields]
        text = F.when(c.isNotNull(), F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")))
    elif isinstance(dtype, T.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.concat(
            java_text(e["key"], dtype.keyType), F.lit(" -> "),
            java_text(e["value"], dtype.valueType, nested=True)))
        text = F.concat(F.lit(MAP_TEXT), F.array_join(pairs, ", "), F.lit(")"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("null")) if nested else text


def _joined(c: Column, element: T.DataType, sep: str) -> Column:
    if isinstance(element, (T.ArrayType, T.StructType, T.MapType)):
        return F.array_join(F.transform(c, lambda x: java_text(x, element, nested=True)), sep)
    return F.array_join(c.cast("array<string>"), sep, "null")


def split_terms(text: Column) -> Column:
    """Comma split that keeps inner and leading empties and drops trailing ones."""
    kept = F.rtrim(text, F.lit(","))
    only_commas = (kept == "") & (text != "")
    return F.when(only_commas, F.array().cast("array<string>")).otherwise(F.split(kept, ","))


def array_terms(c: Column, dtype: T.ArrayType, mode: str) -> Column:
    if mode == "typed":
        while isinstance(dtype.elementType, T.ArrayType):
            c, dtype = F.flatten(F.array_compact(c)), dtype.elementType
        if isinstance(dtype.elementType, (T.StructType, T.MapType)):
            return F.transform(F.array_compact(c), lambda x: java_text(x, dtype.elementType))
        return F.array_compact(c).cast("array<string>")
    text = _joined(c, dtype.elementType, ",")
    if isinstance(dtype.elementType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
        text = F.replace(text, F.lit(ARRAY_TEXT), F.lit(""))
    return split_terms(F.translate(text, ") ", ""))


def _is_bracketed(c: Column) -> Column:
    return F.startswith(c, F.lit("[")) & F.endswith(c, F.lit("]"))


def _unbracket(text: Column) -> Column:
    return split_terms(F.translate(text, "[] ", ""))


def _try_override(c: Column, dtype: T.DataType, target: str) -> Column:
    """Converted value, null where the value does not fit ``target``."""
    if target == "long":
        return (c.cast("bigint") if isinstance(dtype, T.IntegralType)
                else java_text(c, dtype).try_cast("bigint"))
    if target == "double":
        exact = isinstance(dtype, T.NumericType) and not isinstance(dtype, T.FloatType)
        return (c.cast("double") if exact
                else java_text(c, dtype).try_cast("double"))
    if isinstance(dtype, T.DoubleType):  # narrowing: cut off the fraction, clamp the range
        return F.least(F.greatest(F.nanvl(c, F.lit(0.0)), F.lit(float(_INT_MIN))),
                       F.lit(float(_INT_MAX))).cast("int")
    if isinstance(dtype, (T.StringType, T.IntegralType)):
        return c.try_cast("int")
    return F.lit(None).cast("int")


def cast_failed(c: Column, dtype: T.DataType, target: str) -> Column:
    """True where an override cannot convert a value that is there."""
    if target not in ("long", "integer", "double") or isinstance(
            dtype, (T.ArrayType, T.StructType, T.DateType)):
        return F.lit(False)
    failed = c.isNotNull() & _try_override(c, dtype, target).isNull()
    if isinstance(dtype, T.StringType):
        failed = failed & ~_is_bracketed(c)
    return failed


def _override(c: Column, dtype: T.DataType, target: str, name: Column, rules: Rules) -> Column:
    value = _try_override(c, dtype, target)
    if rules.on_error == "fail":
        message = F.concat(F.lit("field "), name, F.lit(f": value does not fit type {target}: "),
                           java_text(c, dtype))
        kind = {"long": "bigint", "integer": "int", "double": "double"}[target]
        value = F.coalesce(value, F.raise_error(message).cast(kind))
    return F.when(c.isNotNull(), value)


def _scalar(c: Column, dtype: T.DataType, target: str | None, name: Column,
            rules: Rules) -> tuple[Column, bool]:
    """Value of a non-array result, and whether it is text (text can be empty)."""
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyyMMdd"), False
    if target in ("long", "integer", "double"):
        return _override(c, dtype, target, name, rules), False
    if target == "string":
        return java_text(c, dtype), True
    if isinstance(dtype, T.StringType):
        return c, True
    if isinstance(dtype, T.DecimalType) and target is None:
        return c.cast("double"), False
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), False
    if isinstance(dtype, T.BinaryType):
        return F.base64(c), False
    if isinstance(dtype, T.MapType):
        return F.to_json(c), False
    return c, False


def _render_array(terms: Column, render: str) -> Column:
    if render == "variant":
        return terms.cast("variant")
    return F.array_join(terms, ",") if render == "text" else terms


def _render_scalar(value: Column, is_text: bool, render: str) -> Column:
    present = value.isNotNull()
    if is_text:
        present = present & (value != "") & (F.lower(value) != "null")
    if render == "variant":
        shown = value.cast("variant")
    else:
        shown = value.cast("string")
        shown = F.array(shown) if render == "terms" else shown
    return F.when(present, shown)


def _render_one(c: Column, dtype: T.DataType, target: str | None, name: Column,
                rules: Rules, render: str) -> Column:
    if isinstance(dtype, T.StructType):
        return _render_array(_unbracket(java_text(c, dtype)), render)
    if isinstance(dtype, T.ArrayType):
        return _render_array(array_terms(c, dtype, rules.arrays), render)
    scalar = _render_scalar(*_scalar(c, dtype, target, name, rules), render)
    if isinstance(dtype, T.StringType):
        return F.when(_is_bracketed(c), _render_array(_unbracket(c), render)).otherwise(scalar)
    return scalar


def render_value(c: Column, dtype: T.DataType, name: str | Column, rules: Rules,
                 render: str) -> Column:
    """Document value of ``c`` under field ``name`` (a literal name or a column of names)."""
    if isinstance(name, str):
        return _render_one(c, dtype, rules.overrides.get(name), F.lit(name), rules, render)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.DateType)):  # decided before overrides
        return _render_one(c, dtype, None, name, rules, render)
    plain = _render_one(c, dtype, None, name, rules, render)
    by_target: dict[str, list[str]] = {}
    for field, target in rules.overrides.items():
        # an unknown override type only keeps a decimal from becoming a double
        by_target.setdefault(target if target in CONVERTING else "", []).append(field)
    if not isinstance(dtype, T.DecimalType):
        by_target.pop("", None)
    chain = None
    for target, fields in sorted(by_target.items()):
        branch = _render_one(c, dtype, target, name, rules, render)
        chain = (F.when if chain is None else chain.when)(name.isin(*sorted(fields)), branch)
    return plain if chain is None else chain.otherwise(plain)
