"""Rows to sparse flat documents, in one pass without a shuffle.

A document has a static part, one possible field per plain column, and a dynamic part, the
flattened map columns as one map.  Denied names and empty values never enter either.  Of
two fields with one name the later in column order stays; which plain columns a map can
meet at all is known from its name, so most documents need no such check.
"""
from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shardloom.functions.names import could_name, map_field_name
from shardloom.functions.values import cast_failed, render_value
from shardloom.session import stored
from shardloom.sources.columns import column_of, field_of, sheltered
from shardloom.spec import Rules

_VALUE_TYPE = {"variant": "variant", "terms": "array<string>", "text": "string"}
_DYNAMIC = "_dynamic"


def _is_map(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.MapType)


def _wanted(f: T.StructField, rules: Rules, only: Collection[str] | None) -> bool:
    """Whether a column can give any field of the document."""
    if _is_map(f):
        return only is None or any(could_name(field_of(f), n) for n in only if n not in rules.deny)
    return field_of(f) not in rules.deny and (only is None or field_of(f) in only)


def _reachable(f: T.StructField, names: Collection[str]) -> list[str]:
    return sorted(n for n in names if could_name(field_of(f), n))


def _may_collide(f: T.StructField, name: str, rules: Rules) -> bool:
    """Whether a map column can hold a field that a plain column is called after."""
    if rules.collisions is not None and name not in rules.collisions:
        return False
    return could_name(field_of(f), name)


def _value(f: T.StructField, rules: Rules, render: str) -> Column:
    return render_value(column_of(f), f.dataType, field_of(f), rules, render)


def _named_entries(f: T.StructField, rules: Rules, only: Collection[str] | None) -> Column:
    """Map entries under their document names, without denied and unwanted ones."""
    def wanted(name: Column) -> Column:
        if only is not None:
            return name.isin(*[n for n in _reachable(f, only) if n not in rules.deny])
        return ~name.isin(*_reachable(f, rules.deny))

    entries = F.map_entries(column_of(f))
    if only is not None:  # few are wanted: look at the name before anything else
        entries = F.filter(entries, lambda e: wanted(map_field_name(field_of(f), e["key"])))
    named = F.transform(entries, lambda e: F.struct(
        map_field_name(field_of(f), e["key"]).alias("key"), e["value"].alias("value")))
    if only is None and _reachable(f, rules.deny):
        named = F.filter(named, lambda e: wanted(e["key"]))
    return named


def _map_entries(f: T.StructField, rules: Rules, render: str, only: Collection[str] | None,
                 winners: Sequence[tuple[str, Column]]) -> Column:
    """Rendered entries of one map column; ``winners`` are later plain fields it yields to."""
    mine = replace(rules, overrides={n: rules.overrides[n] for n in _reachable(f, rules.overrides)
                                     if only is None or n in only})
    kind = f.dataType.valueType
    simple = not mine.overrides and not _reachable(f, rules.deny) and only is None
    if simple:
        shown = F.transform(F.map_entries(column_of(f)), lambda e: F.struct(
            map_field_name(field_of(f), e["key"]).alias("key"),
            render_value(e["value"], kind, F.lit(""), mine, render).alias("value")))
    else:
        shown = F.transform(_named_entries(f, rules, only), lambda e: F.struct(
            e["key"].alias("key"), render_value(e["value"], kind, e["key"], mine, render).alias("value")))

    def stays(e: Column) -> Column:
        keep = e["value"].isNotNull()
        for name, value in winners:
            keep = keep & ~((e["key"] == name) & value.isNotNull())
        return keep

    return F.filter(shown, stays)


def dynamic_part(schema: T.StructType, rules: Rules, render: str,
                 only: Collection[str] | None = None) -> Column | None:
    """The flattened map columns as ``map<field, value>``; None without such columns.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``: of two entries the later one stays.
    """
    none = F.array().cast(f"array<struct<key:string,value:{_VALUE_TYPE[render]}>>")
    fields = [f for f in schema.fields if _wanted(f, rules, only)]
    parts = []
    for i, f in enumerate(fields):
        if _is_map(f):
            winners = [(field_of(p), _value(p, rules, render)) for p in fields[i + 1:]
                       if not _is_map(p) and _may_collide(f, field_of(p), rules)]
            parts.append(F.coalesce(_map_entries(f, rules, render, only, winners), none))
    if not parts:
        return None
    return F.map_from_entries(parts[0] if len(parts) == 1 else F.concat(*parts))


def static_part(schema: T.StructType, rules: Rules, render: str, dynamic: Column | None,
                only: Collection[str] | None = None) -> list[tuple[str, Column]]:
    """(field, value) of the plain columns; null where absent or replaced by a map entry."""
    fields = [f for f in schema.fields if _wanted(f, rules, only)]
    values = []
    for f in fields:
        if _is_map(f):
            continue
        value = _value(f, rules, render)
        # an earlier map yields to this value, so a key that is still there came later
        if dynamic is not None and any(_is_map(m) and _may_collide(m, field_of(f), rules) for m in fields):
            value = F.when(~F.map_contains_key(dynamic, field_of(f)), value)
        values.append((field_of(f), value))
    return values


def field_text(schema: T.StructType, rules: Rules, field: str) -> Column:
    """Text of one document field, read from just the columns that can produce it."""
    if field in rules.deny:
        return F.lit(None).cast("string")
    dynamic = dynamic_part(schema, rules, "text", only=(field,))
    plain = [_value(f, rules, "text") for f in schema.fields if not _is_map(f) and field_of(f) == field]
    found = ([] if dynamic is None else [F.try_element_at(dynamic, F.lit(field))]) + plain
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def source_columns(schema: T.StructType, rules: Rules, also: Sequence[str] = ()) -> list[str]:
    """Columns a build has to read: all but the denied plain ones."""
    return [f.name for f in schema.fields if _is_map(f) or field_of(f) not in rules.deny or f.name in also]


def with_doc_id(df: DataFrame, rules: Rules) -> DataFrame:
    """Source rows plus their ``doc_id``; null where the id field is absent."""
    if {"doc_id", _DYNAMIC} & set(df.columns):
        raise ValueError(f"the source has a column called doc_id or {_DYNAMIC}; use ``sheltered`` first")
    text = F.lit(None).cast("string") if rules.id_field is None \
        else field_text(df.schema, rules, rules.id_field)
    return df.withColumn("doc_id", text)


def _with_dynamic(rows: DataFrame, schema: T.StructType, rules: Rules, render: str,
                  only: Collection[str] | None = None) -> tuple[DataFrame, Column | None]:
    """Rows with the dynamic part as a column of its own, so it is computed once."""
    dynamic = dynamic_part(schema, rules, render, only)
    if dynamic is None:
        return rows, None
    return rows.withColumn(_DYNAMIC, dynamic), F.col(_DYNAMIC)


def _json_body(text: Column) -> Column:
    """What is between the braces; null for an empty object, so that joining skips it."""
    return F.when(text != "{}", F.substring(text, F.lit(2), F.length(text) - 2))


def render_documents(rows: DataFrame, schema: T.StructType, rules: Rules,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a ``doc_id`` to (doc_id, *keep, doc, doc_json).

    Meant to run after placement: shuffles then move source rows, not built documents.
    ``doc_json`` lists the static part and then the dynamic part, each in name order: same
    row, same bytes.  ``doc`` is the same document as a variant; a reader that needs only
    one of the two pays only for that one.
    """
    flat, dynamic = _with_dynamic(rows, schema, rules, "variant")
    fields = sorted(static_part(schema, rules, "variant", dynamic), key=lambda nv: nv[0])
    doc = F.to_variant_object(F.map_from_entries(_all_entries(fields, dynamic)))
    texts = {}
    if fields:
        texts["_static_json"] = F.to_json(F.struct(*[v.alias(n) for n, v in fields]))
    if dynamic is not None:
        texts["_dynamic_json"] = F.to_json(F.to_variant_object(dynamic))
    # the texts are columns of their own first, so that each is made once
    parts = flat.select("doc_id", *keep, doc.alias("doc"), *[c.alias(n) for n, c in texts.items()])
    if list(texts) == ["_static_json"]:
        doc_json = F.col("_static_json")
    else:
        bodies = [_json_body(F.col(n)) for n in texts]
        doc_json = F.concat(F.lit("{"), F.concat_ws(",", *bodies), F.lit("}"))
    return parts.select("doc_id", *keep, "doc", doc_json.alias("doc_json"))


def _all_entries(fields: Sequence[tuple[str, Column]], dynamic: Column | None) -> Column:
    none = F.array().cast("array<struct<key:string,value:variant>>")
    parts = [F.when(v.isNotNull(), F.array(F.struct(F.lit(n).alias("key"), v.alias("value"))))
             .otherwise(none) for n, v in fields]
    if dynamic is not None:
        parts.append(F.map_entries(dynamic))
    return F.concat(*parts) if parts else none


def build_documents(df: DataFrame, rules: Rules, keep: Sequence[str] = ()) -> DataFrame:
    """Documents of a table, one narrow pass."""
    df = sheltered(df)
    return render_documents(with_doc_id(df, rules), df.schema, rules, keep)


def render_fields(rows: DataFrame, schema: T.StructType, rules: Rules,
                  only: Collection[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a ``doc_id`` to (doc_id, *keep, field, terms); terms are null where absent."""
    flat, dynamic = _with_dynamic(rows, schema, rules, "terms", only)
    entries = [F.struct(F.lit(n).alias("key"), v.alias("value"))
               for n, v in static_part(schema, rules, "terms", dynamic, only)]
    parts = [F.array(*entries)] if entries else []
    if dynamic is not None:
        parts.append(F.map_entries(dynamic))
    if not parts:
        parts = [F.array().cast("array<struct<key:string,value:array<string>>>")]
    both = parts[0] if len(parts) == 1 else F.concat(*parts)
    return flat.select("doc_id", *keep, F.inline(both).alias("field", "terms"))


def render_terms(rows: DataFrame, schema: T.StructType, rules: Rules,
                 only: Collection[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a ``doc_id`` to the long form (doc_id, *keep, field, pos, term)."""
    # exploding drops the absent fields
    return render_fields(rows, schema, rules, only, keep).select(
        "doc_id", *keep, "field", F.posexplode("terms").alias("pos", "term"))


def document_terms(df: DataFrame, rules: Rules, only: Collection[str] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Long form of a table's documents, one row per exact term."""
    df = sheltered(df)
    return render_terms(with_doc_id(df, rules), df.schema, rules, only, keep)


def document_term_sets(df: DataFrame, rules: Rules, only: Collection[str] | None = None) -> DataFrame:
    """(doc_id, field, term), every term of a field once: repeats go inside the row."""
    df = sheltered(df)
    found = render_fields(with_doc_id(df, rules), df.schema, rules, only)
    return found.select("doc_id", "field", F.explode(F.array_distinct("terms")).alias("term"))


def cast_failures(df: DataFrame, rules: Rules) -> Column:
    """Names of the fields of a row whose override could not convert the value."""
    def failed(c: Column, dtype: T.DataType, name: Column, names: Collection[str]) -> Column:
        hit = F.lit(False)
        for target in ("long", "integer", "double"):
            fields = sorted(n for n in names if rules.overrides[n] == target)
            if fields:
                hit = hit | (name.isin(*fields) & cast_failed(c, dtype, target))
        return hit

    none = F.array().cast("array<string>")

    def failed_entries(f: T.StructField, names: Collection[str]) -> Column:
        bad = F.filter(_named_entries(f, rules, None), lambda e: failed(
            e["value"], f.dataType.valueType, e["key"], names))
        return F.coalesce(F.transform(bad, lambda e: e["key"]), none)

    found = [none]
    for f in df.schema.fields:
        if _is_map(f):
            if names := _reachable(f, rules.overrides):
                found.append(failed_entries(f, names))
        elif field_of(f) in rules.overrides and field_of(f) not in rules.deny:
            hit = failed(column_of(f), f.dataType, F.lit(field_of(f)), [field_of(f)])
            found.append(F.when(hit, F.array(F.lit(field_of(f)))).otherwise(none))
    return F.concat(*found)


def generated_ids(docs: DataFrame, keep: Sequence[str] = (), block: int = 4096) -> DataFrame:
    """Ids for documents that have none: content hash plus rank among equal documents.

    Hashes alone are counted first; a document whose hash is its own is number 0 at once
    and is not moved here.  Repeated documents (with equal ``keep`` values) are counted,
    combined on the map side, then fanned out again in blocks, so a document repeated
    billions of times fills neither a task nor an array.  A rerun gives the same ids.
    """
    same = ["doc_json", *keep]
    content = F.concat_ws("\u0000", *[F.col(c).cast("string") for c in same])
    nameless = docs.where(F.col("doc_id").isNull()).withColumn("_content", F.md5(content))
    repeated = stored(nameless.groupBy("_content").agg(F.count(F.lit(1)).alias("n"))
                      .where("n > 1").select("_content"), "repeated")
    doc = F.col("doc") if "doc" in docs.columns else F.parse_json("doc_json")
    single = nameless.join(repeated, "_content", "left_anti").select(
        F.concat("_content", F.lit("-0")).alias("doc_id"), *keep, doc.alias("doc"), "doc_json")
    counted = nameless.join(repeated, "_content", "left_semi").groupBy("_content", *same).agg(
        F.count(F.lit(1)).alias("_copies"))
    last_block = F.floor((F.col("_copies") - 1) / block).cast("bigint")
    blocks = counted.select("_content", *same, "_copies", F.explode(
        F.sequence(F.lit(0).cast("bigint"), last_block)).alias("_block"))
    spread = blocks.repartition("_content", "_block")
    first = F.col("_block") * block
    last = F.least(first + block, F.col("_copies")) - 1
    ranked = spread.select("_content", *same, F.explode(F.sequence(first, last)).alias("_rank"))
    many = ranked.select(
        F.concat("_content", F.lit("-"), F.col("_rank").cast("string")).alias("doc_id"), *keep,
        F.parse_json("doc_json").alias("doc"), "doc_json")
    return single.unionByName(many)
