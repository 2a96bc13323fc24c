"""A whole index build: table in; documents, mapping, postings and manifest out.

Layout below ``<work_dir>/<index_name>``::

    fields/generation=<g>/        discovered field facts
    indexed/generation=<g>/       names of the indexed fields
    mapping/generation=<g>/       mapping JSON
    docs/generation=<g>/shard=/segment=/    documents
    postings/generation=<g>/      exact-term posting blocks
    rejects/generation=<g>/       refused rows, with their values
    bulk/generation=<g>/          bulk request bodies, if asked for
    claims/                       a marker for every generation that a writer has taken
    manifest/                     segment lists and counts of refused rows; written last,
                                  makes a generation visible
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from shardloom.operators.discovery import discover_fields
from shardloom.operators.documents import (
    cast_failures, generated_ids, render_documents, source_columns, with_doc_id,
)
from shardloom.operators.mapping import (
    explicit_fields, indexed_fields, infer_mapping, mapping_json,
)
from shardloom.operators.postings import postings
from shardloom.operators.segments import segment_manifest
from shardloom.operators.sharding import (
    bulk_bodies, colocate, dedupe_first, rows_but_first, scope_keys, with_segment, with_shard,
)
from shardloom.plans.facts import incremental_fields
from shardloom.session import prepare, stored as stored_rows
from shardloom.sinks.files import (
    MANIFEST_SCHEMA, append_state, bulk_lines, claim_generation, commit_manifest, commit_refused, delete_path, write_mapping,
    write_sharded,
)
from shardloom.sources.columns import column_named, column_of, field_of, is_exact, row_hash, row_json, sheltered
from shardloom.sources.side_tables import deny_list, load_rules, type_overrides
from shardloom.sources.tables import json_fields, scan
from shardloom.spec import BuildSpec, Rules

@dataclass(frozen=True)
class BuildResult:
    index: str
    generation: int
    docs_path: str
    postings_path: str | None
    rejects_path: str | None
    mapping_path: str
    manifest_path: str
    segments: tuple[int, ...]
    bulk_path: str | None = None


MALFORMED = "_malformed"
REASONS = ("repeated id", "cast", "malformed json")  # why a row can be refused


def source_rows(spark: SparkSession, spec: BuildSpec) -> DataFrame:
    """The selected rows under column names that clash with nothing; with a JSON source also
    ``_malformed``, its text where that is no JSON object."""
    df = sheltered(scan(spark, spec.table, spec.where, spec.input_columns))
    if not spec.json_source:
        return df
    return json_fields(df, column_named(df.schema, spec.json_source), malformed=MALFORMED)


def build_rules(spec: BuildSpec, fields: DataFrame, deny: DataFrame | None = None,
                overrides: DataFrame | None = None) -> Rules:
    base = Rules(id_field=spec.id_field, arrays=spec.arrays, on_error=spec.on_error)
    dt = spec.snapshot_date
    rules = load_rules(
        base, None if deny is None else deny_list(deny, spec.theme, dt),
        None if overrides is None else type_overrides(overrides, dt), fields)
    # at most a row per plain column
    both = fields.where("is_plain").select("field").join(
        fields.where("not is_plain").select("field"), "field", "left_semi")
    return replace(rules, collisions=frozenset(r["field"] for r in both.collect()))


@dataclass(frozen=True)
class Sizes:
    """What one pass over the ids tells: segments per shard, rows with and without an id."""

    segments: tuple[int, ...]
    named: int
    nameless: int


def shard_sizes(ids: DataFrame, spec: BuildSpec) -> Sizes:
    """Size the segments from (shard, doc_id), a pass over the id columns alone.

    At most one row per shard comes back.  Distinct ids are estimated: repeated rows of a
    hot id must not inflate a shard, and the estimate only sizes segments.  Where their
    number is given the rows are just counted.
    """
    if spec.partition_multiples:
        found = ids.agg(F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("n")).first()
        return Sizes((spec.partition_multiples,) * spec.num_shards, found["named"], found["n"] - found["named"])
    rows = ids.groupBy("shard").agg(
        F.approx_count_distinct("doc_id").alias("docs"), F.count("doc_id").alias("named"),
        F.count_if(F.col("doc_id").isNull()).alias("nameless")).collect()
    docs = {r["shard"]: r["docs"] for r in rows}
    named, nameless = sum(r["named"] for r in rows), sum(r["nameless"] for r in rows)
    # rows without an id are spread over all shards by their content
    extra = -(-nameless // spec.num_shards)
    counts = [max(1, -(-(docs.get(s, 0) + extra) // spec.segment_docs))
              for s in range(spec.num_shards)]
    return Sizes(tuple(counts), named, nameless)


def _sharded(rows: DataFrame, spec: BuildSpec) -> DataFrame:
    return with_shard(rows, spec.num_shards, F.col(spec.routing) if spec.routing else None)


def _in_scope(rows: DataFrame, spec: BuildSpec, counts: Sequence[int]) -> DataFrame:
    """Rows with an id, with their segment where an id may come once in each."""
    named = rows.where(F.col("doc_id").isNotNull())
    return with_segment(_sharded(named, spec), counts) if spec.dedupe == "segment" else named


def first_rows(rows: DataFrame, schema: T.StructType, spec: BuildSpec, counts: Sequence[int]) -> DataFrame:
    """Rows with an id, first of each id.

    Rows that tie in ``order_by`` are told apart by all their values, so a retry keeps the same.
    """
    named = _in_scope(rows, spec, counts)
    if not (spec.dedupe and spec.id_field):
        return named
    rest = T.StructType([f for f in schema.fields if f.name not in spec.order_by or not is_exact(f)])
    tied = named.withColumn("_tie", row_hash(rest))
    return dedupe_first(tied, (*spec.order_by, "_tie"), spec.dedupe).drop("_tie")


def repeated_rows(rows: DataFrame, firsts: DataFrame, schema: T.StructType, spec: BuildSpec,
                  counts: Sequence[int]) -> DataFrame:
    """Rejects of the rows that are not the first of their id."""
    keys = scope_keys(spec.dedupe)
    whole = row_json(schema).alias("row")
    if all(map(is_exact, schema.fields)):  # the text is made of what is left alone
        found = rows_but_first(_in_scope(rows, spec, counts), firsts, [*keys, *schema.names])
        found = found.select("doc_id", "refused", whole)
    else:
        found = rows_but_first(_in_scope(rows, spec, counts).select(*keys, whole), firsts.select(*keys, whole),
                               [*keys, "row"])
    return found.select("doc_id", F.lit("repeated id").alias("reason"),
                        F.lit(None).cast("array<string>").alias("fields"), "refused", "row")


def build_index(spark: SparkSession, spec: BuildSpec, deny: DataFrame | None = None,
                overrides: DataFrame | None = None, with_postings: bool = True,
                ledger: bool = True) -> BuildResult:
    """Build one index version; any error fails the build and leaves no manifest rows."""
    prepare(spark)
    root = spec.index_path

    def state(name: str) -> None:
        if ledger:
            append_state(spark, spec.ledger_path, spec.index_name, name, spec.num_shards,
                         spec.type_name, spec.work_dir)

    if spec.clean_first:
        delete_path(spark, root)
    state("deleted")  # whatever an earlier build of this index recorded no longer counts
    source = source_rows(spark, spec)
    spec = replace(spec, order_by=tuple(column_named(source.schema, c) for c in spec.order_by),
                   routing=spec.routing and column_named(source.schema, spec.routing))
    # one discovery pass over the map columns; everything after it reads this small table
    manifest_path = f"{root}/manifest"
    generation = claim_generation(spark, manifest_path)
    fields_path = f"{root}/fields/generation={generation}"
    found = incremental_fields(spark, spec, source.drop(MALFORMED), source_rows)[0] if spec.facts_by \
        else discover_fields(source.drop(MALFORMED))
    found.write.mode("overwrite").parquet(fields_path)
    fields = spark.read.parquet(fields_path)
    rules = build_rules(spec, fields, deny, overrides)
    mapping = infer_mapping(
        fields, None if overrides is None else type_overrides(overrides, spec.snapshot_date),
        explicit_fields(spark, spec.mapping) if spec.mapping else None,
        spec.index_fields, spec.index_source_columns, spec.compat)
    mapping_path = f"{root}/mapping/generation={generation}"
    write_mapping(mapping_json(mapping), mapping_path)
    state("started")

    extra = [c for c in (*spec.order_by, spec.routing or "") if c]
    wanted = source.select(*source_columns(source.drop(MALFORMED).schema, rules, extra),
                           *[c for c in source.columns if c == MALFORMED])
    schema: T.StructType = wanted.drop(MALFORMED).schema
    rows = with_doc_id(wanted, rules)
    rejected = []
    if MALFORMED in wanted.columns:
        parsed = [column_of(f).alias(field_of(f)) for f in schema.fields if field_of(f) != spec.json_source]
        rejected.append(rows.where(F.col(MALFORMED).isNotNull()).select(
            "doc_id", F.lit("malformed json").alias("reason"), F.array(F.lit(spec.json_source)).alias("fields"),
            F.lit(1).cast("bigint").alias("refused"),
            F.to_json(F.struct(*parsed, F.col(MALFORMED).alias(spec.json_source))).alias("row")))
        rows = rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    if spec.on_error == "reject" and rules.overrides:
        rows = rows.withColumn("_bad", cast_failures(wanted.select(*schema.names), rules))
        rejected.append(rows.where("size(_bad) > 0").select(
            "doc_id", F.lit("cast").alias("reason"), F.col("_bad").alias("fields"),
            F.lit(1).cast("bigint").alias("refused"), row_json(schema).alias("row")))
        rows = rows.where("size(_bad) = 0").drop("_bad")
    sizes = shard_sizes(_sharded(rows, spec).select("shard", "doc_id"), spec)

    docs_path = f"{root}/docs/generation={generation}"
    firsts = first_rows(rows, schema, spec, sizes.segments)
    if spec.dedupe and spec.id_field and spec.keep_rejects and all(map(is_exact, schema.fields)):
        firsts = stored_rows(firsts, "firsts")  # read twice: for the documents and for the rejects
    placed = colocate(with_segment(_sharded(firsts, spec), sizes.segments), sizes.segments, spec.num_shards)
    if sizes.nameless:
        docs = _with_generated(rows, placed, schema, rules, spec, sizes.segments)
    else:
        docs = render_documents(placed, schema, rules, ["shard", "segment", "slot"])
    write_sharded(docs, docs_path)
    empty = not has_rows(spark, docs_path)
    if empty:  # an empty segment: the folder keeps its schema
        spark.createDataFrame([], "doc_id string, doc_json string").write.mode("overwrite") \
            .parquet(f"{docs_path}/shard=0/segment=0")

    bundles = stored_bundles(spark, docs_path)
    stored = bundles.agg(F.sum("docs").alias("n")).first()["n"] or 0
    refused = sizes.named + sizes.nameless - stored
    if spec.dedupe and spec.id_field and spec.keep_rejects and refused:
        rejected.append(repeated_rows(rows, firsts, schema, spec, sizes.segments))
    rejects_path = None
    counted = {"repeated id": refused} if spec.dedupe and refused else {}
    if rejected:
        rejects_path = f"{root}/rejects/generation={generation}"
        whole = rejected[0]
        for more in rejected[1:]:
            whole = whole.unionByName(more)
        seen = Observation("refused")  # counted by the pass that stores the rows
        whole.observe(seen, *[F.sum(F.when(F.col("reason") == r, F.col("refused")).otherwise(0)).alias(r) for r in REASONS]) \
            .write.mode("overwrite").parquet(rejects_path)
        counted |= {reason: n for reason, n in seen.get.items() if n}

    postings_path = None
    if with_postings:
        postings_path = f"{root}/postings/generation={generation}"
        indexed_path = f"{root}/indexed/generation={generation}"
        indexed_fields(mapping).write.mode("overwrite").parquet(indexed_path)
        terms = stored_terms(spark, docs_path, spark.read.parquet(indexed_path))
        blocks = postings(terms, spec.postings_block)
        colocate(blocks, sizes.segments, spec.num_shards) \
            .sortWithinPartitions("shard", "segment", "field", "term", "block") \
            .drop("slot").write.mode("overwrite").partitionBy("shard", "segment").parquet(postings_path)

    bulk_path = None
    if spec.bulk:
        bulk_path = f"{root}/bulk/generation={generation}"
        lines = spark.read.parquet(docs_path).select(
            "doc_id", "shard", "segment", bulk_lines(F.col("doc_id"), F.col("doc_json")).alias("line"))
        bulk_bodies(colocate(lines, sizes.segments, spec.num_shards), spec.bulk_actions, spec.bulk_bytes) \
            .write.mode("overwrite").parquet(bulk_path)

    if empty:
        segments = spark.createDataFrame(
            [(0, 0, "", 0, 0, 0, 0, 0, generation, docs_path, None, None)], MANIFEST_SCHEMA)
    else:
        segments = segment_manifest(bundles, generation).withColumn("path", F.lit(docs_path))
    commit_manifest(commit_refused(segments, counted), manifest_path)
    state("completed")
    return BuildResult(spec.index_name, generation, docs_path, postings_path, rejects_path,
                       mapping_path, manifest_path, sizes.segments, bulk_path)


def _with_generated(rows: DataFrame, placed: DataFrame, schema: T.StructType, rules: Rules,
                    spec: BuildSpec, counts: Sequence[int]) -> DataFrame:
    """Documents with and without an id of their own, together per segment."""
    named = render_documents(placed, schema, rules, ["shard", "segment"])
    kept = [spec.routing] if spec.routing else []
    nameless = render_documents(rows.where(F.col("doc_id").isNull()), schema, rules, kept)
    new = with_segment(_sharded(generated_ids(nameless, kept), spec), counts)
    both = named.unionByName(new.select(*named.columns))
    return colocate(both, counts, spec.num_shards)


def has_rows(spark: SparkSession, docs_path: str) -> bool:
    """Whether any document was written; a write without rows leaves no file to infer from."""
    schema = "doc_id string, doc_json string, shard int, segment int"
    return not spark.read.schema(schema).parquet(docs_path).isEmpty()


def stored_bundles(spark: SparkSession, docs_path: str) -> DataFrame:
    """(shard, segment, docs, deleted) of what was written; reads no column.

    A segment is one file: two would mean that its documents met in no single task.
    """
    files = F.count_distinct(F.col("_metadata.file_name"))
    found = spark.read.parquet(docs_path).groupBy("shard", "segment").agg(
        F.count(F.lit(1)).alias("docs"), files.alias("files"))
    docs = F.when(F.col("files") == 1, F.col("docs")).otherwise(
        F.raise_error(F.lit("a segment was stored in more than one file")).cast("bigint"))
    return found.select("shard", "segment", docs.alias("docs"),
                        F.lit(0).cast("bigint").alias("deleted"))


def stored_terms(spark: SparkSession, docs_path: str, indexed: DataFrame) -> DataFrame:
    """(shard, segment, ord, field, term) of stored documents, of the fields in ``indexed``.

    A segment is one file in id order, so a document's ordinal is its row number in the
    file: no window, no shuffle.  In the stored JSON a value in brackets is an array; any
    such text was turned into one when the document was built.
    """
    shape = "map<string,string>"
    whole = F.coalesce(F.from_json("doc_json", shape), F.raise_error(
        F.concat(F.lit("stored document is no JSON object: "), F.col("doc_id"))).cast(shape))
    stored = spark.read.parquet(docs_path).select(
        "shard", "segment", F.col("_metadata.row_index").alias("ord"), F.explode(whole).alias("field", "text"))
    wanted = stored.join(indexed, "field", "left_semi")
    is_array = F.startswith("text", F.lit("[")) & F.endswith("text", F.lit("]"))
    terms = F.when(is_array, F.from_json("text", "array<string>")).otherwise(F.array("text"))
    return wanted.select("shard", "segment", "ord", "field", F.explode(terms).alias("term"))
