"""Prefix trie of conversations with a depth-band rollup.

A conversation is rebuilt from the first turns of its century's head and its own later
turns; every distinct sequence of first turns is a node.  Texts never move: a turn is its
SHA-256 and its length.  A prefix is known by four running sums of 32-bit pieces of the
SHA-256 of (place, turn), so that all prefixes of a conversation, however long, come from
running sums; these are taken in parts of bounded size and then shifted by the sums of the
parts before, so no conversation has to fit in a task.

Subtree totals are rolled up by bands of ``HEIGHT`` depths.  A node explodes only to its
ancestors in its own band (at most ``HEIGHT`` rows).  What arrives at the band roots is a
trie ``HEIGHT`` times less deep, which is rolled up in the same way; its completed totals
then explode to the ancestors in the band above.  Rounds grow with the logarithm of the
depth, and every explosion is bounded.  The ancestors of a node are read off the prefixes
of its smallest conversation.

The hash of the ids that end at a node is taken over sorted chunks of ``CHUNK`` ids, so a
node where very many conversations end streams a few rows through one task.

Defined cases: a null turn comes first; turns of equal number are ordered by the SHA-256 of
their role and text; a null role or text is empty; rows repeated in full are turns of their
own; a row without ``conv_id`` belongs to no conversation; a century is
``conv_id - pmod(conv_id, 100)``; very long texts and conversations are read whole; an
empty table has no nodes; other columns are not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import modest_batches, stored, table

HEIGHT = 16
CHUNK = 4096
PART = 1024  # turns whose running sums are taken together
SUMS = ["s0", "s1", "s2", "s3"]


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv, place, turn, size``: each turn with its place from 1, its digest and length.

    Rows are dealt by ranges of (conversation, turn), so that a conversation may span many
    tasks; a place is the rank in the range plus the rows of the ranges before.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("number"),
        F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256).alias("turn"), F.length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"))
    order = ["number", "turn", "row"]
    rows = stored(rows, "turns").repartitionByRange("conv", *order)
    rows = stored(rows.withColumn("part", F.spark_partition_id()), "dealt")
    inside = Window.partitionBy("conv", "part").orderBy(*order)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
             .select("conv", "part", F.sum("n").over(before).alias("base")).filter("base is not null"))
    return (rows.withColumn("place", F.row_number().over(inside).cast("long")).join(stored(bases, "bases"), ["conv", "part"], "left")
            .select("conv", (F.col("place") + F.coalesce("base", F.lit(0))).alias("place"), "turn", "size"))


def _head(conv: str = "conv") -> Column:
    return F.crc32(F.col(conv).cast("string")) % 6


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv, place, turn, size`` of the rebuilt conversations; one without turns has none."""
    turns = stored(_turns(conversations), "places")
    convs = turns.filter("place = 1").select("conv", (F.col("conv") - F.pmod("conv", F.lit(100))).alias("head"), _head().alias("h"))
    first = turns.filter("place <= 5").select(F.col("conv").alias("head"), "place", "turn", "size")
    given = stored(convs.join(first, "head").filter("place <= h").select("conv", "place", "turn", "size"), "given")
    lengths = stored(given.groupBy("conv").agg(F.count("*").alias("n")), "lengths")
    own = turns.withColumn("h", _head()).filter("place > h").join(lengths, "conv", "left").select(
        "conv", (F.col("place") - F.col("h") + F.coalesce("n", F.lit(0))).alias("place"), "turn", "size")
    return stored(given.unionByName(own), "rebuilt")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, key, parent, size``: every prefix of every conversation with a turn."""
    mixed = F.sha2(F.concat_ws(" ", "place", "turn"), 256)
    pieces = [F.conv(F.substring("mixed", 8 * i + 1, 8), 16, 10).cast("long").alias(s) for i, s in enumerate(SUMS)]
    rows = turns.select("conv", "place", "size", mixed.alias("mixed"), F.floor((F.col("place") - 1) / PART).alias("part"))
    rows = rows.select("conv", "place", "size", "part", *pieces)
    inside = Window.partitionBy("conv", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.join(rows.filter("part = 1").select("conv").distinct(), "conv", "left_semi")  # the long ones
              .groupBy("conv", "part").agg(*[F.sum(s).alias(s) for s in SUMS])
              .select("conv", "part", *[F.sum(s).over(before).alias(f"b{s}") for s in SUMS]).filter("bs0 is not null"))
    summed = (rows.withColumns({s: F.sum(s).over(inside) for s in SUMS}).join(stored(totals, "parts"), ["conv", "part"], "left")
              .withColumns({s: F.col(s) + F.coalesce(f"b{s}", F.lit(0)) for s in SUMS}))
    return summed.select("conv", F.col("place").alias("depth"), F.unhex(F.md5(F.concat_ws(" ", "place", *SUMS))).alias("key"), "size")


def _within(nodes: DataFrame, steps: DataFrame, band: Column, height: int) -> DataFrame:
    """``key, leaves, saved``: what ``nodes`` add up to at the prefixes of their conversation
    in ``band``; above them, or themselves."""
    found = steps.withColumn("band", F.floor(F.col("depth") / height)).select(
        "conv", "band", F.col("depth").alias("above"), F.col("key").alias("at"))
    met = nodes.withColumn("band", band).join(found, ["conv", "band"]).filter("above <= depth")
    return met.groupBy(F.col("at").alias("key")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rolled_up(nodes: DataFrame, steps: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``key, leaves, saved``: the sums of ``nodes`` (``key, conv, depth, leaves, saved``)
    over each subtree; ``steps`` (``conv, depth, key``) hold the prefixes of each ``conv``."""
    own = F.floor(F.col("depth") / height)
    inner = stored(_within(nodes, steps, own, height), "inner")
    if nodes.filter(F.col("depth") >= height).isEmpty():
        return inner
    tops = nodes.filter(F.col("depth") % height == 0).select("key", "conv", own.alias("depth")).join(inner, "key")
    tops = stored(tops, "tops")
    higher = stored(steps.filter(F.col("depth") % height == 0).select("conv", own.alias("depth"), "key"), "higher")
    done = rolled_up(tops, higher, height)
    sent = tops.drop("leaves", "saved").filter("depth > 0").join(done, "key").withColumn("depth", F.col("depth") * height)
    outer = _within(sent, steps, own - 1, height)
    return stored(inner.unionByName(outer).groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")


def _ends(last: DataFrame, chunk: int) -> DataFrame:
    """``key, ends_sha256`` of the conversations ``conv`` that end at ``key``."""
    modest_batches(last.sparkSession)

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            key, conv = batch["key"], batch["conv"]
            new = (key != key.shift()).cumsum()
            rank = conv.groupby(new).cumcount() // chunk
            by = [new, rank]
            yield pd.DataFrame({"key": key.groupby(by).first().to_numpy(), "first": conv.groupby(by).first().to_numpy(),
                                "ids": conv.astype(str).groupby(by).agg(",".join).to_numpy()})

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch["key"], batch["ids"]):
                if key == held:
                    state.update(b"," + ids.encode())
                    continue
                if held is not None:
                    out.append((held, state.hexdigest()))
                held, state = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if held is not None:
            yield pd.DataFrame([(held, state.hexdigest())], columns=["key", "ends_sha256"])

    cut = last.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInPandas(chunks, "key binary, first long, ids string")
    cut = stored(cut, "chunks").repartition("key").sortWithinPartitions("key", "first")
    return stored(cut.mapInPandas(hashes, "key binary, ends_sha256 string"), "ends")


def trie(conversations: DataFrame, height: int = HEIGHT, chunk: int = CHUNK) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations."""
    all_convs = stored(conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv")).distinct(), "convs")
    roots = all_convs.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.md5(F.lit(""))).alias("key"), F.lit(0).cast("long").alias("size"))
    steps = stored(prefixes(rebuilt(conversations)).unionByName(roots), "steps")
    counted = stored(steps.groupBy("key").agg(
        F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.first("size").alias("size")), "counted")
    above = steps.select("conv", (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"))
    nodes = stored(counted.join(above, ["conv", "depth"], "left"), "nodes")
    children = stored(nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")), "children")
    worth = stored(nodes.join(children, "key", "left").select(
        "key", "conv", "depth", F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved")), "worth")
    totals = rolled_up(worth, steps.select("conv", "depth", "key"), height)
    last = steps.groupBy("conv").agg(F.max_by("key", "depth").alias("key")).select("key", "conv")
    parents = nodes.join(children.select("key"), "key").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    joined = (nodes.join(children, "key", "left").join(totals, "key").join(_ends(last, chunk), "key", "left")
              .join(stored(parents, "parents"), "parent", "left"))
    none = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def trie_query(spark, sf_dir):
    """op13: the nodes of the trie of all ``conversations``."""
    return trie(table(spark, sf_dir, "conversations"))


# The twin names a prefix by its turns and adds up subtrees over all ancestors of a node.
TRIE_SQL = """
WITH turns AS (SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, '')))) AS place FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT c, list(turn ORDER BY place) AS own FROM turns GROUP BY c),
heads AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, b: xor(crc >> 8, list_reduce(list_prepend(xor(crc, b) & 255, range(8)),
        lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1)))))) % 6 AS h FROM lists),
whole AS (SELECT a.c, list_concat(coalesce(list_slice(b.own, 1, a.h), []), coalesce(list_slice(a.own, a.h + 1, len(a.own)), [])) AS turns
    FROM heads a LEFT JOIN lists b ON b.c = a.c - (a.c % 100 + 100) % 100),
steps AS (SELECT c, len(turns) AS size, turns, unnest(range(0, len(turns) + 1)) AS depth FROM whole),
paths AS (SELECT c, depth, size, list_slice(turns, 1, depth) AS path FROM steps),
ends AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM paths WHERE depth = size GROUP BY path),
nodes AS (SELECT path, any_value(depth) AS depth, min(c) AS c, count(*) AS n FROM paths GROUP BY path),
parents AS (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1),
worth AS (SELECT path, depth, (children IS NULL)::BIGINT AS leaf, (n - 1) * coalesce(length(path[-1].text), 0) AS saved
    FROM nodes LEFT JOIN parents USING (path)),
up AS (SELECT list_slice(path, 1, k) AS path, leaf, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM worth)),
sums AS (SELECT path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY path)
SELECT n.c AS conv_id, n.depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(children, 0) AS n_children, n_leaves, saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN parents USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = list_slice(n.path, 1, n.depth - 1)
"""
