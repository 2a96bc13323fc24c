"""The document pipeline: every stage works on all that the stage before it kept."""
from __future__ import annotations

from shardloom.llm.common import stored, table
from shardloom.llm.exact_dedup import drop_copies
from shardloom.llm.near_copies import drop_near
from shardloom.llm.packing import pack
from shardloom.llm.quality import keep_good
from shardloom.llm.suffixes import drop_repeats

ORACLE_SQL = None  # a trained classifier and suffix matching are beyond SQL


def quality(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def copies(spark, docs, sf_dir):
    """Of equal texts the row with the largest id stays."""
    return drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of each group of near copies (five words, Jaccard 0.8) the row with the smallest id stays."""
    return drop_near(docs)


def passages(spark, docs, sf_dir):
    """Later occurrences of repeated passages are cut out."""
    return drop_repeats(docs)


def packing(spark, docs, sf_dir):
    """What is left, as pieces of sequences."""
    return pack(docs, most=150_000)  # the stages before have left their memory in use


STAGES = [("quality", quality), ("exact_dedup", copies), ("near_dedup", near_copies),
          ("repeated_passages", passages), ("packing", packing)]


def run(spark, sf_dir):
    """The rows of the last stage over all ``documents``; every stage's rows are stored."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
