"""Arguments of a build, and the field rules every document operator shares."""
from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping


@dataclass(frozen=True)
class Rules:
    """What to do with each field while rows become documents.

    ``deny`` and ``overrides`` are metadata (a few names per index); they are put into
    the plan as literals, so a denied plain column is not even read and a field without
    an override pays nothing for the override rules.
    """

    id_field: str | None = None
    deny: frozenset[str] = frozenset()
    overrides: Mapping[str, str] = field(default_factory=dict)
    # "compat" flattens and comma-splits array text, "typed" keeps elements whole
    arrays: str = "compat"
    # "fail" raises on a value an override cannot parse, "reject" leaves it out and
    # reports it through ``cast_failures``
    on_error: str = "fail"

    # plain fields that a map entry is known to share its name with; None: not known
    collisions: frozenset[str] | None = None

    def __post_init__(self):
        if self.arrays not in ("compat", "typed"):
            raise ValueError(f"arrays must be 'compat' or 'typed', not {self.arrays!r}")
        if self.on_error not in ("fail", "reject"):
            raise ValueError(f"on_error must be 'fail' or 'reject', not {self.on_error!r}")


@dataclass(frozen=True)
class BuildSpec:
    """Everything one index build needs."""

    table: str                      # catalog table name, or a Parquet path
    index_name: str                 # <base>_<yyyyMMdd>
    type_name: str = "datum"
    num_shards: int = 3
    where: str | None = None
    id_field: str | None = None
    routing: str | None = None      # source column; None routes by document id
    input_columns: tuple[str, ...] | None = None
    json_source: str | None = None  # string column holding one JSON object per row
    alias: str | None = None
    mapping: str | None = None      # explicit mapping JSON, wins over the inferred one
    final_settings: Mapping[str, str] = field(default_factory=dict)
    index_fields: tuple[str, ...] | None = None
    index_source_columns: tuple[str, ...] | None = None
    theme: str = "test"
    work_dir: str = ""              # required: a folder that every executor reaches
    dedupe: str | None = "global"   # "global", "segment" or None (ids known unique)
    order_by: tuple[str, ...] = ()  # which of several rows with one id comes first
    segment_docs: int = 1_000_000   # segments per shard follow from this target
    partition_multiples: int | None = None  # fixed segments per shard instead
    postings_block: int = 65_536
    bulk: bool = False              # also store bulk request bodies of the documents
    bulk_actions: int = 100
    bulk_bytes: int = 5 * 1024 * 1024
    arrays: str = "compat"
    compat: bool = True             # False: all source types get index types
    on_error: str = "fail"
    keep_rejects: bool = True
    # partition column of the source: map fields are kept per partition, and a later version
    # reads only partitions that are new or have changed
    facts_by: str | None = None
    clean_first: bool = False       # drop the index folder, older generations too, before the build

    def __post_init__(self):
        if self.num_shards < 1:
            raise ValueError("num_shards must be positive")
        if not self.work_dir:
            raise ValueError("work_dir is needed: a folder that every executor reaches")
        if self.dedupe not in ("global", "segment", None):
            raise ValueError("dedupe must be 'global', 'segment' or None")
        if self.dedupe and self.id_field and not self.order_by:
            raise ValueError("dedupe needs order_by, so that the first row of an id is defined")

    @property
    def index_path(self) -> str:
        return f"{self.work_dir.rstrip('/')}/{self.index_name}"

    @property
    def ledger_path(self) -> str:
        return f"{self.work_dir.rstrip('/')}/_builds/ledger"

    @property
    def snapshot_date(self) -> str:
        return self.index_name.rsplit("_", 1)[-1]
