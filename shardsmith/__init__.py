"""Offline sharded index builder on Spark DataFrames.

The names below are the public API; see README.md for the operator map.
"""

from shardsmith.functions.hashing import djb2_hash, hash_bucket  # noqa: F401
from shardsmith.functions.jsonfn import compact_json, is_json_object  # noqa: F401
from shardsmith.operators.dedup import assign_bulks, bulk_summary, latest_by_id  # noqa: F401
from shardsmith.operators.documents import (  # noqa: F401
    documents_from_columns,
    documents_from_lines,
    documents_from_table,
    envelope,
    text_document,
)
from shardsmith.operators.report import (  # noqa: F401
    largest_shard,
    reject_summary,
    shard_bytes,
    shard_counts,
    term_stats,
)
from shardsmith.operators.routing import (  # noqa: F401
    assign_shards,
    route_lookup,
    route_table,
    shard_grid,
    shard_partition,
    shard_skew,
)
from shardsmith.operators.search import exists, get_by_id, multi_get, range_, search, term  # noqa: F401
from shardsmith.operators.validate import rejects, typed_projection, validate  # noqa: F401
from shardsmith.plans.alias import add_alias, resolve_alias, resolve_aliases  # noqa: F401
from shardsmith.plans.read import lookup, open_index  # noqa: F401
from shardsmith.plans.build import (  # noqa: F401
    IndexSpec,
    build_index,
    compact_index,
    list_snapshots,
    read_manifest,
    restore_snapshot,
    upsert,
    verify_snapshot,
)
from shardsmith.session import get_spark, shared_dir  # noqa: F401
from shardsmith.sources.lines import read_lines, source_label, with_source_label  # noqa: F401
from shardsmith.sources.tables import read_table, spread_narrow  # noqa: F401
from shardsmith.sources.template import load_template, mapping_from_schema, parse_template  # noqa: F401
