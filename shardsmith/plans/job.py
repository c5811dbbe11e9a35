"""Command-line build job.

    spark-submit -m shardsmith.plans.job <input> <dest> <shards> <template> <index> <type>
        [--format json|text] [--id-field F] [--routing-field F] [--seq-field F]
        [--target-file-mb N] [--keep-staging] [--upsert]

Same six positional arguments as the original job: input lines (any Hadoop
path or glob; compression by suffix), destination root, shard count, mapping
template path, index name and type name (which must be a type of the
template).  Prints one JSON line with the committed generation and counts.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from shardsmith.operators.documents import documents_from_lines
from shardsmith.plans.build import IndexSpec, build_index, upsert
from shardsmith.session import get_spark
from shardsmith.sources.lines import read_lines
from shardsmith.sources.template import load_template


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="shardsmith-build")
    p.add_argument("input")
    p.add_argument("dest")
    p.add_argument("shards", type=int)
    p.add_argument("template")
    p.add_argument("index")
    p.add_argument("type")
    p.add_argument("--format", default="json", choices=["json", "text"])
    p.add_argument("--id-field")
    p.add_argument("--routing-field")
    p.add_argument("--seq-field")
    p.add_argument("--target-file-mb", type=int, default=1024)
    p.add_argument("--keep-staging", action="store_true")
    p.add_argument("--upsert", action="store_true", help="apply the input to the existing index instead of building")
    p.add_argument("--master")
    a = p.parse_args(argv)
    if a.shards < 1:
        p.error("shards must be >= 1")
    return a


def run(spark, a: argparse.Namespace) -> dict:
    mapping = load_template(spark, a.template, a.type)
    pattern = mapping.index_pattern
    if pattern not in ("*", a.index) and not (pattern.endswith("*") and a.index.startswith(pattern[:-1])):
        raise ValueError(f"index {a.index!r} does not match the template pattern {pattern!r}")
    if a.format == "text" and "value" not in mapping.field_names:
        mapping = None  # plain text becomes {"value": line}; nothing in the mapping to check it against
    spec = IndexSpec(
        a.index, a.shards, type_name=a.type, mapping=mapping, target_file_bytes=a.target_file_mb * 1024 * 1024
    )
    docs = documents_from_lines(
        read_lines(spark, a.input), fmt=a.format, id_field=a.id_field, routing_field=a.routing_field, seq_field=a.seq_field
    )
    if a.id_field is None:
        spec.dedup = False  # generated ids: equal lines stay separate documents
    t = time.time()
    spec.keep_staging = a.keep_staging
    res = upsert(spark, docs, a.dest, spec) if a.upsert else build_index(spark, docs, a.dest, spec)
    snap = res.metrics["snapshot"]
    return {
        "index": a.index,
        "generation": res.generation,
        "shards": a.shards,
        "scanned": res.metrics["scanned"],
        "docs": snap["docs"],
        "rejects": snap["rejects"],
        "bytes": snap["bytes"],
        "seconds": round(time.time() - t, 3),
    }


def main(argv: list[str] | None = None) -> int:
    a = parse_args(sys.argv[1:] if argv is None else argv)
    spark = get_spark(a.master)
    print(json.dumps(run(spark, a)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
