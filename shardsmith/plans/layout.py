"""Where a published index lives.

    <dest>/indices/<index>/data/gen=<g>/_shard=<k>/part-*.parquet   shard files
    <dest>/indices/<index>/manifest/gen=<g>/                         n rows, one per shard
    <dest>/indices/<index>/files/gen=<g>/                            a row for each data file (plans/files.py)
    <dest>/indices/<index>/masks/gen=<g>/_shard=<k>/                 bitmaps of the rows that updates replaced
    <dest>/indices/<index>/ingest/gen=<g>/_status=rejected/          refused documents
    <dest>/snapshots/<index>/commit-<n>.json                         one row; commits a generation (plans/commits.py)
    <dest>/aliases/                                                  alias rows

A generation is never modified after it is written; a rebuild or upsert
writes a new one, and the snapshot row (written last) is what makes it
visible.  Generation ids sort by creation time.
"""

from __future__ import annotations

import datetime as _dt
import uuid


def new_generation() -> str:
    return f"{generation_at(_dt.datetime.now(_dt.timezone.utc))}{uuid.uuid4().hex[:6]}"


def generation_at(time: _dt.datetime) -> str:
    """What the ids of generations begun at ``time`` (UTC) start with; older ones sort before it."""
    return f"g{time:%Y%m%dT%H%M%S%f}"


def snapshot_name(index: str) -> str:
    """One naming rule for snapshots, used by build and restore alike."""
    return f"snapshot_{index}"


def index_root(dest: str, index: str) -> str:
    return f"{dest.rstrip('/')}/indices/{index}"


def data_root(dest: str, index: str) -> str:
    return f"{index_root(dest, index)}/data"


def data_path(dest: str, index: str, gen: str) -> str:
    return f"{data_root(dest, index)}/gen={gen}"


def shard_path(dest: str, index: str, gen: str, shard: int) -> str:
    return f"{data_path(dest, index, gen)}/_shard={shard}"


def files_root(dest: str, index: str) -> str:
    return f"{index_root(dest, index)}/files"


def files_path(dest: str, index: str, gen: str) -> str:
    return f"{files_root(dest, index)}/gen={gen}"


def masks_root(dest: str, index: str) -> str:
    return f"{index_root(dest, index)}/masks"


def masks_path(dest: str, index: str, gen: str) -> str:
    return f"{masks_root(dest, index)}/gen={gen}"


def manifest_path(dest: str, index: str, gen: str) -> str:
    return f"{index_root(dest, index)}/manifest/gen={gen}"


def snapshots_root(dest: str, index: str) -> str:
    return f"{dest.rstrip('/')}/snapshots/{index}"


def aliases_root(dest: str) -> str:
    return f"{dest.rstrip('/')}/aliases"
