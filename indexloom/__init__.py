"""Document indexing and batch full-text search as Spark DataFrame jobs."""

from indexloom.config import Computed, Entity, Relation, Settings
from indexloom.plans.index import build_index, merge_segments, rebuild_index, upsert_index
from indexloom.plans.search import SearchOptions, multi_search, search
from indexloom.sources.store import open_index, remove_superseded, workspace

__all__ = [
    "Computed",
    "Entity",
    "Relation",
    "SearchOptions",
    "Settings",
    "build_index",
    "merge_segments",
    "multi_search",
    "open_index",
    "rebuild_index",
    "remove_superseded",
    "search",
    "upsert_index",
    "workspace",
]
