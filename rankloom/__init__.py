"""Text search and link ranking as Spark DataFrame jobs."""

from rankloom.plans.build_index import Index, build_index, load_index
from rankloom.plans.search import search

__all__ = ["Index", "build_index", "load_index", "search"]
