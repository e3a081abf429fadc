"""Jobs: operators put together in the order they run in production."""

from haulwatch.plans import registry, replays

QUERIES = registry.QUERIES

__all__ = ["QUERIES", "registry", "replays"]
