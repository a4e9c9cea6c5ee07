"""All queries by name."""

from __future__ import annotations

from trackline.plans import cycle_queries, feed_queries, message_queries, metric_queries, rule_queries, stream_queries
from trackline.plans.registry import Catalogue


def catalogue() -> Catalogue:
    merged = Catalogue()
    for module in (cycle_queries, rule_queries, message_queries, metric_queries, stream_queries,
                   feed_queries):
        for name, query in module.CATALOGUE.items():
            if name in merged:
                raise ValueError(f"query {name} exists already")
            merged[name] = query
    return merged
