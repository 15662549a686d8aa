"""All registered queries."""

from __future__ import annotations

from docindex.plans import facets, predicates, profiles, scans, shaping, sinks, slowlogs
from docindex.plans.common import Registry


def registry() -> Registry:
    every = Registry()
    for module in (scans, sinks, shaping, predicates, facets, profiles, slowlogs):
        every.update(module.REGISTRY)
    return every
