"""All registered queries."""

from __future__ import annotations

from suite import catalogue, profiles, scoring, storage, tagging, whole

ALL: dict[str, tuple] = {}
for module in (profiles, tagging, scoring, catalogue, storage, whole):
    ALL.update(module.QUERIES)
