"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

MODULES = [
    "curation.plans.q_pages",
    "curation.plans.q_docs",
    "curation.plans.q_events",
    "curation.plans.q_notes",
    "curation.plans.q_feeds",
    "curation.plans.q_records",
    "curation.plans.q_digest",
    "curation.plans.q_extract",
    "curation.plans.q_stream",
    "curation.plans.q_flows",
]


def load() -> None:
    for m in MODULES:
        importlib.import_module(m)


load()
