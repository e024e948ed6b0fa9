"""All queries outside of text, by name."""

from __future__ import annotations

from . import queries_families, queries_images, queries_sections, queries_spatial, queries_tables

MODULES = (queries_tables, queries_spatial, queries_images, queries_families, queries_sections)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
