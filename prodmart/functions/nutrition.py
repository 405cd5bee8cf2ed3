"""Columns derived from the two dict-valued nutrition fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import LEVEL_FIELDS, NUTRIENT_FIELDS
from .literals import map_fields, parse_fields, parse_map
from .numbers import parse_double


def nutrient_levels(col: Column, parsed: Column | None = None) -> list[Column]:
    """Four level columns; a level missing from a readable dict is `unknown`."""
    source = parse_map(col) if parsed is None else parsed
    values = map_fields(source, list(LEVEL_FIELDS), default="unknown")
    return [v.alias(name) for v, name in zip(values, LEVEL_FIELDS.values())]


def nutrients(col: Column, parsed: Column | None = None) -> list[Column]:
    """Seven numbers per 100 g; missing or unreadable values are NULL."""
    source = parse_fields(col, list(NUTRIENT_FIELDS)) if parsed is None else parsed
    return [parse_double(source.getField(key)).alias(name) for key, name in NUTRIENT_FIELDS.items()]
