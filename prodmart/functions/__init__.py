"""Column functions: every one is a composition of built-in expressions."""

from .literals import map_fields, parse_array, parse_fields, parse_map
from .nutrition import nutrient_levels, nutrients
from .numbers import clip, nan_to_null, parse_long, parse_double
from .tags import clean_tag_list, empty_list_to_null, explode_tags, first_tag, has_tags, split_tags
from .text import clean_text, fold_text, replace_value, strip

__all__ = [
    "clean_tag_list", "clean_text", "clip", "empty_list_to_null", "explode_tags", "first_tag", "fold_text", "has_tags",
    "map_fields", "nan_to_null", "nutrient_levels", "nutrients", "parse_array", "parse_double",
    "parse_fields", "parse_long", "parse_map", "replace_value", "split_tags", "strip",
]
