"""Column-expression builders: recoding and multi-value cells."""

from .multivalue import clean_items, count_items, explode_items, indicator, is_missing, multi_hot, split_items
from .recode import (bucketize, first_item, ordinal_encode, recode_sentinels, role_column_name, round_half_up,
                     round_sig, safe_name, unique_names, whole_number)

__all__ = ["bucketize", "clean_items", "count_items", "explode_items", "first_item", "indicator", "is_missing",
           "multi_hot", "ordinal_encode", "recode_sentinels", "role_column_name", "round_half_up", "round_sig",
           "safe_name", "split_items", "unique_names", "whole_number"]
