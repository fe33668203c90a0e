"""Arrays of numbers as fields of a record that any byte format can carry, and back."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

import numpy as np

# The fields by which a reader knows an array, and a single number, from a plain record.
ARRAY, NUMBER = b"__ndarray__", b"__npgeneric__"


def packed(value: Any) -> Any:
    """Arrays and numbers with a type become records; whatever else passes. Types without a plain form are refused."""
    if isinstance(value, (np.ndarray, np.generic)) and value.dtype.kind in "VOc":
        raise ValueError(f"no plain form of {value.dtype}")
    if isinstance(value, np.ndarray):
        return {ARRAY: True, b"data": value.tobytes(), b"dtype": value.dtype.str, b"shape": value.shape}
    if isinstance(value, np.generic):
        return {NUMBER: True, b"data": value.item(), b"dtype": value.dtype.str}
    return value


def unpacked(record: Mapping) -> Any:
    if ARRAY in record:
        return np.frombuffer(record[b"data"], np.dtype(record[b"dtype"])).reshape(record[b"shape"])
    if NUMBER in record:
        return np.dtype(record[b"dtype"]).type(record[b"data"])
    return record
