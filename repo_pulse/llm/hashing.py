"""Hashes of whole arrays of numbers."""

from __future__ import annotations

import numpy as np


def mixed(keys: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of each key and salt (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys + np.asarray(salt, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
