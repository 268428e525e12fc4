"""Hashed character n-grams of texts, with numpy."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint32(2654435761)


def codes(text: str) -> np.ndarray:
    """Code points of the text in lower case, white space as single blanks, one at each end."""
    return np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace"), np.uint32)


def hashed(points: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """A number below ``2**bits`` for every n-gram of the given orders, repeats included."""
    parts, rolling = [], points
    for n in range(1, max(orders) + 1):
        if n > 1:
            if len(points) < n:
                break
            rolling = rolling[:-1] * _MULTIPLIER + points[n - 1 :]
        if n in orders:
            mixed = (rolling ^ (rolling >> np.uint32(15))) * _MULTIPLIER + np.uint32(n * 0x9E37)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x85EBCA6B)
            parts.append(mixed >> np.uint32(32 - bits))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
