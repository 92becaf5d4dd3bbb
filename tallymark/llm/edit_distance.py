"""Edit distance of many pairs at once, in a band, with bit vectors.

After Hyyrö (2003). Bit b of a pair's vectors stands for row j - band + b of column j, so the band
moves down with the columns. A pair's last cell lies on one diagonal, which keeps its bit.
"""

from __future__ import annotations

import numpy as np

_CELLS = 1 << 21
_LONG = 256  # longer pairs are cut to where they differ before columns are stepped through


def _padded(texts: list[np.ndarray], width: int, fill: int, lead: int) -> np.ndarray:
    out = np.full((len(texts), width), fill, dtype=np.uint32)
    for row, text in zip(out, texts):
        row[lead : lead + len(text)] = text
    return out


def _differing(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two texts without their common beginning and end, which cost no edits."""
    for _ in range(2):
        shorter = min(len(left), len(right))
        unequal = left[:shorter] != right[:shorter]
        same = int(unequal.argmax()) if unequal.any() else shorter
        left, right = left[same:][::-1], right[same:][::-1]
    return left, right


def within(left: list[np.ndarray], right: list[np.ndarray], band: int) -> np.ndarray:
    """Whether each pair of code point arrays is at most band edits apart (band below 31)."""
    cut = [_differing(a, b) if min(len(a), len(b)) > _LONG else (a, b) for a, b in zip(left, right)]
    left, right = [a for a, _ in cut], [b for _, b in cut]
    n, m = (np.array([len(t) for t in side], dtype=np.int64) for side in (left, right))
    result = np.zeros(len(n), dtype=bool)
    near = np.flatnonzero(np.abs(n - m) <= band)
    near = near[np.argsort(m[near], kind="stable")]
    at = 0
    while at < len(near):
        end = at + 1
        while end < len(near) and (end - at) * (m[near[end]] + 2 * band + 2) < _CELLS:
            end += 1
        part = near[at:end]
        result[part] = _run([left[k] for k in part], [right[k] for k in part], n[part], m[part], band)
        at = end
    return result


def _run(left, right, n, m, band) -> np.ndarray:
    width = int(m.max(initial=0))
    rows = _padded(left, width + 2 * band + 2, 0xFFFFFFFF, band)
    columns = _padded(right, width, 0xFFFFFFFE, 0)
    one = np.uint64(1)
    mask = np.uint64((1 << (2 * band + 1)) - 1)
    # column 1 sees rows 1 - band to 1 + band; rows from 1 on step up, those above the table step down
    up = np.full(len(n), ((1 << (2 * band + 1)) - 1) & ~((1 << band) - 1), dtype=np.uint64)
    down = np.full(len(n), (1 << band) - 1, dtype=np.uint64)
    score = np.abs(n - m)
    place = (n - m + band).astype(np.uint64)
    for j in range(width):
        equal = np.zeros(len(n), dtype=np.uint64)
        for b in range(2 * band + 1):
            equal |= (rows[:, j + b] == columns[:, j]).astype(np.uint64) << np.uint64(b)
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & mask
        right_up = (down | ~(diagonal | up)) & mask
        right_down = diagonal & up
        score = score + ((j < m) & ((diagonal >> place) & one == 0))
        below = diagonal >> one
        up = (right_down | ~(below | right_up)) & mask
        down = below & right_up
    return score <= band
