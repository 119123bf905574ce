"""Hilbert-curve codes of points, vectorised."""

import numpy as np


def codes(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of points given by one uint64 array of ``bits``-bit coordinates an axis.

    Transposed-index form of the curve (Skilling, "Programming the Hilbert curve", 2004): undo the excess rotations from the
    highest bit down, Gray-encode, then interleave. ``bits * len(axes)`` must be at most 63.
    """
    n = len(axes)
    if bits * n > 63:
        raise ValueError("a code must fit in 63 bits")
    x = [a.astype(np.uint64) for a in axes]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        t ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    out = np.zeros_like(x[0])
    for i in range(n):
        x[i] ^= t
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)
