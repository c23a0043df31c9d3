"""Plain versions of the depth operators: one window in numpy."""

import heapq

import numpy as np
import pandas as pd

RECORD = "comid long, mean_depth_m double, measured_max_m double, hollister_max_m double, range_m double, n_inside long, flat boolean, method string"


def fill_window(z: np.ndarray) -> np.ndarray:
    """A window raised to its lowest way out over the border, eight neighbours; NaN cells are outlets."""
    rows, cols = z.shape
    filled = np.full(z.shape, np.inf)
    heap = []
    for i in range(rows):
        for j in range(cols):
            near = z[max(0, i - 1) : i + 2, max(0, j - 1) : j + 2]
            if np.isnan(z[i, j]):
                filled[i, j] = np.nan
            elif i in (0, rows - 1) or j in (0, cols - 1) or np.isnan(near).any():
                filled[i, j] = z[i, j]
                heapq.heappush(heap, (z[i, j], i, j))
    while heap:
        level, i, j = heapq.heappop(heap)
        for a in range(max(0, i - 1), min(rows, i + 2)):
            for b in range(max(0, j - 1), min(cols, j + 2)):
                if filled[a, b] == np.inf:
                    filled[a, b] = max(level, z[a, b])
                    heapq.heappush(heap, (filled[a, b], a, b))
    return filled


def shore_distance(inside: np.ndarray, size: float) -> float:
    """Largest distance of an inside cell to its nearest outside one, cell centres; cells beyond the
    window are outside."""
    padded = np.pad(inside, 1)
    out, own = np.argwhere(~padded), np.argwhere(padded)
    best = 0.0
    for k in range(0, len(own), 256):
        d = ((own[k : k + 256, None, :] - out[None, :, :]) ** 2).sum(axis=2).min(axis=1)
        best = max(best, float(d.max()))
    return best**0.5 * size


def ring_slope(z: np.ndarray, inside: np.ndarray, size: float, width: int = 2) -> float:
    """Mean gradient of the cells within ``width`` cells outside the shore; 0 without such cells."""
    grown = inside
    for _ in range(width):
        p = np.pad(grown, 1)
        grown = np.any([p[i : i + z.shape[0], j : j + z.shape[1]] for i in range(3) for j in range(3)], axis=0)
    ring = grown & ~inside
    if min(z.shape) < 2 or not ring.any():
        return 0.0
    gy, gx = np.gradient(z, size)
    slope = np.hypot(gx, gy)[ring]
    slope = slope[np.isfinite(slope)]
    return float(slope.mean()) if len(slope) else 0.0


def polygon_record(pdf: pd.DataFrame, size: float, flat_below: float = 0.01) -> pd.DataFrame:
    """One polygon's depths: filled less raw elevation inside, and the shore-slope maximum."""
    r0, c0 = pdf["row"].min(), pdf["col"].min()
    z = np.full((pdf["row"].max() - r0 + 1, pdf["col"].max() - c0 + 1), np.nan)
    at = (pdf["row"] - r0).to_numpy(), (pdf["col"] - c0).to_numpy()
    z[at] = pdf["value"].to_numpy(float)
    inside = np.zeros(z.shape, bool)
    inside[at] = pdf["inside"].fillna(False).to_numpy(bool)
    valid = inside & np.isfinite(z)
    n = int(valid.sum())
    spread = float(z[valid].max() - z[valid].min()) if n else 0.0
    hollister = ring_slope(z, inside, size) * shore_distance(inside, size) if inside.any() else 0.0
    flat = not n or spread < flat_below
    depth = np.clip(fill_window(z) - z, 0, None)[valid] if not flat else np.array([])
    return pd.DataFrame(
        [(int(pdf["comid"].iloc[0]), float(depth.mean()) if len(depth) else None, float(depth.max()) if len(depth) else None, hollister, spread, n, flat, "flat" if flat else "measured")],
        columns=[c.split()[0] for c in RECORD.split(", ")],
    )
