"""Scales in metres and pixels, ray directions, and the names that carry them. Plain arithmetic on the driver."""

from __future__ import annotations

import math


def pixel_size(a: float) -> float:
    """Pixel width of an affine transform with first coefficient `a`."""
    return abs(a)


def odd_window(r_m: float, px: float, least: int = 3) -> int:
    """Window width in pixels for a length in metres: half-even rounding, at least `least`, then odd."""
    k = max(least, int(round(r_m / px)))
    return k if k % 2 else k + 1


def window_list(lengths: list[float], px: float, least: int = 3) -> list[int]:
    return list(dict.fromkeys(odd_window(r, px, least) for r in lengths))


def block_scale(r_m: float, px: float) -> int:
    """Number of pixels on a side of a coarse block."""
    return max(1, int(round(r_m / px)))


def effective_radius(k: int, px: float) -> float:
    return (k - 1) / 2 * px


def openness_radius(k: int, px: float, mode: int = 2) -> float:
    """Search radius from the effective one: 1 the diagonal, 2 equal area, 3 as it is."""
    return {1: math.sqrt(2), 2: 2 / math.sqrt(math.pi), 3: 1.0}[mode] * effective_radius(k, px)


def half_distance(k: int) -> int:
    return max(1, (k - 1) // 2)


def gauss_sigma(r_m: float, px: float, least: float = 0.5) -> float:
    """Standard deviation in pixels of a smoother whose three-sigma reach is `r_m`."""
    return max(least, r_m / (3 * px))


def directions(n: int, full_circle: bool = False) -> list[tuple[float, float]]:
    """(east, north) unit vectors of n rays, evenly over the half circle or the whole one."""
    turn = 2 * math.pi if full_circle else math.pi
    return [(math.cos(turn * i / n), math.sin(turn * i / n)) for i in range(n)]


def evans_constants(k: int) -> dict[str, float]:
    """Sums of powers of the offsets in a window and the denominators of the least-squares quadratic."""
    d = k // 2
    s2, s4 = (sum(p**e for p in range(-d, d + 1)) for e in (2, 4))
    return {"k": k, "s2": s2, "s4": s4, "second": k * s4 - s2**2, "cross": s2**2}


def block_size(width: int, height: int, most: int = 512) -> int | None:
    """Tile size for a stored raster: a multiple of 16 up to `most`; None for rasters under 16 pixels."""
    size = min(width, height, most) // 16 * 16
    return size or None


def number_tag(x: float) -> str:
    """A length for a file name: no trailing zeros, a p for the decimal point."""
    return f"{x:g}".replace(".", "p").replace("-", "m")


def scale_tag(r_m: float, k: int, px: float) -> str:
    """Tag with the requested length, the window and the effective radius, so that scales never share a name."""
    return f"rin{number_tag(r_m)}m_k{k}_reff{number_tag(effective_radius(k, px))}m"


def feature_name(stem: str, metric: str, tag: str, variant: str = "") -> str:
    return "_".join(x for x in (stem, metric, tag, variant) if x)


def memory_estimate(rows: int, columns: int) -> dict[str, object]:
    """Bytes of a training table in memory and the formats advised for it."""
    size = int(rows * columns * 8 * 1.5)
    return {"bytes": size, "readable": readable_bytes(size), "geopackage": size <= 8 << 30, "csv": size <= 2 << 30}


def readable_bytes(size: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if size < 1024 or unit == "TB":
            return f"{size:.1f} {unit}"
        size /= 1024
    return ""


def experiment_tag(test_size: float, seed: int, n_trees: int, max_depth: int | None, class_weight: str | None, note: str = "") -> str:
    parts = [f"ts{test_size:g}", f"rs{seed}", f"n{n_trees}", f"d{max_depth or 'none'}", f"w{class_weight or 'none'}", note]
    return "_".join(p for p in parts if p)


def fraction(text: str) -> float:
    """'1/10' or '0.1'."""
    top, _, bottom = text.strip().partition("/")
    return float(top) / float(bottom) if bottom else float(top)
