"""Peak arrays: ``array<struct<mz double, intensity double, ...>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_PEAK, MIN_SCALED = 999.0, 5.0
FWHM_TO_SIGMA, GAUSS_BASE = 2.3548, 2.71828  # the base is deliberately not e: areas were scaled with it


def base_intensity(peaks: Column) -> Column:
    return F.aggregate(peaks, F.lit(0.0), lambda acc, p: F.greatest(acc, p["intensity"].cast("double")))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` reads it inside
    further lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scale_peaks(peaks: Column, extra: tuple[str, ...] = ()) -> Column:
    """Base peak to 999, peaks below 5 dropped.  ``extra`` names further struct fields to keep.

    A list without a positive intensity stays as it is.
    """
    def scaled(top: Column) -> Column:
        share = lambda p: F.when(top > 0, p["intensity"] / top * F.lit(BASE_PEAK)).otherwise(
            p["intensity"].cast("double"))
        kept = F.filter(peaks, lambda p: (top <= 0) | (share(p) >= F.lit(MIN_SCALED)))
        return F.transform(kept, lambda p: F.struct(p["mz"].cast("double").alias("mz"), share(p).alias("intensity"),
                                                    *[p[f].alias(f) for f in extra]))

    return bind(base_intensity(peaks), scaled)


def sort_by_mz(peaks: Column) -> Column:
    """Peaks in mass order (``mz`` must be the first struct field)."""
    return F.array_sort(peaks)


def top_peaks(peaks: Column, n: int) -> Column:
    """The ``n`` most intense peaks, most intense first."""
    by_height = F.transform(peaks, lambda p: F.struct((-p["intensity"]).alias("order"), p["mz"].alias("mz"),
                                                      p["intensity"].alias("intensity")))
    return F.transform(F.slice(F.array_sort(by_height), 1, n),
                       lambda p: F.struct(p["mz"].alias("mz"), p["intensity"].alias("intensity")))


def strip_masses(peaks: Column, masses: Column, tolerance: float) -> Column:
    """Peaks farther than ``tolerance`` from every listed mass."""
    return F.filter(peaks, lambda p: ~F.exists(masses, lambda m: F.abs(p["mz"] - m) <= F.lit(tolerance)))


def shift_masses(peaks: Column, factor: Column) -> Column:
    """Every peak mass times ``factor``; other fields untouched."""
    return F.transform(peaks, lambda p: p.withField("mz", p["mz"] * factor))


def split_annotation(annotation: Column) -> Column:
    """Struct ``type, chain``: ``O-1_Alkyl Fragment_[10:0]`` -> type with its formula, and the chain."""
    kind = F.when(annotation.contains("_"), F.regexp_extract(annotation, r"^(.*)_[^_]*$", 1))
    chain = F.regexp_extract(annotation, r"^.*\[([^\[\]]*)\][^\]]*$", 1)
    return F.struct(kind.alias("type"), chain.alias("chain"))


def _grid() -> tuple[list[float], float]:
    """Node heights of a unit-width Gaussian sampled every 1/12 width over +-3, and its trapezium."""
    sigma = 1.0 / FWHM_TO_SIGMA
    nodes = [-3.0 + i / 12.0 for i in range(72)]
    heights = [GAUSS_BASE ** (-(t * t / (2 * sigma * sigma))) for t in nodes]
    return heights, sum((a + b) / 24.0 for a, b in zip(heights, heights[1:]))


UNIT_AREA = _grid()[1]


def relative_height(fwhm: Column, apex: Column, t: Column) -> Column:
    """Height of the modelled peak at ``t`` on a 0-1 scale, read at the nearest of its sampling
    nodes (every fwhm/12, +-3 fwhm); 0.001 outside."""
    node = F.floor((t - apex) / (fwhm / 12.0) + 0.5)
    x = node / F.lit(12.0)
    sigma2 = 2.0 / (FWHM_TO_SIGMA ** 2)
    height = F.pow(F.lit(GAUSS_BASE), -(x * x) / F.lit(sigma2))
    inside = ((t - apex) >= -3.0 * fwhm) & ((t - apex) <= F.lit(71.0 / 12.0 - 3.0) * fwhm)
    return F.when((fwhm > 0) & inside, height).otherwise(F.lit(0.001))


def model_height(fwhm: Column, area: Column) -> Column:
    """Apex height that gives the modelled peak its measured area."""
    return F.when(fwhm > 0, area / (fwhm * F.lit(UNIT_AREA))).otherwise(F.lit(0.0))


def peak_height_at(fwhm: Column, area: Column, apex: Column, t: Column) -> Column:
    """Absolute modelled height at ``t``."""
    return relative_height(fwhm, apex, t) * model_height(fwhm, area)
