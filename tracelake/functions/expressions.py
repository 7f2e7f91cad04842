"""Scalar and aggregate expressions over traces, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-3


def log_energy(v: Column) -> Column:
    """ln(v + 1e-3): motion energy is zero where nothing moves."""
    return F.log(v + EPSILON)


def seconds_to_frames(seconds: Column | float, fps: Column | float) -> Column:
    """Whole frames, at least one, ties to even."""
    s = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return F.greatest(F.lit(1), F.bround(s * fps).cast("int"))


def auto_bin(fps: Column) -> Column:
    """Frames in a temporal bin that leaves about six a second."""
    return seconds_to_frames(1 / 6, fps)


def pixel_area(diameter_um: Column, um_per_px: Column) -> Column:
    """Pixels that a disc of this diameter covers."""
    return F.bround(F.lit(3.141592653589793) / 4 * F.pow(diameter_um / um_per_px, F.lit(2.0))).cast("int")


def equal_diameter_um(area_px: Column, um_per_px: Column) -> Column:
    return 2 * F.sqrt(area_px / F.lit(3.141592653589793)) * um_per_px


def dprime(mu0: Column, mu1: Column, sd0: Column, sd1: Column) -> Column:
    return F.try_divide(mu1 - mu0, F.sqrt(0.5 * (sd0 * sd0 + sd1 * sd1)))


def gaussian_log_density(v: Column, mu: Column, sd: Column) -> Column:
    z = (v - mu) / sd
    return -0.5 * z * z - F.log(sd) - 0.9189385332046727


def total_shift(dy: Column, dx: Column) -> Column:
    return F.hypot(dy, dx)


def dff(f: Column, f0: Column, mode: str = "clamped") -> Column:
    """Change over baseline: ``clamped`` bounds the baseline in both places, ``denominator`` in one, ``plain`` nowhere."""
    low = F.greatest(f0, F.lit(1e-6))
    if mode == "clamped":
        return (f - low) / low
    if mode == "denominator":
        return (f - f0) / low
    if mode == "plain":
        return F.try_divide(f - f0, f0)
    raise ValueError(f"no such mode: {mode}")


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson's r as an aggregate; 0 where a side is constant."""
    return F.coalesce(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), F.lit(0.0))


def robust_z(v: Column, median: Column, mad: Column) -> Column:
    return F.try_divide(v - median, 1.4826 * mad)


def finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))


def zero_if_not_finite(v: Column) -> Column:
    return F.when(finite(v), v).otherwise(F.lit(0.0))


def clip(v: Column, low: float, high: float | None = None) -> Column:
    v = F.greatest(v, F.lit(low))
    return v if high is None else F.least(v, F.lit(high))


def hardware_ns(high: Column, low: Column) -> Column:
    """A clock's 64-bit nanoseconds from its two 32-bit words."""
    return F.shiftleft(high.cast("bigint"), 32) + low.cast("bigint")


def time_of(frame: Column, period: Column) -> Column:
    return frame * period


def rate_error_percent(rate: Column, reference: Column) -> Column:
    return 100 * F.abs(F.try_divide(rate - reference, reference))


def upsampling(neural_fps: Column, camera_fps: Column) -> Column:
    """Rows that come from one independent sample."""
    return F.greatest(F.lit(1.0), F.try_divide(neural_fps, camera_fps))


def origin_error_s(camera_period: Column) -> Column:
    return camera_period


def scale_error_ppm(span_frames: Column) -> Column:
    return F.try_divide(F.lit(1e6), span_frames)


def channel_of_file(name: Column) -> Column:
    return F.regexp_extract(name, r"_Ch(\d+)_", 1)


def natural_key(name: Column, width: int = 20) -> Column:
    """A string that sorts file names with their numbers as numbers."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"^\d+$"), F.lpad(F.regexp_replace(x, "^0+(?=.)", ""), width, "0")).otherwise(x)), "\x01")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\s+", "_")


def params_hash_of(canonical_json: Column) -> Column:
    return F.substring(F.sha1(canonical_json), 1, 12)


def merge_params(defaults: dict, given: dict | None, strict: bool = True) -> dict:
    """Defaults with what is given; an unknown name is an error unless ``strict`` is off."""
    unknown = sorted(set(given or {}) - set(defaults))
    if strict and unknown:
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return defaults | (given or {})
