"""Pixels to 8-bit Lab colours and their histograms (H4, A8), in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Linear light to X, Y, Z (rows; columns red, green, blue), and the white point.
TO_XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
WHITE = (0.950456, 1.0, 1.088754)


def linear_light() -> list[float]:
    """Light of each of the 256 values of a byte."""
    return [v / 255 / 12.92 if v / 255 <= 0.04045 else ((v / 255 + 0.055) / 1.055) ** 2.4 for v in range(256)]


def lab_pixels(frames: DataFrame, pixels: str) -> DataFrame:
    """``frames`` (without ``pixels``, a list of blue, green, red bytes) with a row for each pixel: ``l, a, b``.

    A byte's light is looked up, so a pixel costs three cube roots."""
    table = F.array(*map(F.lit, linear_light()))
    rest = [c for c in frames.columns if c != pixels]
    light = F.transform(pixels, lambda x: F.get(table, x.cast("int")))
    at = F.sequence(F.lit(0), F.floor(F.size("light") / 3).cast("int") - 1)
    bgr = F.transform(at, lambda i: F.struct(*(F.get("light", 3 * i + k).alias(n) for k, n in enumerate("bgr"))))
    p = frames.where(F.size(pixels) >= 3).select(*rest, light.alias("light")).select(*rest, F.explode(bgr).alias("p"))
    x, y, z = ((m[0] * F.col("p.r") + m[1] * F.col("p.g") + m[2] * F.col("p.b")) / w for m, w in zip(TO_XYZ, WHITE, strict=True))
    p = p.select(*rest, x.alias("x"), y.alias("y"), z.alias("z"))
    root = lambda c: F.when(F.col(c) > 0.008856, F.cbrt(c)).otherwise(7.787 * F.col(c) + 16 / 116)
    p = p.select(*rest, F.when(F.col("y") > 0.008856, 116 * F.cbrt("y") - 16).otherwise(903.3 * F.col("y")).alias("l"), root("x").alias("fx"), root("y").alias("fy"), root("z").alias("fz"))
    byte = lambda v: F.greatest(F.lit(0), F.least(F.lit(255), F.rint(v).cast("int")))
    return p.select(*rest, byte(F.col("l") * 255 / 100).alias("l"), byte(500 * (F.col("fx") - F.col("fy")) + 128).alias("a"), byte(200 * (F.col("fy") - F.col("fz")) + 128).alias("b"))


def sparse_histograms(frames: DataFrame, keys: list[str], pixels: str) -> DataFrame:
    """A8 [R]: ``keys, channel, bin, p``, the share of a frame's pixels in each bin that has any. Bins are counted before they move."""
    c = lab_pixels(frames.select(*keys, pixels), pixels)
    bins = F.explode(F.array(*(F.struct(F.lit(k).alias("channel"), F.col(n).alias("bin")) for k, n in enumerate("lab")))).alias("c")
    n = c.select(*keys, bins).groupBy(*keys, "c.channel", "c.bin").agg(F.count("*").alias("n"))
    size = frames.select(*keys, F.floor(F.size(pixels) / 3).alias("size"))
    return n.join(size, keys).select(*keys, "channel", "bin", (F.col("n") / (F.col("size") + F.lit(1e-10))).alias("p"))


def sparse_colour_tier(hist: DataFrame, least: float = 0.7, bins: int = 256) -> DataFrame:
    """A7 [R] on sparse bins (absent ones are zeros): correlation of each clip's histograms with the mean of its project's, for
    projects of two clips or more. ``hist``: project_id, clip_id, channel, bin, p. A histogram without spread correlates fully."""
    from .numbers import rounded

    group = ["project_id", "channel"]
    clips = hist.groupBy(*group).agg(F.countDistinct("clip_id").alias("clips")).where("clips >= 2")
    mean = hist.groupBy(*group, "bin").agg(F.sum("p").alias("total")).join(clips, group).select(*group, "bin", (F.col("total") / F.col("clips")).alias("m"))
    of_mean = mean.groupBy(*group).agg(F.sum("m").alias("sm"), F.sum(F.col("m") * F.col("m")).alias("smm"))
    sums = hist.join(mean, [*group, "bin"]).groupBy("project_id", "clip_id", "channel").agg(
        F.sum("p").alias("sp"), F.sum(F.col("p") * F.col("p")).alias("spp"), F.sum(F.col("p") * F.col("m")).alias("spm"))
    j = sums.join(of_mean, group)
    n = F.lit(float(bins))
    cov, vp, vm = (F.col(a) / n - F.col(b) / n * F.col(c) / n for a, b, c in (("spm", "sp", "sm"), ("spp", "sp", "sp"), ("smm", "sm", "sm")))
    r: Column = F.when((vp < 1e-14) | (vm < 1e-14), 1.0).otherwise(cov / F.sqrt(vp * vm))
    return j.withColumn("r", r).groupBy("project_id", "clip_id").agg(
        *(rounded(F.max(F.when(F.col("channel") == k, F.col("r"))), 4).alias(f"{x}_correlation") for k, x in enumerate("lab")),
        (F.min(F.when(F.col("channel") > 0, F.col("r"))) >= least).alias("passed"))
