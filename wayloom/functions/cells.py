"""Cell keys, range-image and polar bins, quantisation, status look-ups."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RAD = math.pi / 180.0

# GNSS position noise by fix status, rotation noise by heading validity.
GNSS_NOISE = {4: 0.15, 5: 0.5, 2: 0.40, 1: 10.0, 0: 1e6, -1: 1e6}
HEADING_NOISE = {True: 0.08, False: 1e6}
USABLE_FIX = (4, 5, 2, 1)
LOW_BAG_QUALITY = (2, 0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc(v: Column) -> Column:
    """Integer part, toward zero."""
    return _c(v).cast("double").cast("long")


def cell_key(x, y, size: float) -> Column:
    """Planar cell by floor."""
    return F.struct(F.floor(_c(x) / size).alias("cx"), F.floor(_c(y) / size).alias("cy"))


def voxel_key(x, y, z, size: float) -> Column:
    """Voxel by truncation toward zero, as the thinning filter counts."""
    return F.struct(trunc(_c(x) / size).alias("vx"), trunc(_c(y) / size).alias("vy"),
                    trunc(_c(z) / size).alias("vz"))


def range_image_index(x, y, z, bottom: float = 15.1, res_x: float = 0.2, res_y: float = 2.0,
                      rows: int = 16, cols: int = 1800) -> Column:
    """Row and column of a point in the range image; NULL outside."""
    x, y, z = _c(x), _c(y), _c(z)
    vertical = F.atan2(z, F.sqrt(x * x + y * y)) / RAD
    row = trunc((vertical + bottom) / res_y)
    step = trunc(F.atan2(x, y) / RAD / res_x)
    quarter = cols // 4
    col = F.when(F.atan2(x, y) / RAD <= -90, -step - quarter).otherwise(3 * quarter - step)
    inside = (row >= 0) & (row < rows)
    return F.when(inside, F.struct(row.cast("int").alias("row"), F.pmod(col, F.lit(cols)).cast("int").alias("col")))


def polar_bin(x, y, sector_deg: float = 6.0, ring_m: float = 4.0) -> Column:
    """Sector and ring of a point around the sensor."""
    x, y = _c(x), _c(y)
    a = -F.atan2(y, x) / RAD
    a = F.when(a < 0, a + 360).otherwise(a)
    return F.struct(trunc(a / sector_deg).alias("col"), trunc(F.sqrt(x * x + y * y) / ring_m).alias("row"))


def to_i16(v, scale: float = 1.0) -> Column:
    """Truncate and clamp to ±30000, the 16-bit range of the stored map."""
    return F.greatest(F.lit(-30000), F.least(F.lit(30000), trunc(_c(v) * scale))).cast("int")


def to_u8(v, scale: float = 1.0) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(255), trunc(_c(v) * scale))).cast("int")


def remap_intensity(i, weight: float) -> Column:
    return F.least(F.lit(255), trunc(_c(i) * weight)).cast("int")


def angular_step(res, reach) -> Column:
    """Turn that moves a point at ``reach`` by one cell."""
    res, reach = _c(res), _c(reach)
    return F.acos(1 - res * res / (2 * reach * reach))


def gps_usable(status) -> Column:
    return _c(status).isin(*USABLE_FIX)


def gps_low(bag_status) -> Column:
    return _c(bag_status).isin(*LOW_BAG_QUALITY)


def gps_noise(status, heading_valid) -> Column:
    """Six standard deviations: three of position, three of rotation."""
    status = _c(status)
    pos = F.lit(GNSS_NOISE[0])
    for k, v in GNSS_NOISE.items():
        pos = F.when(status == k, F.lit(v)).otherwise(pos)
    rot = F.when(_c(heading_valid), F.lit(HEADING_NOISE[True])).otherwise(F.lit(HEADING_NOISE[False]))
    return F.array(pos, pos, pos, rot, rot, rot)


def difficulty(scene, size_bytes) -> Column:
    """Site difficulty level of a run from its scene class and data volume."""
    gib = _c(size_bytes) / float(1 << 30)
    out = None
    for name, (limits, first) in DIFFICULTY.items():
        level = F.lit(first)
        for limit in limits:
            level = level + (gib > limit).cast("int")
        hit = _c(scene) == name
        out = F.when(hit, level) if out is None else out.when(hit, level)
    return out.otherwise(F.lit(2))


# Per scene, the volume limits in GiB (a level up above each) and the lowest level.
DIFFICULTY = {
    "Indoor": ((1.5, 4.0), 3),
    "Half Indoor": ((1.5, 3.0, 5.0, 10.0), 1),
    "Outdoor": ((3.0, 7.0, 15.0), 1),
}
