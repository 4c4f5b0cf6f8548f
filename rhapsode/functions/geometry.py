"""Boxes and keypoints as column expressions. Boxes are four columns x1, y1, x2, y2 or a struct of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the model inputs: detector side, pose crop (width, height) and padding.
DETECTOR_SIDE, CROP_WIDTH, CROP_HEIGHT, CROP_PADDING = 640, 288, 384, 1.25
JOINT_SCORE, SCREEN_MARGIN, BODY_JOINTS, REAL_BODY, HAND_POINTS, HAND_SCORE, LEAST_SHOULDERS = 0.3, 0.25, 17, 8, 10, 0.3, 1e-6


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def box_of(prefix: str = "") -> Column:
    """The box of a table's columns; prefix: a table alias with its dot."""
    return box(*[F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2")])


def area(b: Column, plus: float = 0.0) -> Column:
    """Width times height; plus=1 counts end pixels, as older suppression code does."""
    return (b["x2"] - b["x1"] + plus) * (b["y2"] - b["y1"] + plus)


def intersection(a: Column, b: Column, plus: float = 0.0) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]) + plus
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]) + plus
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def center_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2


def center_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2


def inside(b: Column, region: Column) -> Column:
    """Whether a box's centre lies in a region, edges included; a null region holds nothing."""
    hit = center_x(b).between(region["x1"], region["x2"]) & center_y(b).between(region["y1"], region["y2"])
    return F.coalesce(hit, F.lit(False))


def decode_box(px: Column, py: Column, stride: Column, dx: Column, dy: Column, dw: Column, dh: Column) -> Column:
    """A detector's offsets and log sizes at a grid point to corners."""
    cx, cy, w, h = px + dx * stride, py + dy * stride, F.exp(dw) * stride, F.exp(dh) * stride
    return box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


def letterbox(width: Column, height: Column, side: int = DETECTOR_SIDE) -> tuple[Column, Column]:
    """Width and height after the keep-ratio resize into a square; an error unless the longer one fills it."""
    scale = F.lit(float(side)) / F.greatest(width, height)
    w, h = F.floor(width * scale + 0.5), F.floor(height * scale + 0.5)
    ok = F.greatest(w, h) == side
    return tuple(F.when(ok, v).otherwise(F.raise_error(F.lit("unexpected rescale"))).cast("long") for v in (w, h))


def crop(b: Column) -> Column:
    """Centre and size of the pose crop: padded, then widened or heightened to the input's aspect."""
    w, h, ratio = (b["x2"] - b["x1"]) * CROP_PADDING, (b["y2"] - b["y1"]) * CROP_PADDING, CROP_WIDTH / CROP_HEIGHT
    wide = w > h * ratio
    return F.struct(center_x(b).alias("cx"), center_y(b).alias("cy"), F.when(wide, w).otherwise(h * ratio).alias("w"), F.when(wide, w / ratio).otherwise(h).alias("h"))


def back_project(loc: Column, size: int, scale: Column, center: Column) -> Column:
    """A location in the crop to the frame."""
    return loc / size * scale + center - scale * 0.5


def bin_step(crop_height: Column, ratio: float = 2.0) -> Column:
    """Frame pixels of one location bin of a crop."""
    return crop_height / (CROP_HEIGHT * ratio)


def first_max(values: Column) -> Column:
    """Index, from 0, of the first greatest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("long")


def visible(p: Column) -> Column:
    """A joint (x, y, score) that scores and lies on screen or within the margin, edges included."""
    low, high = -SCREEN_MARGIN, 1 + SCREEN_MARGIN
    return (p["score"] > JOINT_SCORE) & p["x"].between(low, high) & p["y"].between(low, high)


def real_body(joints: Column) -> Column:
    """Whether enough of the first 17 joints and the neck (the shoulders' midpoint) are visible."""
    left, right = F.element_at(joints, 6), F.element_at(joints, 7)
    neck = F.struct(((left["x"] + right["x"]) / 2).alias("x"), ((left["y"] + right["y"]) / 2).alias("y"), F.when((left["score"] > JOINT_SCORE) & (right["score"] > JOINT_SCORE), 1.0).otherwise(0.0).alias("score"))
    return F.size(F.filter(F.slice(joints, 1, BODY_JOINTS), visible)) + visible(neck).cast("int") >= REAL_BODY


def hand_shown(points: Column) -> Column:
    return F.size(F.filter(points, lambda p: p["score"] > HAND_SCORE)) >= HAND_POINTS


def shoulder_width(joints: Column, width: Column | float, height: Column | float, least: float = JOINT_SCORE) -> Column:
    """Distance of the shoulders in pixels; null unless both score and are apart."""
    left, right = F.element_at(joints, 6), F.element_at(joints, 7)
    d = F.hypot((left["x"] - right["x"]) * width, (left["y"] - right["y"]) * height)
    return F.when((left["score"] > least) & (right["score"] > least) & (d > LEAST_SHOULDERS), d)


def wrist(joints: Column, at: int, width: float, height: float, least: float = JOINT_SCORE) -> Column:
    """A wrist (10 left, 11 right, from 1) relative to the shoulders' midpoint in pixels; null if it or a shoulder is unseen."""
    left, right, p = F.element_at(joints, 6), F.element_at(joints, 7), F.element_at(joints, at)
    seen = shoulder_width(joints, width, height, least).isNotNull() & (p["score"] > least)
    return F.when(seen, F.struct((p["x"] * width - (left["x"] + right["x"]) * width / 2).alias("x"), (p["y"] * height - (left["y"] + right["y"]) * height / 2).alias("y")))


def fits_scale(box_area: Column, size: Column, spot_area: Column, spot_size: Column, factor: float) -> Column:
    """Whether a box's size and width are within a factor of a spot's; unknown widths pass, factor 0 passes all, an empty spot box nothing."""
    if factor == 0:
        return F.lit(True)
    near = lambda r: r.between(1 / factor, factor)
    width = size / spot_size
    return F.when(spot_area <= 0, False).otherwise(near(F.sqrt(box_area / spot_area)) & F.coalesce(near(width), F.lit(True)))


def fma32(x: Column, y: Column, z: Column) -> Column:
    """x y + z of floats, rounded once to the nearest float (as a double).

    The product of two floats is exact in double; the sum's rounding error is, too (two-sum). Rounding the sum again, to float, goes wrong only where
    it lies half-way between two floats and the error says to which side the true value leans.
    """
    x, y, z = (c.cast("float").cast("double") for c in (x, y, z))
    p = x * y
    s = p + z
    back = s - p
    error = (p - (s - back)) + (z - back)
    near = s.cast("float").cast("double")
    other = near + 2 * (s - near)  # the float on the other side, if s is half-way
    return F.when((s != near) & (other.cast("float").cast("double") == other) & ((s - near) * error > 0), other).otherwise(near)


def within_ulps(a: Column, b: Column, ulps: int) -> Column:
    """Whether two values, as floats, differ by at most so many units in the last place of the larger."""
    a, b = a.cast("float").cast("double"), b.cast("float").cast("double")
    top = F.greatest(F.abs(a), F.abs(b), F.lit(2.0**-126))
    return F.abs(a - b) <= ulps * F.pow(F.lit(2.0), F.floor(F.log2(top)) - 23)


def part_of(k: Column) -> Column:
    """Which part a whole-body keypoint belongs to."""
    return F.when(k < 17, "body").when(k < 23, "feet").when(k < 91, "face").when(k < 112, "lhand").otherwise("rhand")
