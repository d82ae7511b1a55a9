"""Frame sampling arithmetic. No pixels are touched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelark.functions.ids import ColumnOrName, _col
from framelark.schemas import N_FRAMES, TILE_SIDE, TOKENS_PER_TILE


def _div(a: Column, b: Column) -> Column:
    """Integer division, null for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("bigint")))


def sampling_fps(duration: ColumnOrName, n: int = N_FRAMES) -> Column:
    """Frames per second that give ``n`` frames, cut (not rounded) to six decimals."""
    micros = (_col(duration).cast("decimal(20,6)") * F.lit(1000000)).cast("bigint")
    return _div(F.lit(n * 10**12).cast("bigint"), micros) / F.lit(1000000.0)


def duration_seconds_int(duration: ColumnOrName) -> Column:
    """Whole seconds, halves to the even neighbour."""
    return F.bround(_col(duration), 0).cast("bigint")


def frame_times(duration: ColumnOrName, n: int = N_FRAMES) -> Column:
    """Start of each of ``n`` equal segments, in seconds."""
    steps = F.array(*[F.lit(float(k)) for k in range(n)])
    return F.transform(steps, lambda k: k * _col(duration) / F.lit(float(n)))


def frame_interval(duration: ColumnOrName, n: int = N_FRAMES) -> Column:
    """Seconds between frames as text with one decimal."""
    # In thousandths of a second, so that a fraction of a second counts.
    milli = (_col(duration).cast("decimal(20,3)") * 1000).cast("bigint")
    tenths = F.call_function("div", milli + F.lit(50 * n), F.lit(100 * n))
    whole = F.call_function("div", tenths, F.lit(10))
    return F.concat(whole.cast("string"), F.lit("."), (tenths % 10).cast("string"))


def frame_keys(prefix: str, video_id: ColumnOrName, n: int = N_FRAMES) -> Column:
    """Keys of the ``n`` frame objects, in time order."""
    names = F.array(*[F.lit(f"/frames/frame_{i:03d}.jpg") for i in range(1, n + 1)])
    base = F.concat(F.lit(f"{prefix}/"), _col(video_id))
    return F.transform(names, lambda name: F.concat(base, name))


def letterbox(resolution: ColumnOrName, side: int = TILE_SIDE) -> Column:
    """Size and offset of a "WxH" picture fitted into a square with its aspect kept and centred."""
    w = F.split_part(_col(resolution), F.lit("x"), F.lit(1)).cast("bigint")
    h = F.split_part(_col(resolution), F.lit("x"), F.lit(2)).cast("bigint")

    def scaled(a: Column, b: Column) -> Column:
        return F.least(_div(a * (2 * side) + b, b * 2), F.lit(side).cast("bigint"))

    width, height = scaled(w, h), scaled(h, w)
    half = F.lit(2).cast("bigint")
    return F.struct(
        width.alias("width"),
        height.alias("height"),
        _div(F.lit(side) - width, half).alias("pad_x"),
        _div(F.lit(side) - height, half).alias("pad_y"),
    )


def image_tokens(frames: ColumnOrName, tiles: int | Column = 1, per_tile: int = TOKENS_PER_TILE) -> Column:
    count = F.lit(tiles) if isinstance(tiles, int) else tiles
    return _col(frames).cast("bigint") * count.cast("bigint") * F.lit(per_tile).cast("bigint")
