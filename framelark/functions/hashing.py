"""Content hashes that name configurations, runs and cached results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelark.functions.ids import ColumnOrName, _col
from framelark.schemas import FRAME_SIZE, SAMPLING


def _joined_hash(parts: list[Column], digits: int) -> Column:
    # concat_ws skips nulls, which would let two different inputs share one hash.
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.substring(F.sha2(text, 256), 1, digits)


def config_hash(n_frames: int | Column, sampling: str = SAMPLING, frame_size: str = FRAME_SIZE) -> Column:
    """Six hex digits naming a frame-sampling configuration."""
    n = F.lit(n_frames) if isinstance(n_frames, int) else n_frames
    return _joined_hash([n, F.lit(sampling), F.lit(frame_size)], 6)


def run_id(prompt: ColumnOrName, model: ColumnOrName, sampling_hash: ColumnOrName) -> Column:
    """Twelve hex digits naming a run: same prompt, model and frames give the same run."""
    return _joined_hash([_col(prompt), _col(model), _col(sampling_hash)], 12)


def stage_key(**parts: ColumnOrName) -> Column:
    """Hash over named parts, for skipping one stage of the work whose inputs are unchanged."""
    named = [_col(c).cast("string").alias(name) for name, c in parts.items()]
    return F.sha2(F.to_json(F.struct(*named), {"ignoreNullFields": "false"}), 256)


def cache_key(
    video_id: ColumnOrName,
    sampling: ColumnOrName,
    prompt_version: ColumnOrName,
    model_version: ColumnOrName,
    decoding: ColumnOrName,
) -> Column:
    """Full key of a label: changes whenever anything that could change the answer does."""
    return stage_key(
        video_id=video_id,
        sampling=sampling,
        prompt_version=prompt_version,
        model_version=model_version,
        decoding=decoding,
    )
