"""Column functions. All are built-in Spark expressions; none is a Python UDF."""

from framelark.functions.hashing import cache_key, config_hash, run_id, stage_key
from framelark.functions.ids import (
    file_stem,
    first_nonempty,
    image_list,
    join_path,
    media_key,
    metadata_key,
    resolve_uri,
    result_key,
    safe_id,
    shard_file,
)
from framelark.functions.media import (
    duration_seconds_int,
    frame_interval,
    frame_keys,
    frame_times,
    image_tokens,
    letterbox,
    sampling_fps,
)
from framelark.functions.prompts import batch_prompt, chat_messages, fill_template, video_prompt
from framelark.functions.text import (
    letter_count,
    letters,
    longest_repeat,
    ngrams,
    repeated_count,
    script_count,
    strip,
    words,
)

__all__ = [
    "batch_prompt", "cache_key", "chat_messages", "config_hash", "duration_seconds_int", "file_stem", "fill_template",
    "first_nonempty", "frame_interval", "frame_keys", "frame_times", "image_list", "image_tokens", "join_path",
    "letter_count", "letterbox", "letters", "longest_repeat", "media_key", "metadata_key", "ngrams", "repeated_count", "resolve_uri",
    "result_key", "run_id", "safe_id", "sampling_fps", "script_count", "shard_file", "stage_key", "strip",
    "video_prompt", "words",
]
