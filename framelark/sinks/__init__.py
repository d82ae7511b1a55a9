from framelark.sinks.tables import (
    current_results,
    export_objects,
    mark_done,
    write_frames,
    write_jsonl,
    write_media,
    write_merge,
    write_shard_log,
    write_single_results,
    write_summary,
)

__all__ = [
    "current_results", "export_objects", "mark_done", "write_frames", "write_jsonl", "write_media", "write_merge",
    "write_shard_log", "write_single_results", "write_summary",
]
