from framelark.sources.files import list_files, read_shard_table, read_shards, shard_paths, shard_schema, shard_table
from framelark.sources.jsonl import parse_strict, read_lines, text_lines, with_fields, with_line_index
from framelark.sources.media import read_frame_bytes, read_frames, read_results

__all__ = [
    "list_files", "parse_strict", "read_frame_bytes", "read_frames", "read_lines", "read_results", "read_shard_table",
    "read_shards", "shard_paths", "shard_schema", "shard_table", "text_lines", "with_fields", "with_line_index",
]
