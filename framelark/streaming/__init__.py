from framelark.streaming.merge import append_log, checkpoint_token, compact_log, merged_log, stream_lines
from framelark.streaming.scoring import read_progress, read_scored, score_manifest_stream
from framelark.streaming.tiers import compact_tiers, read_live, records_of, remove_dead

__all__ = [
    "append_log", "checkpoint_token", "compact_log", "compact_tiers", "merged_log", "read_live", "read_progress",
    "read_scored", "records_of", "remove_dead", "score_manifest_stream", "stream_lines",
]
