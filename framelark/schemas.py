"""Schemas of the stored entities, as DDL strings."""

# Source shard row: media bytes plus one nested struct of metadata. The duration is a number of either kind; shards with
# fractional seconds are read with that field as double (``sources.shard_schema``).
SHARD_ROW = """
mp4 binary,
json struct<
  content_parent_category: string,
  content_fine_category: string,
  content_metadata: struct<title: string>,
  original_video_filename: string,
  youtube_channel: string,
  youtube_title: string,
  youtube_upload_date: string,
  duration_seconds: bigint,
  resolution: string>
"""

MANIFEST = """
video_id string, category string, fine_category string, video_key string, metadata_key string,
channel string, title string, upload_date string, duration double, resolution string
"""

FRAMES = """
video_id string, num_frames int, sampling string, frame_size string, source_duration bigint,
frames array<string>, sampling_config_hash string
"""

# Every field optional; any scalar id is read as text.
INFERENCE_MANIFEST = "id string, prompt string, image string, images array<string>"

# Union of the ok and the error shape. The tag is the presence of the key "error" in the raw text.
RESULT = "id string, prompt string, images array<string>, output string, model string, error string"

SINGLE_RESULT = """
video_id string, model string, prompt string, answer string, run_id string, created_at timestamp,
sampling_params struct<temperature: double, top_p: double, max_tokens: int>,
frames_ref struct<num_frames: int, frame_size: string, sampling: string, sampling_config_hash: string>
"""

LABEL = """
scene string, actions array<string>, objects array<string>, camera string, summary string,
qa array<struct<q: string, a: string>>, confidence string
"""

MESSAGES = "array<struct<role: string, content: string>>"

# They must equal the ones the stored data was made with.
N_FRAMES = 16
SAMPLING = "uniform"
FRAME_SIZE = "448x448"
TILE_SIDE = 448
TOKENS_PER_TILE = 256
BATCH_SIZE = 48
CONTEXT_LIMITS = (8192, 16384)
BATCH_PROMPT = "이미지를 한국어로 자세히 설명해줘."
VIDEO_PROMPT = "이 영상의 프레임들을 보고 무슨 일이 일어나는지 한국어로 설명해줘."
NO_TARGETS = "없음"
PROBES = (
    ("caption", "이 프레임들에 무엇이 보이는지 한국어로 설명해줘."),
    ("temporal", "프레임 순서대로 장면이 어떻게 변하는지 시간 순서대로 한국어로 설명해줘."),
    ("action", "영상 속 인물이 어떤 동작을 하고 있는지 한국어로 알려줘."),
    ("sport", "이 영상의 스포츠 종목을 한 단어로만 답해줘."),
)
CONFIDENCE_LEVELS = ("high", "medium", "low")
MAX_ACTIONS = 5
MAX_OBJECTS = 10
QA_PAIRS = 3
