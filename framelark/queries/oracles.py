"""The same results in SQL, for checking. Each query names the shared parts it needs."""

from __future__ import annotations

PARTS = {
    "result_lines": r"""
        SELECT event_id, ts, value, printf('shard-%05d.jsonl', date_diff('day', DATE '1970-01-01', ts)) AS file,
          CASE WHEN value < 1.0 THEN body WHEN value < 1.2 THEN '  ' ELSE body || '}' END AS raw
        FROM (
          SELECT *, '{' || CASE WHEN value >= 200 THEN '' ELSE '"id": ' || user_id || ', ' END
            || CASE WHEN event_type = 'error'
               THEN '"error": ' || CASE WHEN value >= 100 AND value < 120 THEN 'null'
                    ELSE '"load: ' || replace(props, '"', '\"') || '"' END || ', "prompt": "error"'
               ELSE '"prompt": "' || event_type || '", "output": "' || replace(props, '"', '\"') || '", "model": "m1"'
               END AS body
          FROM events)""",
    "log": r"""
        SELECT event_id, ts, file, raw, json_extract_string(raw, '$.id') AS id,
          list_contains(json_keys(raw), 'error') AS is_error
        FROM (SELECT event_id, ts, file, CASE WHEN json_valid(raw) THEN raw END AS raw FROM result_lines)
        WHERE json_type(raw) = 'OBJECT'""",
    "train": r"""
        SELECT id, arg_max(raw, (ts, event_id)) AS raw, arg_min(event_id, (ts, event_id)) AS first_event,
          arg_max(event_id, (ts, event_id)) AS last_event, count(*) AS n_records
        FROM log WHERE NOT is_error AND id IS NOT NULL GROUP BY id""",
    "shard_rows": r"""
        SELECT doc_id // 100 AS shard, doc_id AS row_pos, text, lang AS parent_category, source AS fine_category,
          'Clip ' || doc_id || ' of ' || source AS title, 'src/' || doc_id || '.mp4' AS file_name,
          'channel-' || source AS channel,
          strftime(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER), '%Y%m%d') AS upload_date,
          n_chars AS duration,
          CASE doc_id % 3 WHEN 0 THEN '640x360' WHEN 1 THEN '360x640' ELSE '1920x1080' END AS resolution
        FROM documents""",
    "manifest": r"""
        SELECT CAST(row_pos AS VARCHAR) AS video_id, 'en' AS category, fine_category,
          'media/en/' || row_pos || '/video.mp4' AS video_key, 'media/en/' || row_pos || '/metadata.json' AS metadata_key,
          channel, title, upload_date, duration, resolution, shard, row_pos
        FROM shard_rows WHERE parent_category = 'en'""",
    "placed": r"""
        SELECT m.* EXCLUDE (shard), f.shard, f.place FROM manifest m JOIN (
          SELECT row_pos, dense_rank() OVER (ORDER BY shard) - 1 AS shard,
            row_number() OVER (PARTITION BY shard ORDER BY row_pos) - 1 AS place FROM shard_rows) f USING (row_pos)""",
    "frames": r"""
        SELECT video_id, duration, resolution,
          list_transform(range(1, 17), lambda i: 'media/en/' || video_id || '/frames/frame_' || lpad(CAST(i AS VARCHAR), 3, '0') || '.jpg') AS frames
        FROM manifest""",
    "records": r"""
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
          CASE doc_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'Describe ' || source END AS prompt,
          CASE doc_id % 4 WHEN 1 THEN 'https://img.example.com/' || doc_id || '.jpg'
            WHEN 3 THEN '/stills/' || doc_id || '.jpg' END AS image,
          CASE doc_id % 4 WHEN 2 THEN list_transform(range(1, 17),
              lambda i: 's3://media/clips/' || doc_id || '/frame_' || lpad(CAST(i AS VARCHAR), 3, '0') || '.jpg')
            WHEN 3 THEN CAST([] AS VARCHAR[]) END AS images
        FROM documents""",
    "some_unnamed": "SELECT * REPLACE (CASE WHEN doc_id % 7 <> 3 THEN id END AS id) FROM records",
    "listed": r"""
        SELECT *, CASE WHEN len(coalesce(images, [])) > 0 THEN images WHEN coalesce(image, '') <> '' THEN [image]
          ELSE CAST([] AS VARCHAR[]) END AS refs,
          coalesce(nullif(prompt, ''), '이미지를 한국어로 자세히 설명해줘.') AS text
        FROM records""",
    "scored": r"""
        SELECT id, text AS prompt, array_to_string(refs, ',') AS images,
          sha256(CASE WHEN len(refs) > 1 THEN array_to_string(list_transform(range(1, len(refs) + 1),
              lambda i: 'Image-' || i || ': <image>' || chr(10)), '')
            WHEN len(refs) = 1 THEN '<image>' || chr(10) ELSE '' END || text) AS output,
          len(list_filter(refs, lambda r: r LIKE '/%')) > 0 AS failed, refs
        FROM listed""",
    "label_results": r"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS video_id, event_type AS prompt, props AS answer,
          ts AS created_at, value
        FROM events""",
    "keyed": r"""
        SELECT *, sha256('{"video_id":"' || video_id || '","sampling":"d587a6","prompt_version":"' || prompt
          || '","model_version":"/models/teacher","decoding":"t=0.2"}') AS cache_key
        FROM label_results""",
    "label_rules": r"""
        SELECT doc_id, lang, (n_chars % 11 <> 0 AND n_chars % 13 <> 0) AS ok_json,
          n_chars % 11 <> 0 AND NOT contains(text, '```') AS ok_no_fence, n_chars % 8 = 0 OR len(string_split(text, chr(10))) <= 5 AS few_actions, n_chars % 5 <> 0 AS distinct_objects,
          n_chars % 4 IN (1, 2) OR (n_chars % 8 = 0 AND n_chars % 3 = 0) AS good_qa, n_chars % 3 < 2 AS good_confidence
        FROM documents""",
    "label_checks": r"""
        SELECT doc_id, lang, ok_json, ok_no_fence, ok_json AS ok_text, ok_json AND few_actions AS ok_actions,
          ok_json AND distinct_objects AS ok_objects, ok_json AND good_qa AS ok_qa, ok_json AS ok_qa_fields,
          ok_json AND good_confidence AS ok_confidence,
          ok_json AND ok_no_fence AND few_actions AND distinct_objects AND good_qa AND good_confidence AS valid
        FROM label_rules""",
    "said": r"""
        SELECT CAST(conv_id AS VARCHAR) AS video_id, turn // 4 AS probe, turn, text AS answer, (turn // 2) % 2 AS half
        FROM conversations WHERE role = 'assistant'""",
    "pairs": r"""
        SELECT t.video_id, t.probe, t.answer AS teacher_answer, s.answer AS student_answer
        FROM (SELECT video_id, probe, arg_max(answer, turn) AS answer FROM said WHERE half = 0 GROUP BY ALL) t
        JOIN (SELECT video_id, probe, arg_max(answer, turn) AS answer FROM said WHERE half = 1 GROUP BY ALL) s
        USING (video_id, probe)""",
}

NEEDS = {
    "log": ["result_lines"],
    "train": ["log"],
    "manifest": ["shard_rows"],
    "frames": ["manifest"],
    "placed": ["manifest"],
    "listed": ["records"],
    "some_unnamed": ["records"],
    "scored": ["listed"],
    "keyed": ["label_results"],
    "label_checks": ["label_rules"],
    "pairs": ["said"],
}

_WORDS = "list_filter(string_split_regex({text}, '[ \\t\\n\\r\\f]+'), lambda w: w <> '')"
_GRAMS = "list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])"
_STREAMED = ("SELECT id, raw, n_records FROM train", ["train"])
_SCORED = (
    """SELECT id, prompt, CASE WHEN NOT failed THEN images END AS images,
         CASE WHEN NOT failed THEN output END AS output, CASE WHEN NOT failed THEN '/models/teacher' END AS model,
         CASE WHEN failed THEN 'image_load: ' || refs[1] END AS error FROM scored""",
    ["scored"],
)
_CHANGES = (
    """SELECT event_id, video_id, answer, lag(answer) OVER w AS previous_answer,
         lag(answer) OVER w IS NOT NULL AND answer IS DISTINCT FROM lag(answer) OVER w AS changed
       FROM label_results WINDOW w AS (PARTITION BY video_id ORDER BY created_at, event_id)""",
    ["label_results"],
)
_FRAMES_TOLD = (
    """SELECT video_id, 16 AS num_frames, 'uniform' AS sampling, '448x448' AS frame_size, CAST(duration AS BIGINT) AS source_duration,
         array_to_string(frames, ',') AS frames, 'd587a6' AS sampling_config_hash FROM frames""",
    ["frames"],
)
_RUN = "left(sha256(prompt || '|/models/teacher|d587a6'), 12)"
_MEASURES = """
    SELECT probe, teacher_answer = student_answer AS same, len(tw) AS tn, len(sw) AS sn,
      greatest(len(tw) - 1, 0) AS tg, greatest(len(sw) - 1, 0) AS sg,
      greatest(len(tw) - 1, 0) - len(list_distinct({tg})) AS tr, greatest(len(sw) - 1, 0) - len(list_distinct({sg})) AS sr,
      length(regexp_replace(teacher_answer, '[^\\p{{L}}]', '', 'g')) AS tl,
      length(regexp_replace(student_answer, '[^\\p{{L}}]', '', 'g')) AS sl,
      length(regexp_replace(teacher_answer, '[^A-Za-z]', '', 'g')) AS ts,
      length(regexp_replace(student_answer, '[^A-Za-z]', '', 'g')) AS ss
    FROM (SELECT *, {tw} AS tw, {sw} AS sw FROM pairs)
""".format(
    tg=_GRAMS.format(w="tw"),
    sg=_GRAMS.format(w="sw"),
    tw=_WORDS.format(text="teacher_answer"),
    sw=_WORDS.format(text="student_answer"),
)

# The probes as stored.
_PROBE_ROWS = """(VALUES ('caption', '이 프레임들에 무엇이 보이는지 한국어로 설명해줘.'),
    ('temporal', '프레임 순서대로 장면이 어떻게 변하는지 시간 순서대로 한국어로 설명해줘.'),
    ('action', '영상 속 인물이 어떤 동작을 하고 있는지 한국어로 알려줘.'),
    ('sport', '이 영상의 스포츠 종목을 한 단어로만 답해줘.')) AS p(probe, prompt)"""

_TAGS = "array_to_string(list_transform(range(1, 17), lambda i: 'Frame' || i || ': <image>'), chr(10)) || chr(10)"

def _longest_phrase(levels: int = 13) -> str:
    """Runs of 1, 2, 4, ... words that repeat in a document, put together from the longest power downwards."""
    same = "QUALIFY count(*) OVER (PARTITION BY doc_id, id) > 1"
    parts = [
        f"split AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents)",
        f"""run0 AS MATERIALIZED (SELECT doc_id, pos, hash(word) AS id
            FROM (SELECT doc_id, unnest(range(0, len(w))) AS pos, unnest(w) AS word FROM split) {same})""",
        f"best{levels} AS (SELECT doc_id, pos, id, 0 AS n FROM run0 WHERE false)",
    ]
    for j in range(levels - 1):
        parts.append(f"""run{j + 1} AS MATERIALIZED (SELECT a.doc_id, a.pos, hash(a.id, b.id) AS id
            FROM run{j} a JOIN run{j} b ON a.doc_id = b.doc_id AND b.pos = a.pos + {2**j}
            QUALIFY count(*) OVER (PARTITION BY a.doc_id, hash(a.id, b.id)) > 1)""")
    for j in reversed(range(levels)):
        parts.append(f"""more{j} AS MATERIALIZED (SELECT * FROM (
            SELECT c.doc_id, c.pos, hash(c.id, r.id) AS id, c.n + {2**j} AS n
            FROM best{j + 1} c JOIN run{j} r ON r.doc_id = c.doc_id AND r.pos = c.pos + c.n
            UNION ALL SELECT doc_id, pos, hash(id), {2**j} FROM run{j} WHERE doc_id NOT IN (SELECT doc_id FROM best{j + 1})) {same}),
            best{j} AS MATERIALIZED (SELECT * FROM more{j} UNION ALL SELECT * FROM best{j + 1}
            WHERE doc_id NOT IN (SELECT doc_id FROM more{j}))""")
    return f"""WITH {", ".join(parts)},
        told AS (SELECT doc_id, min(pos) AS pos, max(n) AS n, count(*) AS times FROM best0 GROUP BY doc_id, id
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) = 1)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS phrase_words, CAST(coalesce(times, 0) AS BIGINT) AS phrase_times,
          CASE WHEN n > 0 THEN array_to_string(w[pos + 1:pos + n], ' ') END AS phrase
        FROM split LEFT JOIN told USING (doc_id)"""


_SAME_RECORDS = "SELECT doc_id // 10 AS shard, id, coalesce(prompt, chr(0)) AS prompt, coalesce(image, chr(0)) AS image FROM"

BODIES: dict[str, tuple[str, list[str]]] = {
    "longest_phrase": (_longest_phrase(), []),
    "resume_indexed": (
        """SELECT id, prompt, image FROM some_unnamed
           WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM log WHERE id IS NOT NULL)""",
        ["some_unnamed", "log"],
    ),
    "cache_indexed": (
        """SELECT DISTINCT video_id, prompt, cache_key FROM keyed
           WHERE cache_key NOT IN (SELECT cache_key FROM keyed WHERE value >= 150)""",
        ["keyed"],
    ),
    "dev_subset_total": (
        """WITH videos AS (SELECT CAST(doc_id AS VARCHAR) AS video_id, lang AS category,
               CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END AS length,
               contains(text, ':') AS dialogue FROM documents),
             share AS (SELECT category, length, dialogue, count(*) AS n, sum(count(*)) OVER () AS every FROM videos GROUP BY ALL),
             cut AS (SELECT *, (least(40, every) * n) // every AS whole, (least(40, every) * n) % every AS rest FROM share),
             placed AS (SELECT *, row_number() OVER (ORDER BY rest DESC, category NULLS LAST, length NULLS LAST, dialogue NULLS LAST) AS place,
               least(40, every) - sum(whole) OVER () AS spare FROM cut)
           SELECT v.video_id, v.category, v.length, v.dialogue, v.rank FROM (
               SELECT *, CAST(row_number() OVER (PARTITION BY category, length, dialogue ORDER BY sha256(video_id), video_id) AS INTEGER) AS rank
               FROM videos) v JOIN placed p ON v.category IS NOT DISTINCT FROM p.category AND v.length = p.length
               AND v.dialogue IS NOT DISTINCT FROM p.dialogue
           WHERE v.rank <= p.whole + CASE WHEN p.place <= p.spare THEN 1 ELSE 0 END""",
        [],
    ),
    "label_quality_versions": (
        f"""SELECT 'v' || (doc_id % 4) AS prompt_version, count(*) AS n_answers, count(*) FILTER (ok_json) AS n_parsed,
              count(*) FILTER (valid) AS n_valid, count(*) FILTER (ok_json) / count(*) AS parse_rate,
              count(*) FILTER (valid) / count(*) AS valid_rate, count(*) FILTER (paired) AS n_compared,
              count(*) FILTER (paired) / count(*) FILTER (paired) AS agreement_scene,
              count(*) FILTER (paired AND n % 7 <> 0) / count(*) FILTER (paired) AS agreement_camera,
              count(*) FILTER (paired AND n % 3 < 2) / count(*) FILTER (paired) AS agreement_confidence,
              coalesce(sum(len(g) - len(list_distinct(g))) / sum(len(g)), 0.0::DOUBLE) AS repetition_rate
            FROM (SELECT *, CASE WHEN ok_json THEN {_GRAMS.format(w="w")} END AS g FROM (
              SELECT doc_id, ok_json, valid, ok_json AND n_chars % 17 <> 0 AS paired, n_chars AS n, {_WORDS.format(text="text")} AS w
              FROM label_checks JOIN documents USING (doc_id))) GROUP BY 1""",
        ["label_checks"],
    ),
    "reconcile_content": (
        f"""SELECT * FROM (WITH wanted AS ({_SAME_RECORDS} records),
             changed AS (SELECT doc_id, id, CASE WHEN doc_id % 320 BETWEEN 90 AND 91 THEN 'other ' || id ELSE prompt END AS prompt, image
               FROM records WHERE NOT (doc_id % 320 BETWEEN 40 AND 49 AND doc_id % 3 = 0)
               UNION ALL SELECT doc_id, id, prompt, image FROM records WHERE doc_id % 320 = 155
               UNION ALL SELECT doc_id, 'new-' || id, prompt, image FROM records WHERE doc_id % 320 = 211),
             made AS ({_SAME_RECORDS} changed),
             missing AS (SELECT * FROM wanted EXCEPT ALL SELECT * FROM made),
             unexpected AS (SELECT * FROM made EXCEPT ALL SELECT * FROM wanted)
           SELECT shard, (SELECT count(*) FROM wanted w WHERE w.shard = s.shard) AS n_in,
             (SELECT count(*) FROM made m WHERE m.shard = s.shard) AS n_out,
             (SELECT count(*) FROM missing m WHERE m.shard = s.shard) AS rows_missing,
             (SELECT count(*) FROM unexpected u WHERE u.shard = s.shard) AS rows_unexpected,
             (SELECT count(DISTINCT m.id) FROM missing m JOIN unexpected u USING (shard, id) WHERE m.shard = s.shard) AS ids_changed
           FROM (SELECT DISTINCT shard FROM (SELECT shard FROM missing UNION ALL SELECT shard FROM unexpected)) s)""",
        ["records"],
    ),
    "shard_scan_cap": (
        """SELECT p.shard, count(*) AS n, max(place) AS last_row, min(title) AS first_title FROM (
             SELECT row_pos, title, dense_rank() OVER (ORDER BY shard) - 1 AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY row_pos) - 1 AS place FROM shard_rows) p
           WHERE p.shard < 3 GROUP BY p.shard""",
        ["shard_rows"],
    ),
    "manifest_round_trip": (
        "SELECT * EXCLUDE (shard, row_pos) REPLACE (CAST(duration AS DOUBLE) AS duration) FROM manifest", ["manifest"]
    ),
    "shard_log_round_trip": (
        """SELECT id, 'o' || id AS output, prompt, CAST(doc_id % 4 AS INTEGER) AS shard, false AS is_error FROM records""",
        ["records"],
    ),
    "frames_round_trip": _FRAMES_TOLD,
    "frames_objects": _FRAMES_TOLD,
    "jsonl_scan_lenient": (
        """SELECT event_id, id, json_extract_string(raw, '$.prompt') AS prompt,
             json_extract_string(raw, '$.output') AS output, json_extract_string(raw, '$.model') AS model,
             json_extract_string(raw, '$.error') AS error, is_error FROM log""",
        ["log"],
    ),
    "manifest_scan_strict": (
        "SELECT id, prompt, image, array_to_string(images, ',') AS images FROM records",
        ["records"],
    ),
    "merge_train": ("SELECT * FROM train", ["train"]),
    "merge_errors": ("SELECT event_id, id, raw FROM log WHERE is_error", ["log"]),
    "merge_rejects": ("SELECT event_id, raw FROM log WHERE NOT is_error AND id IS NULL", ["log"]),
    "merge_counts": (
        """SELECT count(DISTINCT file) AS n_files, count(DISTINCT id) FILTER (NOT is_error) AS n_ok,
             count(*) FILTER (is_error) AS n_errors, count(*) FILTER (NOT is_error AND id IS NULL) AS n_rejected
           FROM log""",
        ["log"],
    ),
    "resume_pending": (
        """SELECT id, prompt, image FROM some_unnamed
           WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM log WHERE id IS NOT NULL)""",
        ["some_unnamed", "log"],
    ),
    "reconcile_counts": (
        """SELECT CAST(count(r.id) + (SELECT count(*) FROM some_unnamed WHERE id IS NULL) AS BIGINT) AS n_in, CAST(count(t.id) AS BIGINT) AS n_out,
             count(*) FILTER (t.id IS NULL) AS ids_missing, count(*) FILTER (r.id IS NULL) AS ids_unexpected,
             count(*) FILTER (r.id IS NOT NULL AND t.id IS NOT NULL) AS ids_matched,
             (SELECT count(*) FROM some_unnamed WHERE id IS NULL) AS n_in_without_id, CAST(0 AS BIGINT) AS n_out_without_id
           FROM (SELECT id FROM some_unnamed WHERE id IS NOT NULL) r FULL JOIN train t ON r.id = t.id""",
        ["some_unnamed", "train"],
    ),
    "manifest_rejects": ("SELECT doc_id, prompt, image FROM some_unnamed WHERE id IS NULL", ["some_unnamed"]),
    "run_throughput": (
        """SELECT event_type AS prompt, count(*) AS processed,
             date_diff('microsecond', min(ts), max(ts)) / 1000000.0::DOUBLE AS elapsed,
             CASE WHEN max(ts) > min(ts)
               THEN count(*) / (date_diff('microsecond', min(ts), max(ts)) / 1000000.0::DOUBLE) ELSE 0.0 END AS rate
           FROM events GROUP BY event_type""",
        [],
    ),
    "shard_interleave": (
        """SELECT CAST(doc_id AS VARCHAR) AS id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index,
             CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM documents""",
        [],
    ),
    "table_interleave": (
        """SELECT CAST(doc_id AS VARCHAR) AS id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index,
             CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INTEGER) AS shard FROM documents""",
        [],
    ),
    "shard_interleave_awk": (
        """SELECT CAST(doc_id AS VARCHAR) AS id, CAST(row_number() OVER (ORDER BY doc_id) % 4 AS INTEGER) AS shard
           FROM documents""",
        [],
    ),
    "batch_chunks": (
        """SELECT CAST(doc_id AS VARCHAR) AS id, (row_number() OVER (ORDER BY doc_id) - 1) // 48 AS chunk
           FROM documents""",
        [],
    ),
    "scan_nested_project": (
        """SELECT shard, row_pos, parent_category, fine_category, title, duration, resolution,
             title AS youtube_title FROM shard_rows""",
        ["shard_rows"],
    ),
    "category_filter": (
        """SELECT shard, row_pos, parent_category, fine_category, title, duration, resolution,
             title AS youtube_title FROM shard_rows WHERE parent_category = 'en'""",
        ["shard_rows"],
    ),
    "preview_head": (
        """SELECT shard, row_pos, parent_category, fine_category, title, duration, resolution,
             title AS youtube_title FROM shard_rows ORDER BY shard, row_pos LIMIT 5""",
        ["shard_rows"],
    ),
    "category_histogram": ("SELECT lang AS category, count(*) AS n FROM documents GROUP BY lang", []),
    "fine_category_top30": (
        "SELECT source AS category, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 30",
        [],
    ),
    "manifest_build": ("SELECT * FROM manifest", ["manifest"]),
    "manifest_summary": (
        """SELECT 'en' AS category, 'media/en' AS prefix, count(*) AS total_videos, count(DISTINCT shard) AS n_shards
           FROM manifest""",
        ["manifest"],
    ),
    "media_rows": (
        """SELECT CAST(row_pos AS VARCHAR) AS video_id, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS digest,
             title FROM shard_rows WHERE parent_category = 'en'""",
        ["shard_rows"],
    ),
    "media_objects": (
        """SELECT key, CAST(strlen(content) AS BIGINT) AS length, sha256(content) AS digest FROM (
             SELECT video_key AS key, text AS content FROM manifest JOIN documents ON doc_id = row_pos
             UNION ALL SELECT metadata_key, '{"content_parent_category":"en","content_fine_category":"' || fine_category
               || '","content_metadata":{"title":"' || title || '"},"original_video_filename":"src/' || row_pos
               || '.mp4","youtube_channel":"' || channel || '","youtube_title":"' || title || '","youtube_upload_date":"'
               || upload_date || '","duration_seconds":' || duration || ',"resolution":"' || resolution || '"}' FROM manifest)""",
        ["manifest"],
    ),
    "ingest_counts": (
        """SELECT CAST(shard AS VARCHAR) AS shard, n, CAST(sum(n) OVER (ORDER BY shard) AS BIGINT) AS running_total
           FROM (SELECT shard, count(*) AS n FROM manifest GROUP BY shard)
           UNION ALL SELECT 'all', count(*), count(*) FROM manifest""",
        ["manifest"],
    ),
    "ingest_new_only": (
        """SELECT video_id, video_key, shard, place AS row_pos FROM placed
           WHERE row_pos NOT IN (SELECT doc_id FROM labels) AND shard NOT IN (SELECT r_regionkey FROM region)""",
        ["placed"],
    ),
    "media_of_new_shards": (
        """SELECT video_id, sha256(text) AS digest, p.title FROM placed p JOIN documents ON doc_id = row_pos
           WHERE row_pos NOT IN (SELECT doc_id FROM labels) AND shard NOT IN (SELECT r_regionkey FROM region)""",
        ["placed"],
    ),
    "ingest_cap": (
        "SELECT video_id, shard, row_pos FROM manifest ORDER BY shard, row_pos LIMIT 20",
        ["manifest"],
    ),
    "safe_id_first_wins": (
        r"""SELECT shard, row_pos, file_name, row_in_shard,
              CASE WHEN clean <> '' THEN clean ELSE printf('shard%05d_row%06d', shard, row_in_shard) END AS video_id
            FROM (
              SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(file_name, '^.*/', ''),
                  '^(\.*[^.].*)\.[^.]*$', '\1'), '[^A-Za-z0-9_-]', '_', 'g'), '_') AS clean
              FROM (SELECT page_id // 100 AS shard, page_id AS row_pos, url AS file_name,
                      row_number() OVER (PARTITION BY page_id // 100 ORDER BY page_id) - 1 AS row_in_shard FROM pages))
            QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY shard, row_pos) = 1""",
        [],
    ),
    "frames_manifest": (
        """SELECT video_id, 16 AS num_frames, 'uniform' AS sampling, '448x448' AS frame_size,
             duration AS source_duration, array_to_string(frames, ',') AS frames,
             left(sha256('16|uniform|448x448'), 6) AS sampling_config_hash,
             (16000000 // nullif(duration, 0)) / 1000000.0::DOUBLE AS fps,
             1.0::DOUBLE * duration / 16.0::DOUBLE AS second_time, 15.0::DOUBLE * duration / 16.0::DOUBLE AS last_time,
             width, height, (448 - width) // 2 AS pad_x, (448 - height) // 2 AS pad_y
           FROM (SELECT *, least((896 * w + h) // (2 * h), 448) AS width, least((896 * h + w) // (2 * w), 448) AS height
                 FROM (SELECT *, CAST(split_part(resolution, 'x', 1) AS BIGINT) AS w,
                         CAST(split_part(resolution, 'x', 2) AS BIGINT) AS h FROM frames))""",
        ["frames"],
    ),
    "frames_gather_ordered": (
        """SELECT video_id, string_agg(CASE WHEN pos < duration THEN sha256(key) ELSE '-' END, ',' ORDER BY pos) AS contents,
             count(*) FILTER (pos >= duration) AS n_missing
           FROM (SELECT video_id, duration, unnest(frames) AS key, unnest(range(0, 16)) AS pos FROM frames)
           GROUP BY video_id""",
        ["frames"],
    ),
    "resolve_image_uri": (
        r"""SELECT id, pos, reference, CASE WHEN reference LIKE 'https://%' THEN 'https' ELSE 's3' END AS scheme,
              CASE WHEN reference LIKE 's3://%' THEN regexp_extract(reference, '^s3://([^/]*)', 1)
                WHEN reference NOT LIKE 'https://%' THEN 'media-store' END AS bucket,
              CASE WHEN reference LIKE 's3://%' THEN regexp_extract(reference, '^s3://[^/]*/(.*)$', 1)
                WHEN reference LIKE 'https://%' THEN reference
                ELSE 'input/images/' || ltrim(reference, '/') END AS key
            FROM (SELECT id, unnest(refs) AS reference, CAST(unnest(range(0, len(refs))) AS INTEGER) AS pos FROM listed)""",
        ["listed"],
    ),
    "inference_manifest": (
        "SELECT video_id AS id, 'Describe the clip.' AS prompt, array_to_string(frames, ',') AS images FROM frames",
        ["frames"],
    ),
    "prompt_fill": (
        """SELECT video_id, t // 10 || '.' || t % 10 AS frame_interval,
             '16 frames, one every ' || t // 10 || '.' || t % 10 || ' s. Domain: ' || fine_category || '. Look for: '
               || CASE WHEN duration % 2 = 0 THEN channel ELSE '없음' END || '.' AS prompt
           FROM (SELECT *, (duration * 10 + 8) // 16 AS t FROM manifest)""",
        ["manifest"],
    ),
    "probe_expand": (
        f"SELECT video_id, probe, prompt, {_TAGS} || prompt AS content FROM manifest, {_PROBE_ROWS}",
        ["manifest"],
    ),
    "token_budget": (
        """SELECT id, n_frames, tiles, tokens AS image_tokens, tokens < 8192 AS fits_8192,
             coalesce(8192 // nullif(tokens, 0), 0) AS per_batch_8192, tokens < 16384 AS fits_16384,
             coalesce(16384 // nullif(tokens, 0), 0) AS per_batch_16384
           FROM (SELECT id, CAST(len(refs) AS INTEGER) AS n_frames, tiles, CAST(len(refs) * tiles * 256 AS BIGINT) AS tokens
                 FROM listed, (VALUES (1), (12)) AS v(tiles))""",
        ["listed"],
    ),
    "token_budget_summary": (
        """SELECT tiles, count(*) AS n_records, CAST(sum(len(refs) * tiles * 256) AS BIGINT) AS total_tokens,
             count(*) FILTER (len(refs) * tiles * 256 < 8192) AS n_fits_8192,
             count(*) FILTER (len(refs) * tiles * 256 < 16384) AS n_fits_16384
           FROM listed, (VALUES (1), (12)) AS v(tiles) GROUP BY tiles""",
        ["listed"],
    ),
    "probe_infer": (
        f"""SELECT video_id, probe, prompt, sha256({_TAGS} || prompt) AS answer, '/models/teacher' AS model
            FROM manifest, {_PROBE_ROWS}""",
        ["manifest"],
    ),
    "video_infer": (
        f"""SELECT video_id, '/models/teacher' AS model, prompt, sha256({_TAGS} || prompt) AS answer, {_RUN} AS run_id,
             0.2::DOUBLE AS temperature, 0.9::DOUBLE AS top_p, 512 AS max_tokens, 16 AS num_frames,
             '448x448' AS frame_size, 'uniform' AS sampling, 'd587a6' AS sampling_config_hash
           FROM (SELECT video_id, 'Describe the clip.' AS prompt FROM manifest)""",
        ["manifest"],
    ),
    "batch_infer": _SCORED,
    "stream_infer": _SCORED,
    "result_records": (
        f"""SELECT video_id, '/models/teacher' AS model, prompt, answer, {_RUN} AS run_id,
             strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, 0.2::DOUBLE AS temperature, 0.9::DOUBLE AS top_p,
             512 AS max_tokens, 16 AS num_frames, '448x448' AS frame_size, 'uniform' AS sampling,
             'd587a6' AS sampling_config_hash, prompt AS prompt_version, '/models/teacher' AS model_version,
             'd587a6' AS sampling_version
           FROM label_results""",
        ["label_results"],
    ),
    "single_result_store": (
        f"""SELECT video_id, {_RUN} AS run_id, answer, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
           FROM label_results
           QUALIFY row_number() OVER (PARTITION BY video_id, prompt ORDER BY created_at DESC, answer DESC) = 1""",
        ["label_results"],
    ),
    "latest_label": (
        """SELECT video_id, event_id, prompt, answer FROM label_results
           QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY created_at DESC, event_id DESC) = 1""",
        ["label_results"],
    ),
    "label_changes": _CHANGES,
    "label_changes_hot_video": _CHANGES,
    "cache_pending": (
        """SELECT DISTINCT video_id, prompt, cache_key,
             video_id IN (SELECT video_id FROM keyed WHERE value >= 150) AS frames_cached
           FROM keyed WHERE cache_key NOT IN (SELECT cache_key FROM keyed WHERE value >= 150)""",
        ["keyed"],
    ),
    "dev_subset": (
        """SELECT video_id, category, length,
             CAST(row_number() OVER (PARTITION BY category, length ORDER BY sha256(video_id), video_id) AS INTEGER) AS rank
           FROM (SELECT CAST(doc_id AS VARCHAR) AS video_id, lang AS category,
                   CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END AS length
                 FROM documents)
           QUALIFY rank <= 5""",
        [],
    ),
    "label_validate": ("SELECT * EXCLUDE (lang) FROM label_checks", ["label_checks"]),
    "label_quality": (
        """SELECT lang, count(*) AS n_answers, count(*) FILTER (ok_json) AS n_parsed, count(*) FILTER (valid) AS n_valid,
             count(*) FILTER (ok_json) / count(*) AS parse_rate, count(*) FILTER (valid) / count(*) AS valid_rate
           FROM label_checks GROUP BY lang""",
        ["label_checks"],
    ),
    "repetition_rate": (
        f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(g) AS BIGINT) AS n_ngrams,
             CAST(len(g) - len(list_distinct(g)) AS BIGINT) AS n_repeated,
             coalesce((len(g) - len(list_distinct(g))) / nullif(len(g), 0), 0.0::DOUBLE) AS repetition_rate
           FROM (SELECT doc_id, w, {_GRAMS.format(w="w")} AS g
                 FROM (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents))""",
        [],
    ),
    "language_compliance": (
        r"""SELECT doc_id, lang, n_letters, n_script, coalesce(n_script / nullif(n_letters, 0), 0.0::DOUBLE) AS script_share,
              coalesce(n_script / nullif(n_letters, 0), 0.0::DOUBLE) >= 0.95 AS compliant
            FROM (SELECT doc_id, lang, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
                    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_script FROM documents)""",
        [],
    ),
    "field_agreement": (
        """SELECT lang, count(*) AS n_pairs, count(*) FILTER (same_q) AS n_equal_quality,
             count(*) FILTER (same_q) / count(*) AS agreement_quality, count(*) FILTER (same_t) AS n_equal_toxic,
             count(*) FILTER (same_t) / count(*) AS agreement_toxic
           FROM (SELECT lang, l.quality IS NOT DISTINCT FROM CAST(n_chars > 1000 AS INTEGER) AS same_q,
                   l.toxic IS NOT DISTINCT FROM CAST(n_chars < 100 AS INTEGER) AS same_t
                 FROM documents JOIN labels l USING (doc_id))
           GROUP BY lang""",
        [],
    ),
    "teacher_student_join": ("SELECT * FROM pairs", ["pairs"]),
    "teacher_student_report": (
        f"""SELECT probe, count(*) AS n_pairs, count(*) FILTER (same) / count(*) AS agreement,
             coalesce(sum(tr) / nullif(sum(tg), 0), 0.0) AS teacher_repetition,
             coalesce(sum(sr) / nullif(sum(sg), 0), 0.0) AS student_repetition,
             coalesce(sum(ts) / nullif(sum(tl), 0), 0.0) AS teacher_script_share,
             coalesce(sum(ss) / nullif(sum(sl), 0), 0.0) AS student_script_share,
             CAST(sum(tn) AS BIGINT) AS teacher_words, CAST(sum(sn) AS BIGINT) AS student_words
           FROM ({_MEASURES}) GROUP BY probe""",
        ["pairs"],
    ),
    "sft_rows": (
        f"""SELECT m.video_id, category, fine_category, prompt, target, array_to_string(frames, ',') AS frames,
             {_TAGS} || prompt AS content
           FROM manifest m JOIN frames f ON f.video_id = m.video_id JOIN (
             SELECT CAST(a.conv_id AS VARCHAR) AS video_id, a.text AS target, coalesce(u.text, '') AS prompt
             FROM conversations a LEFT JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
             WHERE a.role = 'assistant'
             QUALIFY row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn DESC) = 1) l ON l.video_id = m.video_id""",
        ["manifest", "frames"],
    ),
    "merge_round_trip": ("SELECT id, raw FROM train", ["train"]),
    "stream_merge": _STREAMED,
    "stream_compact": _STREAMED,
    "stream_compact_whole": _STREAMED,
    "stream_progress": (
        """SELECT count(*) AS processed, count(*) FILTER (failed) AS errors, true AS timed
           FROM scored GROUP BY CAST(id AS BIGINT) % 3""",
        ["scored"],
    ),
}


def _with_parts(body: str, parts: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        add(part)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered) + "\n" + body


ORACLES = {name: _with_parts(*spec) for name, spec in BODIES.items()}
