"""The same results in SQL, written from the meaning of each operator, run by DuckDB.

Arrays are handled in long form, one row per element, unlike the queries they check.
"""

from __future__ import annotations

SEED = 12
TWO_PI = "(2e0 * pi())"


def word(digest: str, i: str | int) -> str:
    return f"((('0x' || substr({digest}, 8 * ({i}) + 1, 8))::BIGINT)::DOUBLE + 5e-1) / 4294967296e0"


def digest(seed: int, stream: str, *keys: object) -> str:
    return f"md5(concat_ws('|', '{seed}', '{stream}', {', '.join(str(k) for k in keys)}))"


def u(seed: int, stream: str, *keys: object) -> str:
    return f"({word(digest(seed, stream, *keys), 0)})"


def h(key: str, tag: str) -> str:
    return u(0, tag, key)


def normal(seed: int, stream: str, *keys: object) -> str:
    d = digest(seed, stream, *keys)
    return f"(sqrt(-2e0 * ln({word(d, 0)})) * cos({TWO_PI} * {word(d, 1)}))"


def normal_at(pos: str, seed: int, stream: str, *keys: object) -> str:
    """Element ``pos`` of a row's noise array."""
    d = digest(seed, stream, *keys, f"{pos} // 4")
    pair = f"2 * (({pos} % 4) // 2)"
    angle = f"{TWO_PI} * {word(d, pair + ' + 1')}"
    wave = f"CASE WHEN {pos} % 2 = 0 THEN cos({angle}) ELSE sin({angle}) END"
    return f"(sqrt(-2e0 * ln({word(d, pair)})) * {wave})"


def sigmoid(x: str) -> str:
    return f"(1e0 / (1e0 + exp(-({x}))))"


def r(x: str, digits: int = 6) -> str:
    return f"(round({x}, {digits}) + 0e0)"


def poly(coefficients: list[str], x: str) -> str:
    text = coefficients[0]
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c})"
    return text


def shuffle_order(seed: int, stream: str, *keys: object) -> str:
    return f"substr({digest(seed, stream, *keys)}, 1, 16)"


def inverse_normal(p: str) -> str:
    # The published coefficients of Acklam's approximation.
    a = ["-3.969683028665376e1", "2.209460984245205e2", "-2.759285104469687e2",
         "1.383577518672690e2", "-3.066479806614716e1", "2.506628277459239e0"]
    b = ["-5.447609879822406e1", "1.615858368580409e2", "-1.556989798598866e2",
         "6.680131188771972e1", "-1.328068155288572e1", "1e0"]
    c = ["-7.784894002430293e-3", "-3.223964580411365e-1", "-2.400758277161838e0",
         "-2.549732539343734e0", "4.374664141464968e0", "2.938163982698783e0"]
    d = ["7.784695709041462e-3", "3.224671290700398e-1", "2.445134137142996e0",
         "3.754408661907416e0", "1e0"]
    s = f"(({p} - 5e-1) * ({p} - 5e-1))"
    lo, hi = f"sqrt(-2e0 * ln({p}))", f"sqrt(-2e0 * ln(1e0 - {p}))"
    return (
        f"(CASE WHEN {p} < 2.425e-2 THEN {poly(c, lo)} / {poly(d, lo)} "
        f"WHEN {p} > 1e0 - 2.425e-2 THEN -({poly(c, hi)} / {poly(d, hi)}) "
        f"ELSE {poly(a, s)} * ({p} - 5e-1) / {poly(b, s)} END)"
    )


# Inputs, as common table expressions

LAT = """lat AS (SELECT vec_id AS id, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos,
  unnest(embedding)::DOUBLE AS x FROM embeddings)"""
MANIFEST = """manifest AS (SELECT page_id AS id, url,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS caption,
  regexp_extract(url, '^https?://([^/]+)', 1) AS source FROM pages)"""
PAYLOADS = f"""payloads AS (SELECT page_id AS id, html AS data, {h('page_id', 'e')} * 1e1 AS elapsed_s
  FROM pages WHERE {h('page_id', 'p')} < 8e-1)"""
MEMBERS = f"""members AS (SELECT event_id AS id,
  CASE WHEN {h('event_id', 'bad')} < 2e-2 THEN replace(props, ':', '')
       WHEN {h('event_id', 'bad')} < 4e-2 THEN replace(props, 'k', 'x') ELSE props END AS json,
  CASE WHEN {h('event_id', 'suffix')} < 3e-1 THEN 'text' WHEN {h('event_id', 'suffix')} < 6e-1
       THEN 'tensor' ELSE 'raw' END AS kind FROM events)"""
CAPTION_OF = """read AS (SELECT id, json_valid(json) AS fine,
  CASE WHEN json_valid(json) THEN json_extract_string(json, '$.k') END AS caption FROM members)"""
SAMPLES = """samples AS (SELECT doc_id AS id, text, embedding, vec_id FROM documents
  JOIN embeddings ON vec_id = doc_id % (SELECT count(*) FROM embeddings))"""
SHARDED = f"""{SAMPLES},
  sharded AS (SELECT id, vec_id, ((row_number() OVER (ORDER BY id) - 1) // 50)::INTEGER AS shard FROM samples)"""
NUMBERED = "numbered AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)"
TOKENS = """toks AS (SELECT doc_id AS id, text,
  list_filter(string_split_regex(text, '[ \\n]'), lambda t: t <> '') AS t FROM documents)"""
VOCAB = f"""{TOKENS}, counted AS (SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM toks) GROUP BY token),
  vocab AS (SELECT token, (row_number() OVER (ORDER BY n DESC, token))::INTEGER AS id, n
    FROM counted ORDER BY n DESC, token LIMIT 1000)"""
ENCODED = f"""{VOCAB}, placed AS (SELECT id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM toks),
  enc AS (SELECT d.id, d.pos::INTEGER AS pos, coalesce(v.id, 0)::INTEGER AS token_id
  FROM (SELECT id, unnest(range(128)) AS pos FROM toks) d
  LEFT JOIN (SELECT * FROM placed WHERE pos < 128) w ON w.id = d.id AND w.pos = d.pos
  LEFT JOIN vocab v ON v.token = w.token)"""
# All tokens of a text, without cut or padding; a text without tokens has no row.
WHOLE = f"""{VOCAB}, placed AS (SELECT id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM toks),
  whole AS (SELECT p.id, p.pos::INTEGER AS pos, coalesce(v.id, 0)::INTEGER AS token_id
    FROM placed p LEFT JOIN vocab v USING (token))"""
VECTORS = f"""{LAT}, {WHOLE}, wrapped AS (SELECT id, pos, token_id, token_id % n AS row
    FROM whole CROSS JOIN (SELECT count(*) AS n FROM embeddings)),
  vecs AS (SELECT e.id, e.pos, e.token_id, l.pos AS dim, l.x FROM wrapped e JOIN lat l ON l.id = e.row)"""
STEP_LOG = f"""steps AS (SELECT event_id AS step, event_id // 1000 AS epoch, {h('event_id', 't')} AS t,
  value AS loss FROM events)"""
T = sigmoid(normal(SEED, "t", 0, "id"))
FLOW = f"""{LAT}, flow AS (SELECT id, pos, x, (x - 1.159e-1) * 3.611e-1 AS y, {T} AS t,
  {normal_at('pos', SEED, 'eps', 0, 'id')} AS eps FROM lat)"""
LOSSES = f"""{FLOW}, losses AS (SELECT id, min(t) AS t,
  sum((eps - y - 5e-1 * x) * (eps - y - 5e-1 * x)) / count(*) AS loss FROM flow GROUP BY id)"""
MOVES = f"""{LAT}, moves AS (SELECT id AS key, pos, x, s.step, x * cos(s.step::DOUBLE) AS v
  FROM lat CROSS JOIN (SELECT unnest(range(1, 51))::INTEGER AS step) s),
  states AS (SELECT key, pos, x, step, v,
    x - sum(v / 5e1) OVER (PARTITION BY key, pos ORDER BY step) AS z FROM moves)"""
PATCHES = f"""{LAT}, spots AS (SELECT id, x, pos // 16 AS c, (pos // 4) % 4 AS row, pos % 4 AS col FROM lat),
  patches AS (SELECT id, ((row // 2) * 2 + col // 2)::INTEGER AS patch,
    (((row % 2) * 2 + col % 2) * 4 + c)::INTEGER AS pos, x FROM spots)"""
SIZES = f"""sizes AS (SELECT page_id AS id, (64 + floor({h('page_id', 'w')} * 96e1))::INTEGER AS w,
  (64 + floor({h('page_id', 'h')} * 96e1))::INTEGER AS h,
  CASE WHEN {h('page_id', 'fmt')} < 7e-1 THEN 'jpg' ELSE 'png' END AS format FROM pages)"""
PIXELS = f"{LAT}, px AS (SELECT id, pos, floor(x * 127e0 + 128e0)::INTEGER AS p FROM lat)"
PREPARED = f"""{LAT}, {ENCODED},
  raw AS (SELECT doc_id AS id, 'img/' || doc_id AS url, text, {h('doc_id', 'broken')} AS b,
    vec_id IS NOT NULL AS has_latent FROM documents LEFT JOIN embeddings ON vec_id = doc_id)"""


def digests(keys: str, x: str, source: str, total: str, dot: str) -> str:
    """Sum and weighted sum of a long table's elements, per key."""
    return (
        f"SELECT {keys}, {r(f'sum({x})')} AS {total}, {r(f'sum({x} * (pos + 1))')} AS {dot} "
        f"FROM {source} GROUP BY {keys}"
    )


def lr(step: str, max_steps: int) -> str:
    warm = max_steps // 20
    cosine = f"greatest(0e0, 5e-1 * (1e0 + cos(pi() * ({step} - {warm}) / {max_steps - warm}e0)))"
    return f"(CASE WHEN {step} < {warm} THEN ({step}) / {warm}e0 ELSE {cosine} END * 1e-4)"


def bf16(x: str) -> str:
    unit = f"(CASE WHEN {x} = 0 THEN 1e0 ELSE pow(2e0, floor(log2(abs({x}))) - 7) END)"
    return f"(round_even({x} / {unit}, 0) * {unit})"


STRATUM = f"(pos / n::DOUBLE + {u(SEED, 't', 0, 'id')} / n)"
DRAWS = f"""{SHARDED}, listed AS (SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS nth
    FROM (SELECT DISTINCT shard FROM sharded)),
  draws AS (SELECT draw, floor({u(SEED, 'shard', 3, 'draw')} * (SELECT count(*) FROM listed))::BIGINT AS nth
    FROM (SELECT unnest(range((SELECT count(*) FROM listed))) AS draw)),
  drawn AS (SELECT draw, shard, id FROM draws JOIN listed USING (nth) JOIN sharded USING (shard))"""
MANIFEST_ALL = f"WITH {MANIFEST} SELECT id, url, caption, source FROM manifest"
TOKEN_IDS = f"WITH {ENCODED} SELECT id, pos, token_id FROM enc"
NORMALIZED = f"WITH {LAT} SELECT id, pos, {r('(x - 1.159e-1) * 3.611e-1')} AS value FROM lat"
PLAIN = f"WITH {LAT} SELECT id, pos, {r('x')} AS value FROM lat"
PATCHED = f"WITH {PATCHES} SELECT id, patch, pos, {r('x')} AS value FROM patches"
RUN_LOG = f"""log AS (SELECT event_id % 3 AS run, event_id // 3 AS step, event_id // 3 // 500 AS epoch,
  {h('event_id', 't')} AS t, value AS loss, ts FROM events)"""
WINDOWS = f"""WITH {RUN_LOG}, placed AS (SELECT *, (step + 99) // 100 AS "window" FROM log),
  windows AS (SELECT run, "window", count(*) AS steps FROM placed GROUP BY 1, 2)
  SELECT w.run, w."window", b.bin, {r('coalesce(sum(loss), 0e0) / greatest(count(step), 1)')} AS loss, count(step) AS n
  FROM windows w CROSS JOIN (SELECT unnest(range(10))::INTEGER AS bin) b
  LEFT JOIN placed p ON p.run = w.run AND p."window" = w."window" AND least(floor(t * 10), 9) = b.bin
  {{where}} GROUP BY w.run, w."window", b.bin"""


def filled(epoch: int, tag: str = "") -> str:
    """Draws of an epoch until their rows reach its items, and the rows they give."""
    return f"""draws{tag} AS (SELECT draw, floor({u(SEED, 'shard', epoch, 'draw')} * (SELECT count(*) FROM listed))::BIGINT AS nth
    FROM (SELECT unnest(range((SELECT items FROM goal) // (SELECT min(n) FROM listed) + 1)) AS draw)),
  begun{tag} AS (SELECT draw, shard, (sum(n) OVER (ORDER BY draw) - n)::BIGINT AS start FROM draws{tag} JOIN listed USING (nth)),
  turns{tag} AS (SELECT draw, id, start + place AS idx FROM begun{tag} JOIN inside USING (shard)
    WHERE start + place < (SELECT items FROM goal))"""


def lists(items: str) -> str:
    return f"""{SHARDED}, goal AS (SELECT {items} AS items FROM sharded),
  listed AS (SELECT shard, count(*) AS n, row_number() OVER (ORDER BY shard) - 1 AS nth FROM sharded GROUP BY shard),
  inside AS (SELECT shard, id, row_number() OVER (PARTITION BY shard ORDER BY id) - 1 AS place FROM sharded)"""


FILLED = f"{lists('(count(*) * 3 // 2 + 7) // 16 * 16')}, {filled(3)}"
PLANNED = f"""{FILLED},
      places AS (SELECT id, (idx // 100) * 100 + row_number() OVER (PARTITION BY idx // 100
        ORDER BY {shuffle_order(SEED, 'shuffle', 3, 'draw', 'id')}, draw, id) - 1 AS place FROM turns)"""
EVALUATED = f"""{SAMPLES}, {LAT},
      firsts AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM samples),
      used AS (SELECT id, place // 16 AS batch_id, (place // 16) || '-' || (place % 16) AS slot
        FROM firsts),
      el AS (SELECT batch_id, slot, {sigmoid(normal(SEED, 't', 0, 'slot'))} AS t,
        {normal_at('pos', SEED, 'eps', 0, 'slot')} - (x - 1.159e-1) * 3.611e-1 AS v FROM used JOIN samples USING (id) JOIN lat ON lat.id = vec_id),
      losses AS (SELECT batch_id, slot, min(t) AS t, sum(v * v) / count(*) AS loss FROM el GROUP BY batch_id, slot)"""
PREPARED_ROWS = f"""WITH {PREPARED} SELECT id, url, caption_md5, n_ids, ids_dot, latent_dot FROM
  (SELECT id, url, md5(text) AS caption_md5 FROM raw WHERE b >= 1e-1)
  JOIN (SELECT id, count(*)::INTEGER AS n_ids, {r('sum(token_id * (pos + 1))::DOUBLE')} AS ids_dot
    FROM enc GROUP BY id) USING (id)
  JOIN (SELECT id, {r('sum((x - 1.159e-1) * 3.611e-1 * (pos + 1))')} AS latent_dot FROM lat GROUP BY id)
    USING (id)"""
COND = """cond AS (SELECT doc_id AS id, l.id IS NOT NULL AS is_conditional, d.pos,
    coalesce(l.x, {fill}) AS x
  FROM documents CROSS JOIN (SELECT unnest(range(64)) AS pos) d
  LEFT JOIN lat l ON l.id = doc_id AND l.pos = d.pos {extra})"""

ORACLES: dict[str, str] = {
    "loss_profile": f"""WITH {FLOW},
      per_sample AS (SELECT id, min(t) AS t, sum((eps - y) * (eps - y)) / count(*) AS loss FROM flow GROUP BY id)
      SELECT b.bin, {r('coalesce(sum(loss), 0e0) / greatest(count(id), 1)')} AS loss, count(id) AS n
      FROM (SELECT unnest(range(10))::INTEGER AS bin) b
      LEFT JOIN per_sample ON least(floor(t * 10), 9) = b.bin GROUP BY b.bin""",
    "plan_epoch": f"""WITH {PLANNED}
      SELECT place // 16 AS batch_id, (place % 16)::INTEGER AS pos, id FROM places""",
    "plan_epoch_one_pass": f"""WITH {SHARDED},
      turns AS (SELECT id, shard AS draw, row_number() OVER (ORDER BY shard, id) - 1 AS idx FROM sharded),
      places AS (SELECT id, (idx // 100) * 100 + row_number() OVER (PARTITION BY idx // 100
        ORDER BY {shuffle_order(SEED, 'shuffle', 3, 'draw', 'id')}, draw, id) - 1 AS place FROM turns)
      SELECT place // 16 AS batch_id, (place % 16)::INTEGER AS pos, id FROM places
      WHERE place // 16 < ((SELECT count(*) FROM sharded) - 5) // 16""",
    "place_shards": f"""WITH {SHARDED}, dealt AS (SELECT id, shard, (shard % 3)::INTEGER AS node,
      ((shard // 3) % 2)::INTEGER AS worker FROM sharded) SELECT *, node * 2 + worker AS task FROM dealt""",
    "batch_stream": f"""WITH {lists('count(*) * 3 // 2 + 7')}, {filled(3)}, {filled(4, '_4')},
      seen AS (SELECT draw % 3 AS worker, 3 AS epoch, idx, id FROM turns
        UNION ALL SELECT draw % 3, 4, idx, id FROM turns_4),
      placed AS (SELECT worker, id, row_number() OVER (PARTITION BY worker ORDER BY epoch, idx) - 1 AS place,
        count(*) OVER (PARTITION BY worker) AS n FROM seen)
      SELECT worker, place // 16 AS batch_id, (place % 16)::INTEGER AS pos, id FROM placed WHERE place // 16 < n // 16""",
    "log_windows": WINDOWS.format(where=""),
    "log_windows_stream": WINDOWS.format(where='WHERE w.steps = CASE w."window" WHEN 0 THEN 1 ELSE 100 END'),
    "eval_records": f"""WITH {RUN_LOG}, turned AS (SELECT *, step // 50 AS turn, step % 50 AS place FROM log),
      begun AS (SELECT run, turn, min(ts) AS ts FROM turned WHERE place >= 40 GROUP BY run, turn),
      steps AS (SELECT run, turn * 40 + place AS step, epoch, ts FROM turned WHERE place < 40),
      used AS (SELECT run, turn, (place - 40) // 2 AS batch_id, least(floor(t * 10), 9) AS bin, loss
        FROM turned WHERE place >= 40 AND (place - 40) // 2 < 4),
      means AS (SELECT run, turn, avg(loss) AS loss FROM
        (SELECT run, turn, batch_id, avg(loss) AS loss FROM used GROUP BY ALL) GROUP BY ALL),
      bins AS (SELECT run, turn, {', '.join(f"{r(f'coalesce(avg(loss) FILTER (bin = {i}), 0e0)')} AS bin_{i}" for i in range(10))}
        FROM used GROUP BY run, turn)
      SELECT e.run, coalesce(s.step + 1, 0) AS step, s.epoch, coalesce(s.step + 1, 0) * 64 AS datapoints,
        {r('m.loss')} AS loss, b.* EXCLUDE (run, turn)
      FROM begun e ASOF LEFT JOIN steps s ON e.run = s.run AND e.ts >= s.ts
      JOIN means m ON m.run = e.run AND m.turn = e.turn JOIN bins b ON b.run = e.run AND b.turn = e.turn""",
    "roll_shards": """WITH RECURSIVE rows AS (SELECT doc_id AS id, coalesce(strlen(text), 0) AS bytes,
        row_number() OVER (ORDER BY doc_id) AS place FROM documents),
      rolled AS (SELECT 0::BIGINT AS place, NULL::BIGINT AS id, 0 AS shard, 0::BIGINT AS n, 0::BIGINT AS held
        UNION ALL SELECT r.place, r.id, CASE WHEN n >= 40 OR held >= 60000 THEN shard + 1 ELSE shard END,
          CASE WHEN n >= 40 OR held >= 60000 THEN 1 ELSE n + 1 END,
          CASE WHEN n >= 40 OR held >= 60000 THEN r.bytes ELSE held + r.bytes END
        FROM rolled JOIN rows r ON r.place = rolled.place + 1)
      SELECT id, shard FROM rolled WHERE place > 0""",
    "attach_arrivals": f"""WITH {MANIFEST}, {PAYLOADS}
      SELECT m.id, url, CASE WHEN data IS NOT NULL THEN 'ok' ELSE 'timeout' END AS status, strlen(data) AS n_bytes,
        md5(data) AS data_md5
      FROM manifest m LEFT JOIN (SELECT * FROM payloads WHERE floor(elapsed_s * 1e6) <= 8e6) p ON m.id = p.id""",
    "read_tar_range": f"""WITH {MANIFEST}, files AS (SELECT lpad((id // 50)::VARCHAR, 5, '0') AS shard,
        lpad(id::VARCHAR, 9, '0') AS key, caption, html FROM manifest JOIN pages ON id = page_id)
      SELECT shard, key, 'jpg' AS ext, md5(html) AS data_md5 FROM files WHERE shard > '00000'
      UNION ALL SELECT shard, key, 'json', NULL FROM files
      WHERE shard > '00000'""",
    "prepare_observed": f"""WITH {PREPARED}, v AS (SELECT CASE WHEN b < 5e-2 THEN 'bad_json' WHEN b < 1e-1 THEN 'no_caption'
      WHEN has_latent THEN 'ok' ELSE 'no_latent' END AS verdict FROM raw) SELECT verdict, count(*) AS n FROM v GROUP BY 1""",
    "train_epoch": f"""WITH {PLANNED}, {LAT},
      slots AS (SELECT id, place // 16 + 1000 AS step, (place // 16) || '-' || (place % 16) AS slot FROM places),
      el AS (SELECT step, slot, {normal_at('pos', SEED, 'eps', 3, 'slot')} - (x - 1.159e-1) * 3.611e-1 AS v
        FROM slots JOIN samples USING (id) JOIN lat ON lat.id = vec_id),
      per AS (SELECT step, slot, sum(v * v) / count(*) AS loss FROM el GROUP BY step, slot)
      SELECT step, 3 AS epoch, {r('avg(loss)')} AS loss, count(*) AS n,
        count_if({u(SEED, 'dropout', 3, 'slot')} <= 1e-1)::BIGINT AS kept FROM per GROUP BY step""",
    "evaluate_summary": f"""WITH {EVALUATED}, b AS (SELECT batch_id, avg(loss) AS loss FROM losses GROUP BY 1)
      SELECT {r('avg(loss)')} AS loss, count(*) AS batches FROM b""",
    "evaluate_bins": f"""WITH {EVALUATED} SELECT b.bin,
      {r('coalesce(sum(loss), 0e0) / greatest(count(slot), 1)')} AS loss, count(slot) AS n
      FROM (SELECT unnest(range(10))::INTEGER AS bin) b LEFT JOIN losses ON least(floor(t * 10), 9) = b.bin
      GROUP BY b.bin""",
    "decode_steps": f"""WITH {MOVES}, w AS (SELECT key, step, pos, x, 5e-1 * v + 4e0 * (v - 5e-1 * v) AS g FROM moves),
      seen AS (SELECT id AS key, 0 AS step, pos, x AS z FROM lat UNION ALL
        SELECT key, step, pos, x - sum(g / 5e1) OVER (PARTITION BY key, pos ORDER BY step)
          + g / 5e1 - (51 - step) * g / 5e1 FROM w),
      y AS (SELECT key, step, pos, z / 3.611e-1 + 1.159e-1 AS l FROM seen)
      SELECT key, step, {r('sum(l * (pos + 1))')} AS latent_dot,
        {r('sum(trunc(least(1e0, greatest(0e0, l * 5e-1 + 5e-1)) * 255e0) * (pos + 1))')} AS pixel_dot
      FROM y GROUP BY key, step""",
    "build_samples": f"""WITH {MANIFEST}, p AS (SELECT id, caption,
        row_number() OVER (ORDER BY id) - 1 AS idx, lpad((id // 50)::VARCHAR, 5, '0') AS source_shard,
        lpad(id::VARCHAR, 9, '0') AS source_key, [strlen(html) / 1e3, strlen(caption) / 1e1] AS s
        FROM manifest JOIN pages ON id = page_id),
      q AS (SELECT *, source_shard || '/' || source_key AS name FROM p),
      e AS (SELECT *, (s[1]::FLOAT::DOUBLE + 5e-1 * {normal_at('0', SEED, 'latent', 'name')})::FLOAT::DOUBLE AS a,
        (s[2]::FLOAT::DOUBLE + 25e-2 * {normal_at('1', SEED, 'latent', 'name')})::FLOAT::DOUBLE AS b,
        s[2]::FLOAT::DOUBLE AS c, s[1]::FLOAT::DOUBLE AS d FROM q)
      SELECT lpad((idx // 64)::VARCHAR, 6, '0') || '_' || (idx % 64) AS key, (idx // 50)::INTEGER AS shard,
        source_shard, source_key, caption, {r(bf16('a'), 9)} AS latent_0, {r(bf16('b'), 9)} AS latent_1,
        {r(bf16('c'), 9)} AS prompt_0, {r(bf16('d'), 9)} AS prompt_1 FROM e""",
    "prepare_stream": PREPARED_ROWS,
    "prepare_batch": PREPARED_ROWS,
    "prepare_stream_rejected": f"""WITH {PREPARED} SELECT id, url,
      CASE WHEN b < 5e-2 THEN 'bad_json' WHEN b < 1e-1 THEN 'no_caption' ELSE 'no_latent' END AS reason
      FROM raw WHERE b < 1e-1 OR NOT has_latent""",
    "loss_monitor": f"""WITH timed AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, value AS loss,
        least(floor({h('event_id', 't')} * 10), 9)::INTEGER AS bin FROM events)
      SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, bin,
        {r('avg(loss)')} AS loss, count(*) AS n FROM timed
      WHERE window_start + INTERVAL 1 HOUR <=
        (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
      GROUP BY window_start, bin""",
    "load_metadata_shards": MANIFEST_ALL,
    "project_manifest": MANIFEST_ALL,
    "write_manifest": f"""WITH {MANIFEST} SELECT id, url, caption, source,
      (SELECT count(*) FROM pages) AS n_written FROM manifest""",
    "attach_payloads": f"""WITH {MANIFEST}, {PAYLOADS}, joined AS (SELECT m.id, url, data,
        CASE WHEN elapsed_s > 8e0 THEN 'timeout' WHEN data IS NULL THEN 'missing' ELSE 'ok' END AS status
        FROM manifest m LEFT JOIN payloads p ON m.id = p.id)
      SELECT id, url, status, CASE WHEN status = 'ok' THEN strlen(data) END AS n_bytes,
        CASE WHEN status = 'ok' THEN md5(data) END AS data_md5 FROM joined""",
    "ingest_retry": f"""WITH {MANIFEST}, {PAYLOADS} SELECT m.id, url, caption, source,
        CASE WHEN elapsed_s > 8e0 THEN 'timeout' ELSE 'missing' END AS status, (SELECT count(*) FROM pages) AS n_manifest
      FROM manifest m LEFT JOIN payloads p ON m.id = p.id WHERE elapsed_s IS NULL OR elapsed_s > 8e0""",
    "ingest_raw_shards": f"""WITH {MANIFEST}, {PAYLOADS}, {SIZES}, s AS (SELECT *, least(w, h) > 256 AS resized,
        256e0 / least(w, h) AS scale FROM sizes),
      good AS (SELECT m.id, url, md5(data) AS data_md5,
        CASE WHEN resized THEN round_even(w * scale, 0) ELSE w END::INTEGER AS out_w,
        CASE WHEN resized THEN round_even(h * scale, 0) ELSE h END::INTEGER AS out_h, resized,
        resized OR format <> 'jpg' AS reencode
        FROM manifest m JOIN payloads p ON m.id = p.id JOIN s ON s.id = m.id WHERE elapsed_s <= 8e0)
      SELECT *, least(50, (SELECT count(*) FROM good)) AS most, ((SELECT count(*) FROM good) + 49) // 50 AS shards FROM good""",
    "retry_list": f"""WITH {MANIFEST}, {PAYLOADS} SELECT id, url FROM manifest
      WHERE id NOT IN (SELECT id FROM payloads WHERE elapsed_s <= 8e0)""",
    "import_tar_shards": f"""WITH {MANIFEST} SELECT lpad((id // 50)::VARCHAR, 5, '0') AS shard,
        lpad(id::VARCHAR, 9, '0') AS key, caption, strlen(html) AS jpg_bytes, md5(html) AS jpg_md5,
        false AS has_png FROM manifest JOIN pages ON id = page_id""",
    "decode_members": f"""WITH {MEMBERS} SELECT id, kind, CASE WHEN kind = 'text' THEN json END AS text
      FROM members""",
    "write_sample_shards": f"""WITH {SHARDED}, {LAT} SELECT id, shard, lpad(shard::VARCHAR, 6, '0') AS name,
      x_sum FROM sharded JOIN (SELECT id AS vec_id, {r('sum(x)')} AS x_sum FROM lat GROUP BY id) USING (vec_id)""",
    "write_arrival_shards": f"WITH {NUMBERED} SELECT id, (idx // 50)::INTEGER AS shard FROM numbered",
    "read_shard_range": f"WITH {SHARDED} SELECT id, shard FROM sharded WHERE shard BETWEEN 1 AND 3",
    "count_assets": f"""SELECT CASE WHEN {h('page_id', 'ext')} < 7e-1 THEN 'jpg' ELSE 'png' END AS ext,
      count(*) AS n FROM pages GROUP BY 1""",
    "pick_first": f"""SELECT page_id AS id, md5(CASE WHEN {h('page_id', 'jpg')} < 5e-1 THEN html
      WHEN {h('page_id', 'png')} < 5e-1 THEN url END) AS image_md5 FROM pages""",
    "extract_caption": f"WITH {MEMBERS}, {CAPTION_OF} SELECT id, caption FROM read",
    "split_valid": f"""WITH {MEMBERS}, {CAPTION_OF} SELECT id, CASE WHEN NOT fine THEN 'bad_json'
      WHEN caption IS NULL THEN 'no_caption' ELSE 'ok' END AS verdict FROM read""",
    "reject_counts": f"""WITH {MEMBERS}, {CAPTION_OF} SELECT CASE WHEN NOT fine THEN 'bad_json'
      ELSE 'no_caption' END AS reason, count(*) AS n FROM read WHERE NOT fine OR caption IS NULL GROUP BY 1""",
    "with_index": "SELECT doc_id AS id, row_number() OVER (ORDER BY text, doc_id) - 1 AS idx FROM documents",
    "with_sample_key": f"""WITH {SAMPLES}, n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM samples)
      SELECT id, idx, lpad((idx // 64)::VARCHAR, 6, '0') || '_' || (idx % 64) AS key FROM n""",
    "assemble_samples": f"""WITH {LAT}, {SAMPLES} SELECT lpad((id // 64)::VARCHAR, 6, '0') || '_' || (id % 64) AS key,
        id, {r('latent_dot')} AS latent_dot, {r('2e0 * latent_dot')} AS prompt_dot, md5(text) AS caption_md5
      FROM samples JOIN (SELECT id, sum(x * (pos + 1)) AS latent_dot FROM lat GROUP BY id) USING (id)""",
    "to_training_pair": f"""WITH {LAT}, {SAMPLES} SELECT lpad((id // 64)::VARCHAR, 6, '0') || '_' || (id % 64) AS key,
        {r('latent_dot')} AS latent_dot, {r('2e0 * latent_dot')} AS prompt_dot
      FROM samples JOIN (SELECT id, sum(x * (pos + 1)) AS latent_dot FROM lat GROUP BY id) USING (id)""",
    "round_bf16": f"""WITH {LAT}, scaled AS (SELECT id, pos, x,
        CASE WHEN x = 0 THEN 1e0 ELSE pow(2e0, floor(log2(abs(x))) - 7) END AS unit FROM lat)
      SELECT id, pos, {r('round_even(x / unit, 0) * unit', 9)} AS value FROM scaled""",
    "split_by_shard": f"""WITH {SHARDED} SELECT id, shard,
      CASE WHEN shard = (SELECT max(shard) FROM sharded) THEN 'test' ELSE 'train' END AS part FROM sharded""",
    "plan_ingest_resize": f"""WITH {SIZES}, s AS (SELECT *, least(w, h) > 256 AS resized,
        256e0 / least(w, h) AS scale FROM sizes)
      SELECT id, w, h, format, CASE WHEN resized THEN round_even(w * scale, 0) ELSE w END::INTEGER AS out_w,
        CASE WHEN resized THEN round_even(h * scale, 0) ELSE h END::INTEGER AS out_h, resized,
        resized OR format <> 'jpg' AS reencode FROM s""",
    "plan_center_crop": f"""WITH {SIZES}, s AS (SELECT id, w, h,
        CASE WHEN w <= h THEN 256 ELSE 256 * w // h END::INTEGER AS resized_w,
        CASE WHEN w <= h THEN 256 * h // w ELSE 256 END::INTEGER AS resized_h FROM sizes)
      SELECT *, round_even((resized_h - 256) / 2e0, 0)::INTEGER AS crop_top,
        round_even((resized_w - 256) / 2e0, 0)::INTEGER AS crop_left, 256 AS crop_size FROM s""",
    "normalize_pixels": f"WITH {PIXELS} SELECT id, pos, {r('(p / 255e0 - 5e-1) / 5e-1')} AS value FROM px",
    "denormalize_pixels": f"""WITH {PIXELS}, back AS (SELECT id, pos, (p / 255e0 - 5e-1) / 5e-1 AS y FROM px)
      SELECT id, pos, trunc(least(1e0, greatest(0e0, y * 5e-1 + 5e-1)) * 255e0)::INTEGER AS value FROM back""",
    "build_vocab": f"WITH {VOCAB} SELECT token, id, n FROM vocab",
    "encode_fixed_length": TOKEN_IDS,
    "encode_in_place": TOKEN_IDS,
    "encode_whole": f"WITH {WHOLE} SELECT id, pos, token_id FROM whole",
    "expand_prompts": """SELECT doc_id AS id, c.copy::INTEGER AS copy, md5(text) AS caption_md5
      FROM documents CROSS JOIN (SELECT unnest(range(3)) AS copy) c""",
    "lookup_embeddings": f"""WITH {VECTORS} SELECT id, pos, token_id, {r('sum(x * (dim + 1))')} AS vec_dot
      FROM vecs GROUP BY id, pos, token_id""",
    "mean_pool": f"WITH {VECTORS} SELECT id, dim AS pos, {r('avg(x)')} AS value FROM vecs GROUP BY id, dim",
    "mean_pool_masked": f"""WITH {VECTORS} SELECT id, dim AS pos,
      {r('coalesce(avg(x) FILTER (WHERE token_id <> 0), 0e0)')} AS value FROM vecs GROUP BY id, dim""",
    "encode_batches": f"WITH {LAT} SELECT id, pos, {r('2e0 * x')} AS value FROM lat",
    "fill_condition": f"""WITH {LAT}, {COND.format(fill='0e0', extra='')}
      {digests('id, is_conditional', 'x', 'cond', 'cond_sum', 'cond_dot')}""",
    "fill_condition_empty_prompt": f"""WITH {LAT},
      empty AS (SELECT pos, avg(x) AS x FROM lat GROUP BY pos),
      {COND.format(fill='e.x', extra='JOIN empty e ON e.pos = d.pos')}
      {digests('id, is_conditional', 'x', 'cond', 'cond_sum', 'cond_dot')}""",
    "sample_latent": f"""WITH {LAT} SELECT id, pos,
      {r(f"x + 1e-1 * {normal_at('pos', SEED, 'latent', 'id')}")} AS value FROM lat""",
    "normalize_latent": NORMALIZED,
    "normalize_latent_wide": NORMALIZED,
    "denormalize_latent": f"WITH {LAT} SELECT id, pos, {r('x / 3.611e-1 + 1.159e-1')} AS value FROM lat",
    "patchify": PATCHED,
    "patchify_in_jvm": PATCHED,
    "unpatchify": PLAIN,
    "unpatchify_in_jvm": PLAIN,
    "timestep_features": f"""WITH times AS (SELECT vec_id AS id, {sigmoid(normal(SEED, 't', 0, 'vec_id'))} AS t
        FROM embeddings), f AS (SELECT id, t, unnest(range(65)) AS k FROM times)
      SELECT id, k::INTEGER AS pos, {r('''CASE WHEN k < 32 THEN cos(t * exp(-ln(1e4) * k / 32e0))
        WHEN k < 64 THEN sin(t * exp(-ln(1e4) * (k - 32) / 32e0)) ELSE 0e0 END''')} AS value FROM f""",
    "resample_shards": f"WITH {DRAWS} SELECT draw, shard, id FROM drawn",
    "assign_shards": f"""WITH {SHARDED} SELECT DISTINCT shard, (shard % 3)::INTEGER AS node,
      ((shard // 3) % 2)::INTEGER AS worker FROM sharded""",
    "bounded_shuffle": f"""WITH {NUMBERED} SELECT id, idx, (idx // 32) * 32 + row_number() OVER
      (PARTITION BY idx // 32 ORDER BY {shuffle_order(SEED, 'shuffle', 1, 'id')}, id) - 1 AS pos FROM numbered""",
    "full_shuffle": f"""SELECT doc_id AS id, row_number() OVER
      (ORDER BY {shuffle_order(SEED, 'shuffle', 1, 'doc_id')}, doc_id) - 1 AS pos FROM documents""",
    "with_batches": f"WITH {NUMBERED} SELECT idx // 64 AS batch_id, (idx % 64)::INTEGER AS pos, id FROM numbered",
    "batched": f"""WITH {NUMBERED} SELECT idx // 64 AS batch_id, count(*)::INTEGER AS n,
      {r('sum(id * (idx % 64 + 1))::DOUBLE')} AS ids_dot FROM numbered GROUP BY 1""",
    "epoch_limit": f"""WITH {NUMBERED} SELECT id, idx // 64 AS batch_id, (idx % 64)::INTEGER AS pos
      FROM numbered WHERE idx // 64 < 10""",
    "caption_dropout": f"""WITH {LAT}, per AS (SELECT id, sum(x * (pos + 1)) AS dot FROM lat GROUP BY id),
      modes AS (SELECT id, m.mode, dot, ({u(SEED, 'dropout', 0, 'id')} <= 1e-1) = (m.mode = 'reference') AS kept
        FROM per CROSS JOIN (VALUES ('reference'), ('drop')) m(mode))
      SELECT id, mode, kept, {r('CASE WHEN kept THEN dot ELSE 0e0 END')} AS prompt_dot FROM modes""",
    "sample_timesteps": f"""WITH {NUMBERED}, placed AS (SELECT id, idx % 64 AS pos,
        count(*) OVER (PARTITION BY idx // 64) AS n FROM numbered), z AS (SELECT id, {STRATUM} AS z FROM placed)
      SELECT id, 'logit_normal' AS mode, {r(T)} AS t FROM numbered
      UNION ALL SELECT id, 'uniform', {r(u(SEED, 't', 0, 'id'))} FROM numbered
      UNION ALL SELECT id, 'stratified', {r(sigmoid(inverse_normal('z')))} FROM z""",
    "make_flow_rows": f"""WITH {FLOW} SELECT id, pos, {r('eps')} AS eps,
      {r('(1e0 - t) * y + t * eps')} AS z_t, {r('eps - y')} AS v FROM flow""",
    "flow_loss": f"WITH {LOSSES} SELECT id, {r('t')} AS t, {r('loss')} AS loss FROM losses",
    "batch_loss": f"""WITH {LOSSES} SELECT id // 64 AS batch_id, {r('avg(loss)')} AS loss, count(*) AS n
      FROM losses GROUP BY 1""",
    "guide": f"""WITH {MOVES}, guided AS (SELECT key, step, pos,
        CASE WHEN {u(0, 'uncond', 'key', 'step')} < 7e-1 THEN 5e-1 * v + 4e0 * (v - 5e-1 * v) ELSE v END AS v
        FROM moves) {digests('key, step', 'v', 'guided', 'v_sum', 'v_dot')}""",
    "replay_states": f"""WITH {MOVES}, seen AS (SELECT id AS key, 0 AS step, pos, x AS z FROM lat
        UNION ALL SELECT key, step, pos, z FROM states) {digests('key, step', 'z', 'seen', 'z_sum', 'z_dot')}""",
    "replay_predictions": f"""WITH {MOVES}, seen AS (SELECT id AS key, 0 AS step, pos, x AS z FROM lat
        UNION ALL SELECT key, step, pos, z + v / 5e1 - (51 - step) * v / 5e1 FROM states)
      {digests('key, step', 'z', 'seen', 'z_sum', 'z_dot')}""",
    "loss_by_bin": f"""WITH {STEP_LOG} SELECT b.bin,
      {r('coalesce(sum(loss), 0e0) / greatest(count(step), 1)')} AS loss, count(step) AS n
      FROM (SELECT unnest(range(10))::INTEGER AS bin) b LEFT JOIN steps ON least(floor(t * 10), 9) = b.bin
      GROUP BY b.bin""",
    "train_log": f"""WITH {STEP_LOG} SELECT step, epoch, {r('loss')} AS loss, step * 64 AS datapoints,
      {r(lr('(step + 1)', 100_000), 10)} AS lr FROM steps WHERE step % 100 = 0""",
    "with_learning_rate": f"WITH {STEP_LOG} SELECT step, {r(lr('step', 10_000), 10)} AS lr FROM steps",
    "eval_summary": f"""WITH {STEP_LOG}, b AS (SELECT step // 64 AS batch_id, avg(loss) AS loss FROM steps GROUP BY 1)
      SELECT {r('avg(loss)')} AS loss, count(*) AS batches FROM b WHERE batch_id <= 20""",
    "with_run_events": f"""WITH {STEP_LOG} SELECT step, step % 100 = 0 AS is_log,
      (step + 1) % 2500 = 0 AS is_checkpoint, (step + 1) % 2500 = 1 AS is_eval,
      step = (SELECT max(step) FROM steps) AS is_final FROM steps""",
}

# Second paths of an operator, taken for wide rows or large tables, have to give the same.
for _name, _same in {
    "lookup_embeddings_salted": "lookup_embeddings", "encode_in_place_joined": "encode_in_place",
    "encode_whole_joined": "encode_whole", "read_tar_members": "import_tar_shards",
    "prepare_stream_observed": "prepare_observed",
    "mean_pool_joined": "mean_pool", "fill_condition_hot": "fill_condition",
    "make_flow_rows_wide": "make_flow_rows", "flow_loss_wide": "flow_loss", "guide_wide": "guide",
    "replay_states_wide": "replay_states", "replay_predictions_wide": "replay_predictions",
}.items():
    ORACLES[_name] = ORACLES[_same]
