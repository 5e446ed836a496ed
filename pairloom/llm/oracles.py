"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def mixture_sql(docs: str = "documents") -> str:
    """One row per document: size, source_size, target, copies."""
    draw = "md5(concat_ws('|', '0', 'mix', coalesce(doc_id::VARCHAR, '')))"
    return rf"""
WITH sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         coalesce('=' || source, '') AS k
  FROM {docs}
), sums AS (
  SELECT source, k, coalesce(sum(size), 0)::BIGINT AS source_size FROM sized GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums
), weighted AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS w, source_size * 2e0 AS cap,
         15e-1 * (SELECT sum(source_size) FROM sums) AS share
  FROM ranked
), levels AS (
  -- Sources in the order in which they reach their limit; the first level that the next stays below.
  SELECT *, (share - coalesce(sum(cap) OVER before, 0)) / sum(w) OVER after AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT k, source_size,
         least(cap, w * coalesce((SELECT level FROM levels WHERE level < cap / w ORDER BY cap / w, place LIMIT 1), 0e0))::DOUBLE
           AS target
  FROM weighted
), rated AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS rate
  FROM sized s JOIN targets t USING (k)
)
SELECT *, (floor(rate) + (((('0x' || substr({draw}, 1, 8))::BIGINT)::DOUBLE + 5e-1) / 4294967296e0
                          < rate - floor(rate))::INT)::BIGINT AS copies
FROM rated"""


# The five rules, longest first, written out.
RULE_SQL = """CASE
    WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/' END"""
VERDICT_SQL = """CASE rule WHEN 'www.example.com/en/' THEN 'allow' WHEN 'com/' THEN 'allow'
    WHEN 'example.com/en/' THEN 'block' WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block'
    ELSE CASE WHEN bound > 25e-2 THEN 'block' ELSE 'allow' END END"""
SUFFIX_SQL = """'ac.jp', 'ac.uk', 'co.id', 'co.il', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.th', 'co.uk', 'co.za', 'com.ar',
    'com.au', 'com.br', 'com.cn', 'com.co', 'com.hk', 'com.mx', 'com.my', 'com.pl', 'com.sg', 'com.tr', 'com.tw', 'com.ua',
    'com.vn', 'edu.au', 'gov.au', 'gov.uk', 'ne.jp', 'net.au', 'or.jp', 'or.kr', 'org.au', 'org.br', 'org.uk'"""


def url_sql() -> str:
    host = r"regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)"

    def strength(groups: str, centre: str) -> str:
        return f"""SELECT CASE WHEN g < 2 OR noise = 0 THEN 1e4 ELSE (1 - rho) / rho END AS k
  FROM (SELECT g, noise, least(greatest(CASE WHEN free > 0 THEN (spread - noise * (g - 1)) / (noise * free)
                                             ELSE 0e0 END, 1e-4), 5e-1) AS rho
        FROM (SELECT count(*) AS g, avg({centre} * (1 - {centre})) AS noise,
                     sum(n * power(bad / n - {centre}, 2)) AS spread,
                     sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS free
              FROM {groups} WHERE n > 0))"""

    return rf"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         (length(html) - length(regexp_replace(html, '[#*$%|]', '', 'g')) > 1e-2 * length(html))::INT AS outcome
  FROM pages
), hosts AS (
  SELECT host, array_to_string(labels[CASE WHEN longer THEN -3 ELSE -2 END:], '.') AS domain,
         array_to_string(labels[CASE WHEN longer THEN -2 ELSE -1 END:], '.') AS suffix, n, bad
  FROM (SELECT host, string_split(host, '.') AS labels,
               array_to_string(string_split(host, '.')[-2:], '.') IN ({SUFFIX_SQL}) AS longer,
               count(outcome)::DOUBLE AS n, coalesce(sum(outcome), 0)::DOUBLE AS bad
        FROM parts GROUP BY host)
), overall AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 5e-1) / (sum(n) + 1) ELSE 5e-1 END AS m FROM hosts),
suffixes0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM hosts, overall GROUP BY suffix),
suffixes1 AS (SELECT suffix, (k * m + bad) / (k + n) AS ms FROM suffixes0, ({strength("suffixes0", "m")})),
domains0 AS (
  SELECT domain, any_value(ms) AS ms, sum(n) AS n, sum(bad) AS bad
  FROM hosts JOIN suffixes1 USING (suffix) GROUP BY domain),
domains1 AS (SELECT domain, (k * ms + bad) / (k + n) AS md FROM domains0, ({strength("domains0", "ms")})),
placed AS (SELECT host, n, bad, md FROM hosts JOIN domains1 USING (domain)),
known AS (
  SELECT host, (k * md + bad) / (k + n) AS bad_rate, k + n + 1 AS weight FROM placed, ({strength("placed", "md")})),
bounded AS (
  SELECT host, bad_rate, bad_rate - 1645e-3 * sqrt(bad_rate * (1 - bad_rate) / weight) AS bound FROM known)
SELECT page_id, host, path, rule, {VERDICT_SQL} AS verdict
FROM (SELECT *, {RULE_SQL} AS rule FROM parts JOIN bounded USING (host))"""


# crc32 from its definition: the table of 256 entries is derived from the polynomial.
CRC_TABLE = """
SELECT list_transform(range(256), lambda n: list_reduce(
         list_prepend(n::UBIGINT, range(8)::UBIGINT[]),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS tab"""


def crc32_sql(text: str) -> str:
    """crc32 of a string's UTF-8 bytes, with ``tab`` from CRC_TABLE in scope."""
    data = f"hex(encode({text}))"
    values = f"list_transform(range(0, length({data}) // 2), lambda i: ('0x' || substr({data}, (2 * i + 1)::BIGINT, 2))::UBIGINT)"
    step = "lambda c, b: xor(c >> 8, tab[(1 + (xor(c, b) & 255))::BIGINT])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {values}), {step}), 4294967295::UBIGINT)"


def conversations_sql() -> str:
    """Every conversation's best (cost, audit) for each of four states, turn by turn.

    A pair is a string, the cost in nine digits and then the audit, so that ``least`` orders pairs.
    """

    def add(pair: str, cost: str, letter: str) -> str:
        return f"lpad((left({pair}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({pair}, 10) || '{letter}'"

    act = crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    return rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {act} % 20 AS act
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE act WHEN 4 THEN 'user' ELSE role END AS role,
         CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE act WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM damaged
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again, NOT regexp_matches(text, '{WORD}') AS blank, again AND NOT blank AS duplicate,
         NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS truncated,
         NOT blank AND NOT duplicate AS stays,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial NOT IN ('su', 'ua', 'au'), false)
           AS illegal
  FROM placed
), search AS (
  SELECT conv_id, 0::BIGINT AS place, '000000000' AS s0, NULL::VARCHAR AS s1, '000000002I' AS s2, NULL::VARCHAR AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, place, n0, n1, least(n2, {add("least(n0, n1, n3)", "2", "I")}), least(n3, {add("n2", "2", "I")})
  FROM (
    SELECT j.conv_id, j.place, {add("s0", "3", "D")} AS n0,
           least({add("s1", "3", "D")}, CASE WHEN stays AND initial = 's' THEN {add("s0", "truncated::INT", "K")} END) AS n1,
           least({add("s2", "3", "D")},
                 CASE WHEN stays AND initial = 'u' THEN {add("least(s0, s1, s3)", "truncated::INT", "K")} END,
                 CASE WHEN stays THEN {add("least(s0, s1, s3)", "2 + truncated::INT", "R")} END) AS n2,
           least({add("s3", "3", "D")},
                 CASE WHEN stays AND initial = 'a' THEN {add("s2", "truncated::INT", "K")} END,
                 CASE WHEN stays THEN {add("s2", "2 + truncated::INT", "R")} END) AS n3
    FROM search s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.place = s.place + 1
  )
), best AS (
  SELECT conv_id, left(pair, 9)::BIGINT AS cost, substr(pair, 10) AS audit
  FROM (SELECT conv_id, arg_max(least(s0, s3), place) AS pair FROM search GROUP BY conv_id)
), letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS spot
  FROM best WHERE audit <> ''
), counted AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER so_far AS place, count(*) FILTER (letter <> 'D') OVER so_far AS line
  FROM letters WINDOW so_far AS (PARTITION BY conv_id ORDER BY spot)
), lines AS (
  SELECT c.*, j.role, j.text, coalesce(bool_or(line = 1 AND letter = 'K' AND initial = 's') OVER (PARTITION BY c.conv_id), false)::INT AS led
  FROM counted c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.place = c.place
  WHERE letter <> 'D'
), written AS (
  SELECT conv_id, string_agg(
           CASE letter WHEN 'K' THEN role ELSE CASE (line - led) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
           || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS whole
  FROM lines GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
            LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM b.conv_id"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def jaccard_sql(size: int = 4, percent: int = 80) -> str:
    """All pairs of documents that share a shingle, by count; then what each document reaches."""
    shingle = f"lambda i: array_to_string(w[i:i + {size - 1}], ' ')"
    return rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= {size} THEN list_distinct(list_transform(range(1, len(w) - {size - 2}), {shingle}))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s
  FROM split
), elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)"""


def spelling_sql(least: int = 7, times: int = 2, ratio: int = 10) -> str:
    """Words one edit apart share what is left of one without a letter; replaced letters keep their place."""
    runs = r"regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')"
    return rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}
), runs AS (
  SELECT doc_id, translate(unnest({runs}), '{UPPER}', '{LOWER}') AS run FROM documents
), hashed AS (
  SELECT run, n, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {least} GROUP BY ALL), crc
), typed AS (
  SELECT n, CASE h % 31 WHEN 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                        ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= {times}
), cut AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words
), shorter AS (
  SELECT DISTINCT word, n, left(word, spot - 1) || substr(word, spot + 1) AS rest FROM cut
), holed AS (
  SELECT word, n, spot, left(word, spot - 1) || '*' || substr(word, spot + 1) AS hole FROM cut
), near AS (
  SELECT l.word AS word, w.word AS near, w.n AS near_n FROM shorter l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM shorter l JOIN words w ON l.rest = w.word
  UNION SELECT a.word, b.word, b.n FROM holed a JOIN holed b ON a.hole = b.hole AND a.spot = b.spot AND a.word <> b.word
), nearest AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n
  FROM near GROUP BY word
), forms AS (
  SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {ratio} * n THEN near END AS form,
         CASE WHEN near_n >= {ratio} * n THEN near_n END AS form_n
  FROM words w LEFT JOIN nearest USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS hops FROM forms
  UNION ALL SELECT c.word, f.form, hops + 1 FROM chain c JOIN forms f ON f.word = c.root AND f.form IS NOT NULL
), roots AS (SELECT word, arg_max(root, hops) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


ORACLES = {
    "op11_bottom_k": jaccard_sql(),
    "op12_pivotal_grams": spelling_sql(),
    "op13_conversation_repair": conversations_sql(),
    "op1_url_reputation": url_sql(),
    "op9_mixture": f"SELECT doc_id, size, source_size, target, size * copies AS taken FROM ({mixture_sql()})",
}
