"""DuckDB SQL with the results of those queries that SQL can express.

The others (op4, op5, op7, op8, op9, op13 and the pipeline) are compared with brute force in ``tests/llm``.
"""

from hayloft.llm.license_scan import PHRASES, TEMPLATES

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MIX = rf"""
WITH docs AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    md5(coalesce(text, '')) AS digest,
    CASE WHEN length(text) > 0
      THEN greatest(length(regexp_replace(text, '[^\p{{L}}\x20\x09-\x0D]', '', 'g')) / CAST(length(text) AS DOUBLE), 0.05)
      ELSE 1.0 END AS quality
  FROM documents
), drawn AS (
  SELECT *, -ln((CAST('0x' || substr(md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), '-'), ':', digest)), 1, 13) AS BIGINT)
    + 0.5) / 4503599627370496.0) / quality AS key
  FROM docs
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, (1.5 * sum(source_size) OVER ()
      - coalesce(sum(2.0 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sizes WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size, least(2.0 * source_size, max(level) OVER () * weight) AS target FROM levels
), ordered AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS LAST, d.digest ROWS UNBOUNDED PRECEDING) AS upto
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN upto - size / 2.0 < target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

_CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, tokens,
    sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS before,
    sum(tokens) OVER (PARTITION BY conv_id) AS total,
    24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n|'))
      + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars
  FROM (SELECT *, len(regexp_extract_all(text, '{_WORD}')) + 4 AS tokens FROM turns)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
), slotted AS (
  SELECT *, floor(before / stride) AS slot
  FROM (SELECT *, greatest(floor((448 - max(CASE WHEN pos = 0 AND role = 'system' THEN tokens ELSE 0 END)
      OVER (PARTITION BY conv_id)) / 2), 64) AS stride FROM placed)
), ended AS (
  SELECT *, max(before + tokens) OVER (PARTITION BY conv_id, slot) AS slot_end FROM slotted
), per_slot AS (
  SELECT conv_id, slot, sum(chars) AS chars, sum(CASE WHEN slot_end < total AND slot_end - before <= 64
      AND NOT (pos = 0 AND role = 'system') THEN chars ELSE 0 END) AS again
  FROM ended GROUP BY conv_id, slot
), sizes AS (
  SELECT conv_id, sum(chars) + sum(again) AS own, count(*) - 1 AS later FROM per_slot GROUP BY conv_id
), read AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss,
    sum(CASE WHEN pos = 0 AND role = 'system' THEN chars ELSE 0 END) AS system_chars
  FROM placed GROUP BY conv_id
)
SELECT r.conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(own + later * system_chars AS BIGINT) AS formatted_chars
FROM read r JOIN sizes s ON r.conv_id IS NOT DISTINCT FROM s.conv_id
"""

_DECONTAM = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[p : p + least(13, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM items WHERE len(ws) > 0)
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents
), places AS (
  SELECT rid, n, p, array_to_string(ws[p : p + n - 1], ' ') AS w
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)
), hits AS (
  SELECT rid, p, p_.n, item_id FROM places p_ JOIN windows USING (w)
), words AS (
  SELECT rid, count(DISTINCT nth) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS nth FROM hits) GROUP BY rid
), found AS (
  SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""

_SUBSTRING = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), wins AS (
  SELECT rid, doc_id, p, md5(array_to_string(ws[p : p + 49], ' ')) AS w
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM docs WHERE len(ws) >= 50)
), firsts AS (
  SELECT w, min(coalesce(doc_id, 9223372036854775807)) AS lo FROM wins GROUP BY w
), gone AS (
  SELECT DISTINCT rid, unnest(range(p, p + 50)) AS nth FROM wins JOIN firsts USING (w)
  WHERE lo < coalesce(doc_id, 9223372036854775807)
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY nth) AS text, count(*) AS n
  FROM (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS nth FROM docs) ANTI JOIN gone USING (rid, nth)
  GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
_PHRASE_ROWS = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES)

_LICENSES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents
), words AS (
  SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS nth FROM docs
), runs AS (
  SELECT rid, nth, word || ' ' || lead(word) OVER w AS two, word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w AS three
  FROM words WINDOW w AS (PARTITION BY rid ORDER BY nth)
), base AS (
  SELECT rid, count(*) AS n_base, min(nth) AS first_word, max(nth) AS last_word, list(DISTINCT label) AS labels
  FROM runs JOIN (VALUES {_PHRASE_ROWS}) AS p(phrase, label) ON phrase = two OR phrase = three GROUP BY rid
), templates AS (
  SELECT t, label, string_split(text, ' ') AS ws FROM (VALUES {_TEMPLATE_ROWS}) AS v(t, label, text)
), grams AS (
  SELECT t, label, len(ws) AS n, i AS t_nth, array_to_string(ws[i + 1 : i + 3], ' ') AS three
  FROM (SELECT t, label, ws, unnest(range(len(ws) - 2)) AS i FROM templates)
), matches AS (
  SELECT rid, t, label, n, nth, t_nth, nth - t_nth AS diagonal FROM runs JOIN grams USING (three)
), diagonals AS (
  SELECT rid, t, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, t ORDER BY diagonal) > 3 THEN 1 ELSE 0 END AS breaks
  FROM (SELECT DISTINCT rid, t, diagonal FROM matches)
), islands AS (
  SELECT rid, t, diagonal, sum(breaks) OVER (PARTITION BY rid, t ORDER BY diagonal) AS island FROM diagonals
), placed AS (
  SELECT rid, t, label, n, island, nth, t_nth FROM matches JOIN islands USING (rid, t, diagonal)
), spans AS (
  SELECT a.rid, a.label, count(DISTINCT b.t_nth) / CAST(a.n - 2 AS DOUBLE) AS coverage
  FROM (SELECT DISTINCT rid, t, label, n, island, nth FROM placed) a JOIN placed b
    ON a.rid = b.rid AND a.t = b.t AND a.island = b.island AND b.nth BETWEEN a.nth AND a.nth + CAST(floor(a.n * 1.5 + 3) AS INTEGER) - 3
  GROUP BY a.rid, a.t, a.label, a.n, a.island, a.nth
), voted AS (
  SELECT rid, max(coverage) AS best, list(DISTINCT label) FILTER (WHERE coverage >= 0.75) AS labels FROM spans GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(voted.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM docs LEFT JOIN base USING (rid) LEFT JOIN voted USING (rid)
"""

# A step of the edit program is a list of four candidates, one per state of (s?(ua)+)?: nothing
# yet, after s, after u, after a. A candidate is its cost in nine digits, then its audit.
def _plus(candidate: str, cost: str, letters: str) -> str:
    return (
        f"lpad(CAST(CAST({candidate}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {candidate}[10:] || '{letters}'"
    )


_INSERT_STEP = f"""[a[1], a[2],
  least(a[3], {_plus("a[1]", "3", "I")}, {_plus("a[2]", "3", "I")}, {_plus("a[4]", "3", "I")}),
  least(a[4], {_plus("a[3]", "3", "I")}, {_plus("a[1]", "6", "II")}, {_plus("a[2]", "6", "II")})]"""
_EXTRA = "CASE WHEN x[1] = upper(x[1]) THEN 3 ELSE 0 END"
_BEFORE_U = "least(a[1], a[2], a[4])"
_ROW_STEP = f"""[{_plus("a[1]", "4", "D")},
  least({_plus("a[2]", "4", "D")}, CASE WHEN lower(x[1]) = 's' THEN {_plus("a[1]", _EXTRA, "K")} END),
  least({_plus("a[3]", "4", "D")}, CASE WHEN lower(x[1]) = 'u' THEN {_plus(_BEFORE_U, _EXTRA, "K")} END,
    CASE WHEN x[1] <> 'd' THEN {_plus(_BEFORE_U, f"3 + {_EXTRA}", "R")} END),
  least({_plus("a[4]", "4", "D")}, CASE WHEN lower(x[1]) = 'a' THEN {_plus("a[3]", _EXTRA, "K")} END,
    CASE WHEN x[1] <> 'd' THEN {_plus("a[3]", f"3 + {_EXTRA}", "R")} END)]"""
_CRC_BIT = "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"

_STRUCTURE = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key
  FROM conversations
), dealt AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce(CAST(range(8) AS BIGINT[]), lambda r, i: {_CRC_BIT}, xor(crc, byte)),
    CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM given
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || chr(10) || text, role, copy) AS rn FROM rows
), faulty AS (
  SELECT *, role[1] AS initial, CASE WHEN NOT regexp_matches(text, '{_WORD}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), coded AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN initial NOT IN ('s', 'u', 'a')
      THEN CASE fault WHEN 'truncated' THEN 'X' ELSE 'x' END
      WHEN fault = 'truncated' THEN upper(initial) ELSE initial END AS symbol,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS two
  FROM faulty
), per_conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE rn > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal,
    list_concat(flatten(list([['+'], [symbol]] ORDER BY rn)), [['+']]) AS steps
  FROM coded GROUP BY conv_id
), solved AS (
  SELECT * EXCLUDE (steps), list_reduce(steps, lambda a, x: CASE WHEN x[1] = '+' THEN {_INSERT_STEP} ELSE {_ROW_STEP} END,
    CAST(['000000000', NULL, NULL, NULL] AS VARCHAR[])) AS ends
  FROM per_conv
), audited AS (
  SELECT * EXCLUDE (ends), CAST(least(ends[1], ends[4])[1:9] AS BIGINT) AS cost, least(ends[1], ends[4])[10:] AS audit FROM solved
), letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS idx FROM audited
), applied AS (
  SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS nth, count(*) FILTER (WHERE letter <> 'D') OVER w AS emitted
  FROM letters WHERE letter <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY idx)
), joined AS (
  SELECT a.*, c.role, c.text, max(CASE WHEN letter = 'K' AND c.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id) AS led
  FROM applied a LEFT JOIN coded c ON a.conv_id IS NOT DISTINCT FROM c.conv_id AND a.nth = c.rn AND a.letter <> 'I'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (emitted - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY idx) AS text
  FROM joined WHERE letter <> 'D' GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(text, '')) AS repaired_sha256
FROM ids i LEFT JOIN audited a ON i.conv_id IS NOT DISTINCT FROM a.conv_id
  LEFT JOIN repaired r ON i.conv_id IS NOT DISTINCT FROM r.conv_id
"""

_JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT rid, array_to_string(ws[p : p + 2], ' ') AS w
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS p FROM docs WHERE len(ws) > 0)
), sizes AS (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS o FROM shingles a JOIN shingles b USING (w) WHERE a.rid <> b.rid GROUP BY a.rid, b.rid
), links AS (
  SELECT a, b FROM common JOIN sizes sa ON sa.rid = a JOIN sizes sb ON sb.rid = b WHERE 100 * o >= 90 * (sa.n + sb.n - o)
), reached AS (
  SELECT rid, rid AS at FROM docs
  UNION SELECT rid, links.b FROM reached JOIN links ON links.a = reached.at
), classes AS (
  SELECT reached.rid, min(docs.doc_id) AS component_id FROM reached JOIN docs ON docs.rid = reached.at GROUP BY reached.rid
), degrees AS (
  SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM docs JOIN classes USING (rid) LEFT JOIN sizes USING (rid) LEFT JOIN degrees USING (rid)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": _MIX,
    "op2_substring_dedup": _SUBSTRING,
    "op3_chat_windows": _CHAT,
    "op6_benchmark_decontamination": _DECONTAM,
    "op10_license_scan": _LICENSES,
    "op11_structure_repair": _STRUCTURE,
    "op12_ngram_jaccard": _JACCARD,
}
