"""DuckDB counterparts of the registered queries that plain SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
CHECKED = {"github": "gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})", "npm": "npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _bit_steps(value: str, steps: int = 8) -> str:
    """Eight shifts of the CRC-32 register as nested list steps."""
    return f"list_reduce([{value}::BIGINT] || range({steps}), lambda a, i: (a >> 1) # 0)".replace(
        "(a >> 1) # 0", "xor(a >> 1, (a & 1) * 3988292384)"
    )


def _crc32(text: str) -> str:
    register = _bit_steps("xor(c, b)")
    return (
        f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), "
        f"lambda c, b: {register}), 4294967295)"
    )


def _base62(value: str) -> str:
    return " || ".join(f"substr('{BASE62}', 1 + (({value}) // {62 ** k}) % 62, 1)" for k in range(5, -1, -1))


def _matches(kind: str, pattern: str, keep: str, tail: str = "") -> str:
    """All matches with their places: each is fenced by two control characters and counted off."""
    return f"""{kind}_parts AS (
  SELECT doc_id, row_id, string_split(regexp_replace(t, '({pattern}{tail})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS parts FROM texts
), {kind}_found AS (
  SELECT doc_id, row_id, string_split(parts[i], chr(2))[1] AS m,
         list_sum(list_transform(parts[1:i - 1], lambda p, k: length(p) - (k > 1)::INT))::BIGINT AS start
  FROM (SELECT doc_id, row_id, parts, unnest(range(2, len(parts) + 1)) AS i FROM {kind}_parts WHERE len(parts) > 1)
), {kind}_spans AS (
  SELECT doc_id, row_id, '{kind}' AS kind, start, start + length(m) AS stop FROM {kind}_found WHERE {keep}
)"""


def _secret_scan() -> str:
    group2 = f"regexp_extract(m, '{ASSIGN}', 2)"
    parts = [
        _matches("assign", ASSIGN, f"length({group2}) >= 8"),
        _matches("access", "AKIA[A-Z0-9]+", "length(m) >= 16"),
        _matches("hex", "[0-9a-f]+", "length(m) >= 32"),
    ]
    for kind, pattern in CHECKED.items():
        body, check = f"regexp_extract(m, '{pattern}', 1)", f"regexp_extract(m, '{pattern}', 2)"
        parts.append(_matches(kind, pattern, f"regexp_full_match(m, '{pattern}') AND {_base62(_crc32(body))} = {check}", "\\b"))
    union = " UNION ALL ".join(f"SELECT *, {k} AS rank FROM {kind}_spans" for k, kind in enumerate(("assign", "access", "hex", *CHECKED)))
    one = "kind || ':' || start || ':' || stop"
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents
), {', '.join(parts)}, spans AS ({union}), grouped AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg({one}, ',' ORDER BY start, rank) FILTER ({base}) AS base,
         string_agg({one}, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN grouped USING (row_id)"""


def _url_filter() -> str:
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    rules = [("example.com", "/de/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"), ("net", "/", "block")]
    case = lambda value: "CASE " + " ".join(f"WHEN {fits.format(h, p)} THEN '{value(h, p, act)}'" for h, p, act in rules) + " END"
    return f"""
WITH parted AS (
  SELECT page_id, {LOWER.format(f"coalesce(regexp_extract(url, '{pattern}', 1), '')")} AS host,
         coalesce(regexp_extract(url, '{pattern}', 2), '') AS path FROM pages
), keyed AS (
  SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS key FROM parted
), listed AS (SELECT DISTINCT key FROM keyed WHERE regexp_matches(host, '(^|[.-])spam')),
ruled AS (SELECT *, {case(lambda h, p, act: h + p)} AS rule, {case(lambda h, p, act: act)} AS by_rule FROM keyed)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN host <> '' AND key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""


REST = r"((?:\|im_start\||\|im_end\||\|endoftext\||/?s)>|/?INST\])"


def _chat_format() -> str:
    escaped = lambda c: f"regexp_replace({c}, '([<\\[])(\\\\*){REST}', '\\1\\\\\\2\\3', 'g')"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length({escaped('text')}) + length(replace(replace({escaped('role')}, '\\', '\\\\'), chr(10), '\\n')) + 12 + 1 + 11)::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said"""


def _decontamination() -> str:
    words = lambda c: f"regexp_extract_all({LOWER.format(f'coalesce({c}, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
items AS (SELECT item_id, w FROM (SELECT item_id, {words('text')} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[s:s + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items)
), sizes AS (SELECT DISTINCT m FROM windows),
places AS (
  SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM docs JOIN sizes ON len(w) >= m)
), hits AS (SELECT DISTINCT r, s, places.m, win FROM places SEMI JOIN windows USING (win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS p FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hits JOIN windows USING (win)) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


def _embedding_near_dedup() -> str:
    return """
WITH RECURSIVE given AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT r, vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len
  FROM given WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.len * b.len) >= 0.98
), reached AS (
  SELECT r AS a, r AS b FROM given UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), rooted AS (SELECT a AS r, min(given.vec_id) AS component_id FROM reached JOIN given ON given.r = reached.b GROUP BY a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM given JOIN rooted USING (r) LEFT JOIN counted USING (r)"""


def _spelling_variants() -> str:
    left_out = "substr({0}, 1, {1}) || substr({0}, {1} + 2)"
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda c: {_bit_steps("c")}) AS steps),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-z\u00C0-\u00FF]{{7,}}')) AS run FROM documents
), said AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
bytes AS (
  SELECT run, times, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':', ''), lambda c: [ord(c)::BIGINT])
    || list_transform(string_split(run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c) - 64] END) AS b FROM said
), checked AS (
  SELECT run, times, xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(b), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]))) AS h
  FROM bytes, crc
), cut AS (
  SELECT times, CASE WHEN h % 31 = 0 THEN {left_out.format("run", "(h % length(run))")} ELSE run END AS word FROM checked
), words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
rest AS (SELECT word, n, k, {left_out.format("word", "k")} AS r FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM rest a JOIN rest b ON a.r = b.r AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM rest a JOIN words b ON a.r = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM rest a JOIN words b ON a.r = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m, any_value(n) AS n FROM near GROUP BY word
), formed AS (SELECT word, n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n FROM best),
ways AS (
  SELECT word, word AS root FROM words UNION ALL
  SELECT ways.word, formed.form FROM ways JOIN formed ON formed.word = ways.root WHERE formed.form IS NOT NULL
), ends AS (SELECT ways.word, ways.root FROM ways LEFT JOIN formed ON formed.word = ways.root WHERE formed.form IS NULL)
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words LEFT JOIN formed USING (word) JOIN ends USING (word)"""


def _whole(scale: int, more: str = "") -> str:
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v{more} FROM embeddings
), good AS (
  SELECT * EXCLUDE v, list_transform(v, lambda x: floor({scale} * x)) AS v FROM given
  WHERE vec_id IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""


def _exact_top_k() -> str:
    return _whole(64) + """
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.r ORDER BY score DESC, c.vec_id) AS rank
  FROM good q JOIN good c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
) WHERE rank <= 20"""


def _hard_negatives() -> str:
    return _whole(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label") + """, scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.r <> b.r AND len(a.v) = len(b.v) AND a.label IS NOT NULL AND b.label IS NOT NULL WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT ar, anchor_id, br AS pr, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, pr ORDER BY score DESC, vec_id) AS rank
  FROM positives p JOIN scored s ON p.ar = s.ar AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""


def statements() -> dict[str, str]:
    return {"op1_secret_scan": _secret_scan(), "op5_url_filter": _url_filter(), "op7_chat_format": _chat_format(),
            "op8_benchmark_decontamination": _decontamination(),
            "op10_embedding_near_dedup": _embedding_near_dedup(), "op11_spelling_variants": _spelling_variants(),
            "op12_exact_top_k": _exact_top_k(), "op13_hard_negatives": _hard_negatives()}
