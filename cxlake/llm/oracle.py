"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

# op5: word 4-shingles of the lower-cased text as a set per document, compared
# through shared shingles; components by transitive closure over links.
NGRAM_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), grams AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM words
), shingles AS (SELECT DISTINCT doc_id, g FROM grams
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 85 * (s.n + t.n - k)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(m.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) m USING (doc_id)
"""

# op2: cosine of every pair in double precision.
EMBEDDING_JOIN = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON l.x = r.other
), low AS (SELECT vec_id, min(other) AS c FROM reach GROUP BY vec_id
), n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(low.c, e.vec_id) AS component_id, e.vec_id = coalesce(low.c, e.vec_id) AS kept
FROM embeddings e LEFT JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
"""

# op10: digests from the rows themselves; lengths from the template's fixed
# parts and two more characters for every escaped one.
CHAT_FORMAT = r"""
WITH probe AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + 2 * len(regexp_extract_all(text, '%|<(\||/?s>|</?SYS>>)|\[/?INST\]')) AS text_chars,
    length(role) + 2 * len(regexp_extract_all(role, '%|<(\||/?s>|</?SYS>>)|\[/?INST\]|\n')) AS role_chars
  FROM probe
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + role_chars + text_chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

# op7: per kind, gaps and matches of a split by the pattern; the link test is a
# join of the parts of a document on the gap between them.
SECRETS = (
    (r"""(?i:password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 1, "length(v[i]) >= 6"),
    (r"AKIA[A-Z0-9]{16,}", 0, "true"),
    (r"[0-9a-f]{24,}", 0, "true"),
    (r"[A-Za-z0-9+/_=-]{28,}", 0, "regexp_matches(v[i], '[0-9]') AND regexp_matches(v[i], '[A-Z]') AND regexp_matches(v[i], '[a-z]')"),
    (r"""(?i:user(?:name)?|login|client_?id|account)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9_.@-]+)""", 1, "length(v[i]) >= 3"),
    (r"(?:https?|ftp|s3|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, "true"),
)


def _secret_hits(kind: int) -> str:
    pattern, group, ok = SECRETS[kind]
    p = pattern.replace("\\'", "''")
    return (
        f"SELECT doc_id, {kind} AS kind, i, length(g[i]) AS gap, length(m[i]) AS len, {ok} AS ok FROM ("
        f"SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, "
        f"regexp_extract_all(t, '{p}', {group}) AS v, string_split_regex(t, '{p}') AS g FROM texts))"
    )


SECRET_SCAN = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), hits AS ({" UNION ALL ".join(_secret_hits(k) for k in range(len(SECRETS)))}
), placed AS (
  SELECT doc_id, if(ok, kind, NULL) AS part, sum(gap + len) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e, len FROM hits
), parts AS (SELECT doc_id, part, CAST(e - len AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed WHERE part IS NOT NULL
), met AS (
  SELECT p.doc_id, p.part, p.s, p.e, bool_or(o.part IN (0, 2, 3)) AS secret, bool_or(o.part IN (1, 4)) AS ident, bool_or(o.part = 5) AS endpoint,
    bool_or(o.part < 3 AND o.s < p.e AND o.e > p.s) AS inside
  FROM parts p JOIN parts o ON o.doc_id = p.doc_id AND o.s <= p.e + 200 AND o.e >= p.s - 200
  GROUP BY p.doc_id, p.part, p.s, p.e
), found AS (
  SELECT doc_id, part, s, concat(['assign', 'access', 'hex', 'linked_secret', 'linked_account', 'linked_endpoint'][part + 1], ':', s, ':', e) AS span
  FROM met WHERE part < 3 OR (NOT inside AND CASE part WHEN 3 THEN ident OR endpoint WHEN 4 THEN secret ELSE ident AND secret END)
), sums AS (
  SELECT doc_id, count(*) FILTER (part = 0) AS a, count(*) FILTER (part = 1) AS b, count(*) FILTER (part = 2) AS c,
    string_agg(span, ',' ORDER BY s, part) FILTER (part < 3) AS base, string_agg(span, ',' ORDER BY s, part) AS spans
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN sums USING (doc_id)
"""

# op11: keys by a chain of digests along each conversation; subtree sums over
# all (node, ancestor) pairs; CRC-32 bit by bit over the decimal id.
PREFIX_TRIE = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [unicode(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM t)
), parts AS (
  SELECT i.c, 0 AS part, t.pos, role, text FROM ids i JOIN t ON t.c = i.base WHERE t.pos <= h
  UNION ALL SELECT i.c, 1, t.pos, role, text FROM ids i JOIN t ON t.c = i.c WHERE t.pos > h
), turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, sha256(concat(length(role), ':', role, text)) AS m,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM parts
), path(c, d, k, parent, words) AS (
  SELECT c, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM ids
  UNION ALL SELECT p.c, t.d, sha256(p.k || t.m), p.k, t.words FROM path p JOIN turns t ON t.c = p.c AND t.d = p.d + 1
), nodes AS (
  SELECT k, any_value(parent) AS parent, any_value(d) AS d, min(c) AS low, count(*) AS n, (count(*) - 1) * any_value(words) AS gain FROM path GROUP BY k
), fan AS (SELECT parent AS k, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT a.k, sum(n.gain) AS saved, count(*) FILTER (f.k IS NULL) AS leaves
  FROM nodes n LEFT JOIN fan f ON f.k = n.k JOIN path a ON a.c = n.low AND a.d <= n.d GROUP BY a.k
), tails AS (SELECT c, arg_max(k, d) AS k FROM path GROUP BY c
), ends AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM tails GROUP BY k)
SELECT n.low AS conv_id, n.d AS depth, p.low AS parent_conv_id, n.n AS n_convs, coalesce(f.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.k = n.parent LEFT JOIN fan f ON f.k = n.k JOIN sums s ON s.k = n.k LEFT JOIN ends e ON e.k = n.k
"""

# op13: sizes and digests of the payloads, and the first page of each payload.
WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
  if(bytes >= 100 AND first < page_id, 'revisit', 'response') AS record_type, if(bytes >= 100 AND first < page_id, first, NULL) AS refers_to
FROM f
"""

ORACLE_SQL: dict[str, str] = {
    "op2_embedding_join": EMBEDDING_JOIN,
    "op5_ngram_join": NGRAM_JOIN,
    "op7_secret_scan": SECRET_SCAN,
    "op10_chat_format": CHAT_FORMAT,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_warc": WARC,
}
