"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline

#: Fixed values of the sharding query: modulus and multipliers of the round hash, and its keys for the seed 2024.
PRIME, MUL1, MUL2 = 2147483647, 1103515245, 1664525247
ROUND_KEYS = {2024: [702508842, 2037526063, 817038131, 710444357, 693197815, 1409023969]}

#: Base32 of a 40-digit hex SHA-1 ``h``: each 5 hex digits are 4 letters.
_BASE32 = """list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform(range(4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * CAST(i AS INTEGER), 5))::BIGINT >> (15 - 5 * CAST(j AS INTEGER))) & 31)::INTEGER, 1)),
    'string_agg', '')), 'string_agg', '')"""

ORACLES: dict[str, str] = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}

ORACLES["op3_warc_revisits"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
     q AS (SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
                  min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q"""

ORACLES["op8_chat_formatting"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + 2
           + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 8)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


def _crc_half(v: int) -> int:
    """Four steps of the CRC-32 (reflected polynomial) of a half byte."""
    for _ in range(4):
        v = (v >> 1) ^ (0xEDB88320 if v & 1 else 0)
    return v


def _crc_step(value: str) -> str:
    table = ", ".join(f"{_crc_half(v)}::BIGINT" for v in range(16))
    return f"xor({value} >> 4, list_extract([{table}], ({value} & 15) + 1))"


def _feistel(shards: int, seed: int) -> str:
    """The permutation as recursive SQL: six rounds, and again while the value lies beyond n."""
    def rounds(value: str, source: str, keep: str) -> str:
        sql = f"SELECT {keep}, n, a, b, {value} // b AS x, {value} % b AS y, a AS mx, b AS my FROM {source}"
        for key in ROUND_KEYS[seed]:
            first = f"SELECT *, (y * {MUL1} + {key}) % {PRIME} AS h1 FROM ({sql})"
            second = f"SELECT *, (xor(h1, h1 >> 15) * {MUL2} + {key}) % {PRIME} AS h2 FROM ({first})"
            sql = f"SELECT {keep}, n, a, b, y AS x, (x + xor(h2, h2 >> 13)) % mx AS y, my AS mx, mx AS my FROM ({second})"
        return f"SELECT {keep}, n, a, b, x * my + y AS v FROM ({sql})"

    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     c AS (SELECT doc_id, (strlen(t) + 1)::BIGINT AS size, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda z: ('0x' || z)::BIGINT)),
             lambda c, x: {_crc_step(_crc_step('xor(c, x)'))}), 4294967295) AS text_crc32 FROM d),
     r AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS k, count(*) OVER () AS n FROM c),
     s AS (SELECT *, ceil(sqrt(n))::BIGINT AS a, ceil(n / ceil(sqrt(n)))::BIGINT AS b FROM r),
     walk AS ({rounds('k', 's', 'doc_id')} UNION ALL {rounds('v', '(SELECT * FROM walk WHERE v >= n)', 'doc_id')})
SELECT doc_id, size, text_crc32, 'rows' AS law, (v % {shards})::INTEGER AS shard, v // {shards} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM walk JOIN s USING (doc_id) WHERE v < s.n"""


ORACLES["op4_sharding"] = _feistel(8, 2024)

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLES["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS words FROM documents),
     sh AS (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
     common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
     links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
     edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
     reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
     comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)"""

ORACLES["op5_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT doc_id, t, regexp_extract_all(t, {_WORDS}) AS words,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
     win AS (SELECT doc_id, i, words[i : i + 4] AS g
             FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
     rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
     cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
     f AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                  coalesce(cov.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_caps
           FROM w LEFT JOIN cov USING (doc_id)),
     b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
            OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))
            OR (n_words > 0 AND 2 * n_caps > word_chars)) AS kept
FROM b"""


def _secret_kind(place: int, kind: str, regex: str, group: int, least: int) -> str:
    """Kept matches of one kind; ``regex`` in DuckDB's syntax."""
    at = "list_sum(list_transform(gaps[1 : i], lambda g: length(g))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda g: length(g))), 0)"
    return f"""SELECT doc_id, ({at})::BIGINT AS s, {place} AS place, '{kind}' AS kind, ({at} + length(m[i]))::BIGINT AS e
     FROM (SELECT doc_id, m, g2, gaps, unnest(range(1, len(m) + 1)) AS i FROM (
             SELECT doc_id, regexp_extract_all(t, '{regex}') AS m, regexp_extract_all(t, '{regex}', {group}) AS g2,
                    string_split_regex(t, '{regex}') AS gaps FROM d))
     WHERE length(g2[i]) >= {least}"""


def _letters(words: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


_KINDS = [
    ("assign", "(" + _letters("password|passwd|secret|token|api_?key") + r")[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24),
    ("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0), ("code_host", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}", 0, 0),
]
_IS_BASE = "kind IN ('assign', 'access', 'hex')"

ORACLES["op9_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     f AS ({' UNION ALL '.join(_secret_kind(i, *k) for i, k in enumerate(_KINDS))})
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = '{k[0]}')::BIGINT AS n_{k[0]}" for k in _KINDS[:3])},
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER ({_IS_BASE}), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place), '') AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id"""

ORACLES["op11_filter_interaction_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                  length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals FROM d),
     m AS (SELECT part, (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
                  + (CASE WHEN 100 * capitals > 10 * length(t) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
                  + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask,
                  CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END AS good,
                  CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS toxic FROM w),
     h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
     f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
     o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
           FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b <> b.b AND a.b <> c.b AND a.b <> d.b AND a.b <> e.b
            AND b.b <> c.b AND b.b <> d.b AND b.b <> e.b AND c.b <> d.b AND c.b <> e.b AND d.b <> e.b),
     s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS prior
           FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step))
SELECT part, filter_order, step,
       sum(CASE WHEN (mask & (own + prior)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & prior) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & prior) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & prior) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN (mask & own) <> 0 AND (mask & prior) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN (mask & own) <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM h, s GROUP BY part, filter_order, step, own, prior"""

ORACLES["op12_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     p AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
                  list_inner_product(a.v, r.v)::BIGINT AS score
           FROM e a, e r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
     g AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM p WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT g.anchor_id, positive_id, row_number() OVER (PARTITION BY g.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM g JOIN p ON g.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""
