"""The queries that SQL can express, as SQL for DuckDB over whole tables."""

from __future__ import annotations

from churnloom.llm import chat, mixing, substring
from churnloom.llm import secret_ledger as S


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    patterns = {r.kind: r.pattern for r in S.BASE}
    parts = [
        f"""SELECT doc_id, {_q(r.kind)} AS kind, {i} AS o, regexp_split_to_array(x, {_q(patterns[r.kind])}) AS g,
            regexp_extract_all(x, {_q(patterns[r.kind])}) AS m, regexp_extract_all(x, {_q(patterns[r.kind])}, {r.group}) AS q,
            {r.shortest} AS least
        FROM t WHERE regexp_matches(x, {_q(patterns[r.kind])})"""
        for i, r in enumerate(S.BASE)
    ]
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
    f AS ({" UNION ALL ".join(parts)}),
    e AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM f),
    p AS (
        SELECT doc_id, kind, o, len(q[i]) >= least AS ok,
            coalesce(list_sum(list_transform(g[1:i], lambda z: len(z))), 0)
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda z: len(z))), 0) AS s, len(m[i]) AS n
        FROM e
    ),
    d AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
            count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, o) AS spans
        FROM p WHERE ok GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN d USING (doc_id)
    """


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CONTAMINATION = f"""
    WITH b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
    bw AS (
        SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
        FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
    ),
    d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    dw AS (
        SELECT doc_id, size, x.i AS i, x.win AS win
        FROM (SELECT doc_id, size, unnest(list_transform(generate_series(1, len(w) - size + 1),
                  lambda i: {{'i': i, 'win': array_to_string(w[i:i + size - 1], ' ')}})) AS x
              FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
    ),
    h AS (SELECT doc_id, i, dw.size, item FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
    c AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM h) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_W = substring.WINDOW
SUBSTRING = rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (
        SELECT doc_id, x.i AS i, x.h AS h
        FROM (SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - {_W} + 1),
                  lambda i: {{'i': i, 'h': md5(array_to_string(w[i:i + {_W} - 1], ' '))}})) AS x
              FROM d WHERE len(w) >= {_W})
    ),
    r AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
    g AS (SELECT DISTINCT doc_id, i + k AS pos FROM p SEMI JOIN r USING (h), (SELECT unnest(range(0, {_W})) AS k)),
    u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
    k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept
          FROM u ANTI JOIN g USING (doc_id, pos) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
"""

MIXING = f"""
    WITH n AS (SELECT source, count(*) AS n, pow(count(*), {mixing.TEMPERATURE}) AS w FROM documents GROUP BY source),
    r AS (SELECT source, w / (SELECT sum(w) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
    p AS (SELECT source, greatest(ceil(rate / {mixing.LARGEST_RATE}), 1)::INT AS pieces,
                 rate / greatest(ceil(rate / {mixing.LARGEST_RATE}), 1) AS l FROM r),
    c AS (SELECT source, k, sum(exp(k * ln(l) - l - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
          FROM (SELECT *, unnest(generate_series(0, ceil(l + 12 * sqrt(l) + 20)::INT)) AS k FROM p)),
    d AS (SELECT doc_id, source, piece,
                 ('0x' || substr(md5('{mixing.SEED}|' || doc_id || '|' || piece), 1, 13))::BIGINT / 4503599627370496.0 AS u
          FROM (SELECT doc_id, documents.source, unnest(generate_series(0, pieces - 1)) AS piece
                FROM documents JOIN p ON documents.source IS NOT DISTINCT FROM p.source)),
    m AS (SELECT doc_id, d.source, piece, count(*) AS n FROM d
          JOIN c ON d.source IS NOT DISTINCT FROM c.source AND c.c <= u GROUP BY ALL)
    SELECT doc_id, source, piece * 1024 + k AS copy,
        md5('{mixing.SEED}:order|' || doc_id || '|' || (piece * 1024 + k)) AS position
    FROM (SELECT *, unnest(generate_series(0, n - 1)) AS k FROM m)
"""

_MARKS = _q(chat._MARKS)
_LINES = _q(chat._BREAK)

CHAT = rf"""
    WITH RECURSIVE m AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
    ),
    id AS (SELECT *, sha256(role || chr(0) || text) AS mid FROM m),
    l AS (
        SELECT conv_id, turn, mid, i, length(regexp_replace(regexp_extract(raw, {_MARKS}), '[^>]', '', 'g')) AS level,
            lower(trim(regexp_replace(regexp_replace(raw, {_MARKS}, ''), '\s+', ' ', 'g'))) AS body
        FROM (SELECT conv_id, turn, mid, unnest(regexp_split_to_array(text, {_LINES})) AS raw,
                     generate_subscripts(regexp_split_to_array(text, {_LINES}), 1) AS i FROM id)
    ),
    o AS (SELECT *, coalesce(lag(level) OVER w <> level OR lag(body) OVER w = '', true)::INT AS opens
          FROM l WINDOW w AS (PARTITION BY conv_id, turn, mid ORDER BY i)),
    u AS (SELECT * FROM (SELECT *, sum(opens) OVER (PARTITION BY conv_id, turn, mid ORDER BY i) AS run FROM o)
          WHERE body <> ''),
    p AS (
        SELECT conv_id, turn, mid, level, run::BIGINT AS place, string_agg(body, ' ' ORDER BY i) AS body
        FROM u GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT conv_id, turn, mid, level, -i, body FROM u
    ),
    f AS (SELECT conv_id, body, min(turn) AS origin FROM p WHERE level = 0 GROUP BY ALL),
    q AS (SELECT p.*, f.origin FROM p LEFT JOIN f
          ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.body = f.body AND f.origin < p.turn WHERE p.level > 0),
    a AS (SELECT conv_id, turn, mid, count(*) FILTER (place < 0) AS n_quotes,
                 count(*) FILTER (place < 0 AND origin IS NOT NULL) AS n_linked,
                 max(origin) FILTER (level = 1) AS reply_to FROM q GROUP BY ALL),
    up AS (SELECT conv_id, turn, min(reply_to) AS up FROM a WHERE reply_to IS NOT NULL GROUP BY ALL),
    chain AS (
        SELECT conv_id, turn, mid, reply_to AS root FROM a WHERE reply_to IS NOT NULL
        UNION ALL
        SELECT chain.conv_id, chain.turn, chain.mid, up.up FROM chain
        JOIN up ON chain.conv_id IS NOT DISTINCT FROM up.conv_id AND chain.root = up.turn
    ),
    r AS (SELECT conv_id, turn, mid, min(root) AS root FROM chain GROUP BY ALL),
    s AS (
        SELECT id.conv_id, role, n_quotes, n_linked,
            regexp_replace(array_to_string(list_filter(regexp_split_to_array(text, {_LINES}),
                lambda z: NOT regexp_matches(z, {_MARKS})), chr(10)), '^\s+|\s+$', '', 'g') AS body,
            row_number() OVER (PARTITION BY id.conv_id ORDER BY coalesce(root, id.turn), id.turn, id.mid) - 1 AS k
        FROM id
        LEFT JOIN a ON id.conv_id IS NOT DISTINCT FROM a.conv_id AND id.turn = a.turn AND id.mid = a.mid
        LEFT JOIN r ON id.conv_id IS NOT DISTINCT FROM r.conv_id AND id.turn = r.turn AND id.mid = r.mid
    )
    SELECT conv_id, k // {chat.SEGMENT} AS segment, count(*) AS n_messages,
        coalesce(sum(n_quotes), 0)::BIGINT AS n_quotes, coalesce(sum(n_linked), 0)::BIGINT AS n_linked,
        string_agg('<|' || role || '|>' || chr(10) || body || chr(10) || '<|end|>', chr(10) ORDER BY k) AS chat
    FROM s GROUP BY conv_id, k // {chat.SEGMENT}
"""

_FIELDS = " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n}", "text")
)
#: CRC-32 of the decimal doc_id, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), generate_series(1, 8)),
        lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

MERKLE = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, lang, sha256({_FIELDS.format(n="n_chars")}) AS leaf,
            CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0
                THEN sha256({_FIELDS.format(n="(n_chars + 1)")}) END AS given
        FROM documents
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS n
        FROM docs
    ),
    grown AS (
        SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM placed
        UNION ALL
        SELECT lang, lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos))
        FROM grown WHERE n > 1 GROUP BY lang, lvl, pos // 2
    ),
    subroots AS (
        SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
        FROM grown WHERE n = 1
    ),
    top AS (
        SELECT 0 AS lvl, pos, n, h FROM subroots
        UNION ALL
        SELECT lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos))
        FROM top WHERE n > 1 GROUP BY lvl, pos // 2
    ),
    steps AS (
        SELECT p.lang, p.pos, g.lvl, (p.pos >> g.lvl) % 2 = 1 AS ahead, coalesce(s.h, '') AS sibling
        FROM placed p
        JOIN grown g ON g.lang IS NOT DISTINCT FROM p.lang AND g.n > 1 AND g.pos = p.pos >> g.lvl
        LEFT JOIN grown s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = g.lvl AND s.pos = xor(p.pos >> g.lvl, 1)
        UNION ALL
        SELECT p.lang, p.pos, 1000 + g.lvl, (r.pos >> g.lvl) % 2 = 1, coalesce(s.h, '')
        FROM placed p
        JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
        JOIN top g ON g.n > 1 AND g.pos = r.pos >> g.lvl
        LEFT JOIN top s ON s.lvl = g.lvl AND s.pos = xor(r.pos >> g.lvl, 1)
    ),
    paths AS (
        SELECT lang, pos, string_agg(sibling, '' ORDER BY lvl) AS proof,
            list(CASE WHEN ahead THEN '<' ELSE '>' END || sibling ORDER BY lvl) AS path
        FROM steps GROUP BY lang, pos
    ),
    folded AS (
        SELECT p.doc_id, p.leaf, r.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
            sha256(coalesce(w.proof, '')) AS proof_sha256,
            list_reduce(list_prepend(coalesce(p.given, p.leaf), coalesce(w.path, [])),
                lambda x, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || x ELSE x || s[2:] END)) AS folded_root
        FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
        LEFT JOIN paths w ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos
    )
    SELECT *, folded_root = root AS verified FROM folded
"""

#: Every pair of different sets that share a shingle, and the least reachable doc_id.
MINHASH = """
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ),
    docs AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
            generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
        FROM w
    ),
    classes AS (
        SELECT min(doc_id) AS id, len(s) AS n, s, list(doc_id) AS members FROM docs WHERE len(s) > 0 GROUP BY s
    ),
    shingles AS (SELECT id, n, unnest(s) AS x FROM classes),
    links AS (
        SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.id < b.id
        GROUP BY a.id, a.n, b.id, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ),
    pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT id AS x, id AS y FROM classes
        UNION
        SELECT r.x, e.b FROM reach r JOIN pairs e ON r.y = e.a
    ),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
    found AS (
        SELECT unnest(c.members) AS doc_id, c.n AS n_shingles, l.component_id FROM classes c JOIN least l ON l.x = c.id
        UNION ALL
        SELECT doc_id, 0, doc_id FROM docs WHERE len(s) = 0
    )
    SELECT doc_id, n_shingles::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM found
"""

HARD_NEGATIVES = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, a.label = r.label AS alike, r.vec_id AS other_id,
            list_dot_product(a.v, r.v)::BIGINT AS score
        FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
    ),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
        (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id))::INTEGER AS rank,
        s.other_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
"""

SQL = {
    "op1_secret_ledger": _secrets(),
    "op2_decontamination": CONTAMINATION,
    "op6_substring_dedup": SUBSTRING,
    "op9_chat_format": CHAT,
    "op10_mixing": MIXING,
    "op11_merkle_manifest": MERKLE,
    "op12_minhash": MINHASH,
    "op13_hard_negatives": HARD_NEGATIVES,
}
