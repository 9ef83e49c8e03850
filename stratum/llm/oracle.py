"""DuckDB SQL for the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from stratum.llm.license_scan import COVERAGE, DRIFT, TEMPLATES
from stratum.llm.secret_scan import RULES

# Words, shingles and distinct shingles of (id, text) rows of a table.
_SHINGLES = """
{name}_words AS (
    SELECT {key} AS id, string_split_regex(regexp_replace(lower_ascii, '^[ \\t-\\r]+|[ \\t-\\r]+$', '', 'g'), '[ \\t-\\r]+') AS w
    FROM (SELECT {key}, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM {table})
    WHERE regexp_matches(lower_ascii, '[^ \\t-\\r]')),
{name}_sets AS (
    SELECT DISTINCT id, array_to_string(list_slice(w, i, i + {size} - 1), ' ') AS s
    FROM {name}_words, unnest(range(1, greatest(2, len(w) - {size} + 2))) AS u(i))"""


def _shingles(name: str, table: str, key: str, size: int) -> str:
    return _SHINGLES.format(name=name, table=table, key=key, size=size)


# A walk by jumps of the hash generator, and CRC-32 byte by byte.
_SHARDS = """
WITH RECURSIVE walk AS (
    SELECT doc_id, CASE WHEN doc_id < 0 THEN doc_id + 18446744073709551616::HUGEINT ELSE doc_id::HUGEINT END AS k,
           -1::BIGINT AS b, 0::BIGINT AS j FROM (SELECT DISTINCT coalesce(doc_id, 0) AS doc_id FROM documents)
    UNION ALL
    SELECT doc_id, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
    FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS k2 FROM walk) WHERE j < 16),
placed AS (SELECT doc_id, b::INTEGER AS shard, (CASE WHEN j = 16 THEN 16 ELSE b END)::INTEGER AS grown_shard FROM walk WHERE j >= 16),
steps AS (
    SELECT list(v ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
        FROM range(256) AS r(i))),
bodies AS (
    SELECT doc_id, coalesce(text, '') AS body,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
    FROM documents)
SELECT d.doc_id, strlen(body)::BIGINT + 1 AS size,
       xor(list_reduce(bytes, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32,
       'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY d.doc_id) - 1 AS slot, grown_shard
FROM bodies d JOIN placed ON placed.doc_id = coalesce(d.doc_id, 0), steps"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = []
    for rank, r in enumerate(RULES):
        kinds.append(f"""
    SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, i, found, gaps FROM (
        SELECT doc_id, regexp_extract_all(body, {_quoted(r.pattern)}) AS found, string_split_regex(body, {_quoted(r.pattern)}) AS gaps
        FROM bodies WHERE regexp_matches(body, {_quoted(r.pattern)})), unnest(range(1, len(found) + 1)) AS u(i)
    {"WHERE regexp_full_match(found[i], " + _quoted(r.need) + ")" if r.need else ""}""")
    base = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)
    sums = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)
    return f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
hits AS ({" UNION ALL ".join(kinds)}),
spans AS (
    SELECT doc_id, rank, kind, start, start + length(found[i]) AS stop FROM (
        SELECT *, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS start
        FROM hits)),
listed AS (
    SELECT doc_id, {sums}, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base
    FROM spans GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM bodies LEFT JOIN listed USING (doc_id)"""


# CRC-32 of short ASCII strings, byte by byte, over the table ``crc_steps``.
_CRC_STEPS = """
crc_steps AS (
    SELECT list(v ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
        FROM range(256) AS r(i)))"""


def _crc(text: str) -> str:
    codes = f"list_transform(regexp_extract_all({text}, '.'), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


_TRIE = f"""
WITH {_CRC_STEPS},
turns AS (
    SELECT conv_id AS c, list({{'d': sha256(strlen(r) || ':' || r || x), 'w': len(list_filter(string_split_regex(x, '[ \\t-\\r]+'), lambda w: w <> ''))}}
                              ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS own
    FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations) WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT c, own, ({_crc("c::VARCHAR")}) % 4 AS h FROM turns, crc_steps),
convs AS (
    SELECT m.c, list_concat(coalesce(b.own[1:m.h], []), m.own[m.h + 1:]) AS seq FROM heads m LEFT JOIN turns b ON b.c = m.c - m.c % 20),
steps AS (
    SELECT c, d, len(seq) AS n, array_to_string(list_transform(seq[1:d], lambda t: t.d), '') AS key,
           CASE WHEN d > 0 THEN array_to_string(list_transform(seq[1:d - 1], lambda t: t.d), '') END AS parent, CASE WHEN d > 0 THEN seq[d].w ELSE 0 END AS w
    FROM convs, unnest(range(0, len(seq) + 1)) AS u(d)),
nodes AS (
    SELECT key, d, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n, any_value(w) AS w,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends
    FROM steps GROUP BY key, d),
kids AS (SELECT parent AS key, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
lines AS (
    SELECT key[1:64 * a] AS key, CASE WHEN k IS NULL THEN 1 ELSE 0 END AS leaf, (n - 1) * w AS saved
    FROM nodes LEFT JOIN kids USING (key), unnest(range(0, d + 1)) AS u(a)),
sums AS (SELECT key, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM lines GROUP BY key)
SELECT m.conv_id, m.d AS depth, p.conv_id AS parent_conv_id, m.n AS n_convs, coalesce(k, 0) AS n_children, n_leaves, saved_tokens, m.ends AS ends_sha256
FROM nodes m LEFT JOIN nodes p ON p.key = m.parent LEFT JOIN kids ON kids.key = m.key JOIN sums ON sums.key = m.key"""


def _levels(name: str, leaves: str) -> str:
    """All nodes (lvl, grp, pos, digest, n) over leaves (grp, pos, digest, n)."""
    return f"""
{name} AS (
    SELECT 0 AS lvl, grp, pos, digest, n FROM {leaves}
    UNION ALL
    SELECT lvl + 1, grp, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY lvl, grp, pos // 2, n)"""


def _written(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_LEAF = " || ".join(_written(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_FORGED = " || ".join(_written(c) for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text"))
_MANIFEST = f"""
WITH RECURSIVE {_CRC_STEPS},
hashed AS (
    SELECT doc_id, lang AS grp, sha256({_LEAF}) AS digest,
           CASE WHEN n_chars IS NOT NULL AND ({_crc("doc_id::VARCHAR")}) % 7 = 0 THEN sha256({_FORGED}) ELSE sha256({_LEAF}) END AS claim
    FROM documents, crc_steps),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed),
{_levels("tree", "leaves")},
subroots AS (
    SELECT '' AS grp, grp AS sub, digest, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
{_levels("upper", "subroots")},
steps AS (
    SELECT doc_id, l.grp, l.pos, t.lvl, (l.pos >> t.lvl) & 1 AS side, s.digest AS sibling
    FROM leaves l JOIN (SELECT DISTINCT lvl, grp FROM tree WHERE n > 1) t ON t.grp IS NOT DISTINCT FROM l.grp
    LEFT JOIN tree s ON s.grp IS NOT DISTINCT FROM l.grp AND s.lvl = t.lvl AND s.pos = xor(l.pos >> t.lvl, 1)
    UNION ALL
    SELECT doc_id, l.grp, l.pos, 1000 + t.lvl, (r.pos >> t.lvl) & 1, s.digest
    FROM leaves l JOIN subroots r ON r.sub IS NOT DISTINCT FROM l.grp JOIN (SELECT DISTINCT lvl FROM upper WHERE n > 1) t ON true
    LEFT JOIN upper s ON s.lvl = t.lvl AND s.pos = xor(r.pos >> t.lvl, 1)),
climbs AS (SELECT grp, pos, list({{'side': side, 'sibling': sibling}} ORDER BY lvl) AS climb, string_agg(sibling, '' ORDER BY lvl) AS proof FROM steps GROUP BY grp, pos),
folds AS (
    SELECT l.grp, l.pos, 0 AS done, claim AS digest, coalesce(climb, []) AS climb FROM leaves l LEFT JOIN climbs c ON c.grp IS NOT DISTINCT FROM l.grp AND c.pos = l.pos
    UNION ALL
    SELECT grp, pos, done + 1, sha256(CASE WHEN climb[done + 1].sibling IS NULL THEN digest WHEN climb[done + 1].side = 1 THEN climb[done + 1].sibling || digest
                                           ELSE digest || climb[done + 1].sibling END), climb
    FROM folds WHERE done < len(climb))
SELECT doc_id, l.digest AS leaf, r.digest AS subroot, u.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, f.digest AS folded_root, f.digest = u.digest AS verified
FROM leaves l JOIN subroots r ON r.sub IS NOT DISTINCT FROM l.grp JOIN (SELECT digest FROM upper WHERE n = 1) u ON true
LEFT JOIN climbs c ON c.grp IS NOT DISTINCT FROM l.grp AND c.pos = l.pos
JOIN folds f ON f.grp IS NOT DISTINCT FROM l.grp AND f.pos = l.pos AND done = len(f.climb)"""


def _licenses() -> str:
    rows = ", ".join(f"({t}, '{x.label}', {x.base}, {x.width()}, string_split('{x.words}', ' '))" for t, x in enumerate(TEMPLATES))
    return f"""
WITH templates(t, label, base, k, tw) AS (VALUES {rows}),
grams AS (SELECT t, label, base, k, len(tw) AS n, i - 1 AS spot, array_to_string(tw[i:i + k - 1], ' ') AS gram FROM templates, unnest(range(1, len(tw) - k + 2)) AS u(i)),
docs AS (
    SELECT doc_id, row_number() OVER () AS rid, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents),
hits AS (
    SELECT rid, t, label, base, n, g.k, spot, i - 1 AS pos, i - 1 - spot AS diagonal
    FROM docs JOIN (SELECT DISTINCT k FROM templates) ks ON true, unnest(range(1, len(w) - ks.k + 2)) AS u(i)
    JOIN grams g ON g.k = ks.k AND g.gram = array_to_string(w[i:i + ks.k - 1], ' ')),
places AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word FROM hits WHERE base GROUP BY rid),
apart AS (
    SELECT rid, t, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, t ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS far
    FROM (SELECT DISTINCT rid, t, diagonal FROM hits WHERE NOT base)),
runs AS (SELECT rid, t, diagonal, sum(far) OVER (PARTITION BY rid, t ORDER BY diagonal) AS run FROM apart),
shares AS (
    SELECT rid, label, count(DISTINCT spot + o) / any_value(n)::DOUBLE AS share
    FROM hits JOIN runs USING (rid, t, diagonal), unnest(range(0, k)) AS u(o) GROUP BY rid, t, label, run),
labelled AS (
    SELECT rid, label, label AS base_label, 1.0::DOUBLE AS share FROM hits WHERE base
    UNION ALL SELECT rid, CASE WHEN share >= {COVERAGE} THEN label END, NULL, share FROM shares),
listed AS (
    SELECT rid, coalesce(string_agg(DISTINCT base_label, ',' ORDER BY base_label), '') AS base_labels,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, max(share) AS score FROM labelled GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM docs LEFT JOIN places USING (rid) LEFT JOIN listed USING (rid)"""


ORACLE_SQL: dict[str, str] = {
    "op1_jump_shards": _SHARDS,
    "op3_minhash_containment": f"""
WITH {_shingles("d", "documents", "doc_id", 5)}, {_shingles("b", "benchmark", "item_id", 5)},
sizes AS (SELECT id, count(*) AS n FROM b_sets GROUP BY id)
SELECT d_sets.id AS doc_id, b_sets.id AS item_id, n AS item_shingles, count(*) AS shared_shingles
FROM d_sets JOIN b_sets USING (s) JOIN sizes ON sizes.id = b_sets.id
GROUP BY d_sets.id, b_sets.id, n HAVING 100 * count(*) >= 80 * n""",
    "op4_multi_index_hashing": """
WITH codes AS (
    SELECT vec_id AS id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '') AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
    SELECT q.id AS query_id, c.id AS neighbor_id, CAST(hamming(q.code, c.code) AS INTEGER) AS distance
    FROM codes q JOIN codes c ON q.id % 50 = 0 AND q.id <> c.id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
WHERE rank <= 10""",
    "op7_blob_ledger": _secrets(),
    "op8_super_minhash": f"""
WITH RECURSIVE {_shingles("d", "documents", "doc_id", 4)},
sizes AS (SELECT id, count(*) AS n FROM d_sets GROUP BY id),
links AS (
    SELECT x.id AS a, y.id AS b FROM d_sets x JOIN d_sets y ON x.s = y.s AND x.id <> y.id
    JOIN sizes m ON m.id = x.id JOIN sizes n ON n.id = y.id
    GROUP BY x.id, y.id, m.n, n.n HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a AS id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept
FROM documents LEFT JOIN sizes ON sizes.id = doc_id LEFT JOIN least_id ON least_id.id = doc_id""",
    "op11_block_trie": _TRIE,
    "op12_time_forward_manifest": _MANIFEST,
    "op13_diagonal_voting": _licenses(),
}
