"""DuckDB SQL of the queries that SQL can express. The rules are written out
here from the contracts; nothing is imported from the operators."""
from __future__ import annotations

#: Per cent limits of the method's verdict in op8, by n-gram length.
_OP8 = {5: 15, 6: 14, 8: 12, 10: 10}
_SPACE = r"[\x20\x09-\x0D]"


def _op8() -> str:
    grams = "\n".join(
        f"""UNION ALL SELECT doc_id, {n} AS n, i, count(*) OVER (PARTITION BY doc_id, {key}) AS c FROM (
            SELECT doc_id, i, w, {", ".join(f"lead(w, {j}) OVER (PARTITION BY doc_id ORDER BY i) AS w{j}" for j in range(1, n))}
            FROM words) WHERE w{n - 1} IS NOT NULL"""
        for n in _OP8 for key in ["w, " + ", ".join(f"w{j}" for j in range(1, n))])
    sums = ", ".join(f"coalesce(sum(chars) FILTER (n = {n}), 0)::BIGINT AS dup_chars_{n}" for n in _OP8)
    cols = ", ".join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in _OP8)
    passed = " AND ".join(f"100 * coalesce(dup_chars_{n}, 0) <= {most} * word_chars" for n, most in _OP8.items())
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lists),
grams AS (SELECT 0 AS doc_id, 0 AS n, 0 AS i, 0 AS c WHERE false {grams}),
hits AS (SELECT DISTINCT doc_id, n, i + j AS i FROM (SELECT doc_id, n, i, unnest(range(n)) AS j FROM grams WHERE c > 1)),
covered AS (SELECT doc_id, n, count(*) AS words, sum(length(w)) AS chars FROM hits JOIN words USING (doc_id, i) GROUP BY ALL),
measures AS (SELECT doc_id, coalesce(sum(words) FILTER (n = 5), 0)::BIGINT AS n_repeat_words, {sums} FROM covered GROUP BY 1),
split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM docs),
lines AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM split),
dups AS (SELECT doc_id, count(*)::BIGINT AS n_dup_lines, sum(length(regexp_replace(l, '{_SPACE}', '', 'g')))::BIGINT AS dup_line_chars
  FROM (SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) AS k FROM lines
        WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')) WHERE k > 1 GROUP BY 1),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in ws]), 0)::BIGINT AS word_chars FROM lists),
symbols AS (SELECT doc_id, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM docs),
joined AS (SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {cols}
  FROM base JOIN symbols USING (doc_id) LEFT JOIN measures USING (doc_id) LEFT JOIN dups USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
  AND 100 * dup_line_chars <= 30 * word_chars AND {passed} AS kept
FROM joined"""


_OP7 = """
WITH lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_OP9 = """
WITH dl AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
il AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
starts AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i
  FROM il WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM dl, lengths WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM places)
  JOIN windows USING (n, g)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dl LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)"""


#: Kinds of op3 in order: pattern, group whose length counts, least length.
_OP3 = {
    "assign": ("(?i)(password|passwd|secret|token|api_?key)[\"\']?\\x20*[:=]\\x20*[\"\']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
    "private_key": ("-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
    "forge_token": ("gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "chat_token": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    "signed_token": ("eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", 0, 1),
}


def _op3() -> str:
    parts = []
    for n, (kind, (pattern, group, least)) in enumerate(_OP3.items()):
        p = pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {n} AS rule, '{kind}' AS kind, unnest(v) AS v, unnest(m) AS m, unnest(b[:len(m)]) AS b,
            generate_subscripts(m, 1) AS i, {least} AS least FROM (SELECT doc_id, regexp_extract_all(text, '{p}', {group}) AS v,
            regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS b FROM docs WHERE regexp_matches(text, '{p}'))""")
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY doc_id, rule ORDER BY i) AS e FROM found),
spans AS (SELECT doc_id, rule, kind, e - length(m) AS s, kind || ':' || (e - length(m))::VARCHAR || ':' || e::VARCHAR AS t
  FROM placed WHERE length(v) >= least),
sums AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(t, ',' ORDER BY s, rule) FILTER (rule < 3) AS base,
    string_agg(t, ',' ORDER BY s, rule) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN sums USING (doc_id)"""


def _op12(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Rounds of nearest centroid and floored means, written one after the other."""
    near = """SELECT n, vec_id, v, min(struct_pack(d := list_sum(list_transform(range(1, {dims} + 1),
        lambda i: (v[i] - w[i]) * (v[i] - w[i])))::BIGINT, c := c)) AS a FROM kept, {of} GROUP BY n, vec_id, v"""
    parts = []
    for r in range(rounds):
        parts.append(f"""a{r} AS ({near.format(dims=dims, of=f"c{r}")}),
sums{r} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT a.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i),
means{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS w FROM sums{r} GROUP BY c),
c{r + 1} AS (SELECT c, coalesce(m.w, o.w) AS w FROM c{r} o LEFT JOIN means{r} m USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS c, v AS w
  FROM kept QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) <= {k}),
{", ".join(parts)},
final AS ({near.format(dims=dims, of=f"c{rounds}")})
SELECT vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM final JOIN c{rounds} ON c = a.c"""


ORACLES = {"op3_secret_scan": _op3(), "op7_line_dedup": _OP7, "op8_quality_rules": _op8(), "op9_decontamination": _OP9,
           "op12_centroid_clustering": _op12()}
