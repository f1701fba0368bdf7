"""Named queries of this subpackage and the DuckDB SQL that checks them, where SQL can express them."""

from __future__ import annotations

from . import shards
from .decontaminate import op2_decontaminate
from .forest import op4_prefix_forest
from .jaccard import op5_ngram_jaccard_join
from .katz import op10_katz_backoff
from .language import op8_language_mixture
from .lattice import op3_sentencepiece
from .packing import op6_packed_ids, packed_documents
from .pii import op1_pii, pii_base_texts
from .secrets import op9_secret_scan, secret_base_texts
from .shards import op7_feistel_shards

QUERIES = {f.__name__: f for f in (
    op1_pii,
    op2_decontaminate,
    op3_sentencepiece,
    op4_prefix_forest,
    op5_ngram_jaccard_join,
    op6_packed_ids,
    op7_feistel_shards,
    op8_language_mixture,
    op9_secret_scan,
    op10_katz_backoff,
    pii_base_texts,
    secret_base_texts,
    packed_documents,
)}

#: The Feistel network in SQL: one pass over column x with the columns side and rows.
def _pass() -> str:
    left, right = "(x // side)", "(x % side)"
    for a, b, c in shards.keys(shards.SEED):
        left, right = right, f"(({left} + ((({right} + {a}) % {shards.PRIME}) * (({right} + {b}) % {shards.PRIME}) % {shards.PRIME} * {c} % {shards.PRIME})) % side)"
    return f"({left} * side + {right})"


ORACLE_SQL: dict = {
    "pii_base_texts": r"""
WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email,
    list_filter(regexp_extract_all(coalesce(text, ''), '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda m: list_max(list_transform(string_split(m, '.'), lambda p: coalesce(TRY_CAST(p AS BIGINT), 999))) <= 255) AS ip,
    list_filter(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9]([\x20-]?[0-9])+'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 16 AND 19),
        lambda m: list_sum(list_transform(range(1, length(regexp_replace(m, '[^0-9]', '', 'g')) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) AS BIGINT)
            ELSE (2 * CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) AS BIGINT)) % 10 + CAST(substr(reverse(regexp_replace(m, '[^0-9]', '', 'g')), i, 1) AS BIGINT) // 5 END)) % 10 = 0) AS card,
    list_filter(regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 8 AND 15) AS phone FROM documents)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email, CAST(len(ip) AS BIGINT) AS n_ip, CAST(len(card) AS BIGINT) AS n_card, CAST(len(phone) AS BIGINT) AS n_phone,
    array_to_string(email, ',') AS email_texts, array_to_string(ip, ',') AS ip_texts, array_to_string(card, ',') AS card_texts, array_to_string(phone, ',') AS phone_texts FROM m
""",
    "secret_base_texts": r"""
WITH m AS (SELECT doc_id,
    list_filter(regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
        lambda m: length(regexp_extract(m, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8) AS assign,
    list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda m: length(m) >= 16) AS access,
    list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda m: length(m) >= 32) AS hex FROM documents)
SELECT doc_id, CAST(len(assign) AS BIGINT) AS n_assign, CAST(len(access) AS BIGINT) AS n_access, CAST(len(hex) AS BIGINT) AS n_hex,
    array_to_string(assign, ',') AS assign_texts, array_to_string(access, ',') AS access_texts, array_to_string(hex, ',') AS hex_texts FROM m
""",
    "packed_documents": "SELECT doc_id, CAST(count(*) AS BIGINT) AS begins, true AS whole FROM documents GROUP BY doc_id",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))
        WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
m AS (SELECT h FROM u GROUP BY h HAVING count(*) > 1),
v AS (SELECT doc_id, n, h FROM u SEMI JOIN m USING (h)),
e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM v a JOIN v b ON a.h = b.h AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, x.component_id FROM s JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) x USING (doc_id)
""",
    "op7_feistel_shards": f"""
WITH RECURSIVE bytes AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS q(i))),
sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, CASE WHEN text IS NOT NULL THEN
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda b: CAST('0x' || b AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) END AS text_crc32
  FROM documents, bytes),
n AS (SELECT *, row_number() OVER (ORDER BY (((coalesce(doc_id, 0) % {shards.PRIME}) + {shards.PRIME}) % {shards.PRIME} * {shards.SPREAD} % {shards.PRIME}) % {shards.BUCKETS}, doc_id NULLS FIRST, size, text_crc32 NULLS FIRST) - 1 AS x, count(*) OVER () AS rows FROM sized),
p AS (SELECT *, CAST(ceil(sqrt(rows)) AS BIGINT) AS side, false AS done FROM n
  UNION ALL SELECT doc_id, size, text_crc32, {_pass()}, rows, side, {_pass()} < rows FROM p WHERE NOT done)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(x % {shards.SHARDS} AS INTEGER) AS shard, x // {shards.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p WHERE done
""",
}
