"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from corpusloom.llm.secrets import KINDS, PATTERNS, REACH
from corpusloom.llm.substrings import WINDOW

OP5 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

_PASSES = {
    "assign": "length(value) >= 6",
    "id": "NOT (length(hit) >= 20 AND regexp_full_match(hit, 'AKIA[A-Z0-9]+'))",
    "key": "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') "
    "AND NOT regexp_full_match(hit, '[0-9a-f]{24,}|AKIA[A-Z0-9]{16,}')",
}


def _found(kind: str) -> str:
    """All matches of a kind with their positions: sums of the lengths of pieces and matches before."""
    pattern = PATTERNS[kind].replace("'", "''")
    group = 2 if kind == "assign" else 0
    return f"""
  SELECT doc_id, {KINDS.index(kind)} AS kind, start, start + length(hit) AS "end"
  FROM (
    SELECT doc_id, hits[i] AS hit, values_[i] AS value,
           list_sum(list_transform(pieces[1:i], lambda p: length(p)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS start
    FROM (
      SELECT doc_id, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}', 0) AS hits,
             regexp_extract_all(text, '{pattern}', {group}) AS values_,
             unnest(range(1, len(regexp_extract_all(text, '{pattern}', 0)) + 1)) AS i
      FROM texts WHERE regexp_matches(text, '{pattern}')
    )
  )
  WHERE {_PASSES.get(kind, "true")}"""


def _text_of(condition: str) -> str:
    return (
        f"coalesce(string_agg(names[kind + 1] || ':' || start || ':' || \"end\", ',' ORDER BY start, kind) "
        f"FILTER (WHERE {condition}), '')"
    )


OP1 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(map(_found, KINDS))}
), linked AS (
  SELECT w.doc_id, w.kind, w.start, w."end",
         bool_or(o.kind IN (1, 3)) AS identifier, bool_or(o.kind IN (0, 2, 4)) AS secret
  FROM parts w JOIN parts o ON w.doc_id = o.doc_id AND w.kind > 2 AND o.kind < 5 AND greatest(w.start, o.start) - least(w."end", o."end") <= {REACH}
  GROUP BY ALL
), spans AS (
  SELECT doc_id, kind, start, "end" FROM parts WHERE kind < 3
  UNION ALL
  SELECT doc_id, kind, start, "end" FROM linked
  WHERE CASE kind WHEN 3 THEN secret WHEN 4 THEN identifier ELSE identifier AND secret END
)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex, sha256({_text_of("kind < 3")}) AS base_sha256,
       {_text_of("kind IS NOT NULL")} AS spans
FROM texts LEFT JOIN spans USING (doc_id), (SELECT {KINDS!r} AS names)
GROUP BY doc_id
"""

OP9 = f"""
WITH split AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
windows AS (
  SELECT *, i + {WINDOW - 1} <= n AS whole, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS seen
  FROM words
), again AS (
  SELECT *, whole AND row_number() OVER (PARTITION BY whole, seen ORDER BY doc_id, i) > 1 AS later FROM windows
), covered AS (
  SELECT doc_id, i, word, bool_or(later) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM again
)
SELECT doc_id, count(word) AS n_words, count(word) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents LEFT JOIN covered USING (doc_id)
GROUP BY doc_id
"""

OP11 = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), split AS (
  SELECT r, doc_id, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM texts WHERE text IS NOT NULL
), counted AS (
  SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM split
), tfs AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM counted GROUP BY ALL
), totals AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS documents, CAST(sum(len(terms)) AS BIGINT) AS terms FROM split
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, documents
), items AS (
  SELECT row_number() OVER () AS i, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark
), item_terms AS (
  SELECT i, item_id, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM items WHERE text IS NOT NULL
), repeats AS (
  SELECT i, item_id, term, count(*) AS c FROM item_terms GROUP BY ALL
), scored AS (
  SELECT i, item_id, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // totals.terms)))) AS BIGINT) AS score
  FROM repeats JOIN tfs USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

OP13 = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), tokens AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(hex, i, 8) AS BIGINT)) AS h
  FROM texts
), cuts AS (
  SELECT *, len(t) AS n, least(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) AS a, greatest(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM tokens
), parts AS (
  SELECT *, array_to_string(t[1:a], '') AS prefix, array_to_string(t[a + 1:b], '') AS middle, array_to_string(t[b + 1:], '') AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""

ORACLE: dict[str, str] = {"op1_secrets": OP1, "op5_topk": OP5, "op9_substrings": OP9, "op11_lexical": OP11, "op13_fill_in_middle": OP13}
