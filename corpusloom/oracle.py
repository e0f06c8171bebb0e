"""The registered queries in SQL, for a comparison on the same tables.

Token sequences are strings of fixed-width codes, ``00ab|`` per id.  A two-code search string can only match at a
token border, so ``replace`` is a merge.  The SQL regex engine has no look-ahead: a marker is put between the last
white-space character before a word and those before it, which is where the look-ahead would stop.
"""

from __future__ import annotations

from corpusloom import queries as q
from corpusloom.functions.patterns import GPT2PAT, GPT4PAT

# White space as Unicode has it; \s alone is ASCII in this regex dialect.
WS = r"\t-\r \x{85}\p{Z}"
MARK = ""


def _without_look_ahead(pattern: str) -> str:
    """A split pattern in this dialect: no possessive quantifiers, and the marker where the look-ahead would stop."""
    steps = (
        (r"\s+(?!\S)|\s+", f"[{WS}]+{MARK}|[{WS}]+"),
        (r"\s*[\r\n]", rf"[{WS}]*{MARK}?[\r\n]"),
        (r"\p{N}]", rf"\p{{N}}{MARK}]"),
        ("?+", "?"),
        ("++", "+"),
        (r"\s", WS),
    )
    for old, replacement in steps:
        pattern = pattern.replace(old, replacement)
    return pattern


GPT2_SQL = _without_look_ahead(GPT2PAT)
GPT4_SQL = _without_look_ahead(GPT4PAT)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _code(token_id: int) -> str:
    return f"{token_id:04x}|"


def _codes(text: str) -> str:
    return f"regexp_replace(lower(hex(encode({text}))), '(..)', '00\\1|', 'g')"


def _number(code: str) -> str:
    return f"CAST('0x' || substr({code}, 1, 4) AS INT)"


def _pieces(text: str, pattern: str) -> str:
    """List of pre-tokens of a text expression."""
    marked = f"regexp_replace({text}, '([{WS}]+)([{WS}])([^{WS}])', '\\1{MARK}\\2\\3', 'g')"
    return (
        f"list_filter(list_transform(regexp_extract_all({marked}, {_text(pattern)}), "
        f"lambda p: replace(p, '{MARK}', '')), lambda p: p <> '')"
    )


OCCURRENCES = f"""
split_docs AS MATERIALIZED (SELECT doc_id, lang, {_pieces("text", GPT4_SQL)} AS ps FROM documents),
occ AS MATERIALIZED (SELECT doc_id, lang, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS idx FROM split_docs)"""

WORDS = f"""{OCCURRENCES},
words AS (SELECT p, count(*) AS n, min(doc_id * 16777216 + idx) AS f FROM occ GROUP BY p),
w0 AS MATERIALIZED (SELECT {_codes("p")} AS s, n, row_number() OVER (ORDER BY f) AS ord FROM words)"""


def _word_pairs(i: int) -> str:
    return (
        f"SELECT substr(s, 5 * t.i + 1, 10) AS pr, n, ord * 1000000 + t.i AS k "
        f"FROM w{i}, unnest(range(0, CAST(length(s) // 5 AS BIGINT) - 1)) AS t(i)"
    )


def _text_pairs(i: int) -> str:
    lists = f"SELECT ord, n, string_split(rtrim(s, '|'), '|') AS l FROM w{i} WHERE s <> ''"
    return (
        f"SELECT a || '|' || b || '|' AS pr, n, ord * 16777216 + i AS k FROM (SELECT ord, n, unnest(l[1:len(l)-1]) AS a, "
        f"unnest(l[2:len(l)]) AS b, unnest(range(0, len(l) - 1)) AS i FROM ({lists}))"
    )


def _rounds(rounds: int, pairs) -> str:
    """Count, take the top pair, merge: three steps per round, then the merges as a table."""
    steps = []
    for i in range(rounds):
        steps.append(
            f"t{i} AS MATERIALIZED (SELECT pr, sum(n) AS c, min(k) AS f FROM ({pairs(i)}) GROUP BY pr "
            f"HAVING sum(n) > 1 ORDER BY c DESC, f LIMIT 1)"
        )
        steps.append(
            f"w{i + 1} AS MATERIALIZED (SELECT replace(s, (SELECT pr FROM t{i}), '{_code(256 + i)}') AS s, n, ord "
            f"FROM w{i})"
        )
    rows = " UNION ALL ".join(f"SELECT {i} AS rank, pr, c FROM t{i}" for i in range(rounds))
    steps.append(
        f"m AS MATERIALIZED (SELECT rank, pr, {_number('pr')} AS l, {_number('substr(pr, 6, 4)')} AS r, "
        f"256 + rank AS id, CAST(c AS BIGINT) AS c FROM ({rows}))"
    )
    return ",\n".join(steps)


TRAINED = f"{WORDS},\n{_rounds(q.TRAINED_ROUNDS, _word_pairs)}"
TEXT_TRAINED = (
    f"w0 AS MATERIALIZED (SELECT {_codes('text')} AS s, 1 AS n, doc_id AS ord FROM documents),\n"
    + _rounds(q.TEXT_ROUNDS, _text_pairs)
)

_TRACE = 'SELECT rank AS round, l AS "left", r AS "right", id AS token_id, c AS cnt FROM m'
SOURCES_TRAINED = (
    f"w0 AS MATERIALIZED (SELECT {_codes('source')} AS s, 1 AS n, doc_id AS ord FROM documents),\n"
    + _rounds(q.STOPPING_ROUNDS, _text_pairs)
)

# A long list of merges: the most frequent byte pairs, then each two neighbours among these merges.
LARGE_MERGES = f"""
byte_lists AS (SELECT doc_id, string_split(rtrim(s, '|'), '|') AS l FROM
               (SELECT doc_id, {_codes("text")} AS s FROM documents)),
byte_pairs AS (SELECT doc_id, unnest(l[1:len(l)-1]) AS a, unnest(l[2:len(l)]) AS b, unnest(range(0, len(l) - 1)) AS i
               FROM byte_lists),
common AS (SELECT a || '|' || b || '|' AS pr, row_number() OVER (ORDER BY count(*) DESC, min(doc_id * 16777216 + i)) - 1 AS rank
           FROM byte_pairs GROUP BY a, b),
large AS MATERIALIZED (SELECT list(pr || lpad(to_hex(256 + rank), 4, '0') || '|' ORDER BY rank) AS ms FROM (
    SELECT lower(pr) AS pr, rank FROM common WHERE rank < {q.COMMON_PAIRS}
    UNION ALL SELECT lower(lpad(to_hex(256 + i), 4, '0') || '|' || lpad(to_hex(257 + i), 4, '0') || '|'), {q.COMMON_PAIRS} + i
    FROM range(0, {q.PAIRED_MERGES}) AS g(i)))"""


def _large(seq: str) -> str:
    """All merges of the long list in order, over the codes of a text."""
    return f"list_reduce((SELECT ms FROM large), lambda s, m: replace(s, substr(m, 1, 10), lower(substr(m, 11, 5))), {seq})"


# Bytes of every id, as hexadecimal text: single bytes, then one step per merge.
_VOCAB_STEPS = ["v0 AS (SELECT i AS token_id, lower(lpad(to_hex(i), 2, '0')) AS b FROM range(0, 256) AS g(i))"]
for _i in range(q.TRAINED_ROUNDS):
    _VOCAB_STEPS.append(
        f"v{_i + 1} AS MATERIALIZED (SELECT * FROM v{_i} UNION ALL SELECT m.id, a.b || b.b FROM m "
        f"JOIN v{_i} a ON a.token_id = m.l JOIN v{_i} b ON b.token_id = m.r WHERE m.rank = {_i})"
    )
VOCAB = f"{TRAINED},\n" + ",\n".join(_VOCAB_STEPS) + f",\nvocab AS (SELECT * FROM v{q.TRAINED_ROUNDS})"


def _merged(seq: str) -> str:
    for i in range(q.TRAINED_ROUNDS):
        seq = f"replace({seq}, (SELECT pr FROM t{i}), '{_code(256 + i)}')"
    return seq


ENCODED = f"""{TRAINED},
enc AS (SELECT doc_id, any_value(lang) AS lang, string_agg({_merged(_codes("p"))}, '' ORDER BY idx) AS s
        FROM occ GROUP BY doc_id)"""

_DIGEST = "CAST(length(s) // 5 AS INT) AS n_tokens, md5(s) AS digest"


# Corpus stream of the byte vocabulary

DOC_CODES = f"""
doc_codes AS MATERIALIZED (SELECT doc_id, '{_code(q.BYTE_EOT)}' || {_codes("text")} AS s FROM documents),
placed AS MATERIALIZED (SELECT doc_id, s, CAST(length(s) // 5 AS BIGINT) AS n_tokens,
    CAST(coalesce(sum(length(s) // 5) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS BIGINT) AS o FROM doc_codes)"""


def _shards(size: int) -> str:
    return f"""{DOC_CODES},
cut AS (SELECT doc_id, s, n_tokens, o, unnest(range(o // {size}, (o + n_tokens - 1) // {size} + 1)) AS shard
        FROM placed),
shards AS MATERIALIZED (
    SELECT CASE WHEN shard = 0 THEN 'valid' ELSE 'train' END AS split, CAST(shard AS INT) AS shard, doc_id,
        greatest(shard * {size}, o) - shard * {size} AS shard_pos,
        substr(s, 5 * (greatest(shard * {size}, o) - o) + 1,
               5 * (least((shard + 1) * {size}, o + n_tokens) - greatest(shard * {size}, o))) AS s
    FROM cut)"""


MANIFEST = f"""{_shards(q.SHARD_SIZE)},
manifest AS MATERIALIZED (SELECT split, shard, CAST(sum(length(s) // 5) AS BIGINT) AS n_tokens, count(*) AS n_docs
                          FROM shards GROUP BY split, shard)"""

_N, _W = q.BATCH * q.SEQ, q.WORLD


def _plan(split: str) -> str:
    """The loader's rule spelled out: batch k of a rank is read if it is the first or ends before the last token."""
    return f"""{MANIFEST},
per_rank AS (SELECT shard, n_tokens, CAST(r AS INT) AS rank FROM manifest, range(0, {_W}) AS g(r)
             WHERE split = '{split}'),
taken AS MATERIALIZED (SELECT shard, rank, k FROM per_rank, unnest(range(0, n_tokens // {_N * _W} + 2)) AS g(k)
          WHERE k = 0 OR (rank + k * {_W}) * {_N} + {_N} + 1 < n_tokens),
plan AS MATERIALIZED (SELECT rank, row_number() OVER (PARTITION BY rank ORDER BY shard, k) - 1 AS batch_index, shard,
                (rank + k * {_W}) * {_N} AS start, k FROM taken)"""


def _epochs(split: str, steps: int, restart: int | None = None) -> str:
    place = f"(i % {restart})" if restart else "i"
    return f"""{_plan(split)},
totals AS (SELECT rank, count(*) AS total FROM plan GROUP BY rank),
ticks AS (SELECT rank, total, i FROM totals, range(0, {steps}) AS g(i)),
epochs AS MATERIALIZED (SELECT CAST({place} // total AS INT) AS epoch, t.rank, i AS batch_index, p.shard, p.start
           FROM ticks t JOIN plan p ON p.rank = t.rank AND p.batch_index = {place} % total)"""


def _batches(plan: str) -> str:
    """Rows of the planned batches, read off the codes of the whole shard."""
    width = 5 * q.SEQ
    return f"""
whole AS MATERIALIZED (SELECT shard, string_agg(s, '' ORDER BY shard_pos) AS s FROM shards GROUP BY shard),
batches AS MATERIALIZED (SELECT p.rank, p.batch_index, CAST(b AS INT) AS row, p.shard,
    substr(w.s, 5 * p.start + b * {width} + 1, {width}) AS inputs,
    substr(w.s, 5 * p.start + b * {width} + 6, {width}) AS targets
    FROM {plan} p JOIN whole w ON w.shard = p.shard, range(0, {q.BATCH}) AS g(b))"""


# Multiple-choice items

ITEMS = f"""
halves AS (SELECT item_id, CAST(item_id % 4 AS INT) AS label, string_split(text, ' ') AS w,
           len(string_split(text, ' ')) // 2 AS h FROM benchmark),
parts AS (SELECT item_id, label, array_to_string(w[1:h], ' ') AS ctx, array_to_string(w[h+1:len(w)], ' ') AS ending
          FROM halves),
choices AS MATERIALIZED (SELECT a.item_id, a.label, a.ctx, CAST(j AS INT) AS j, b.ending
            FROM parts a, range(0, 4) AS g(j), parts b
            WHERE b.item_id = (a.item_id + (j - a.label + 4) % 4) % (SELECT count(*) FROM benchmark))"""

RENDERED = f"""{ITEMS},
rendered AS MATERIALIZED (SELECT item_id, j AS ending_idx, label,
    {_codes("ctx")} || {_codes("' ' || ending")} AS s, length({_codes("ctx")}) // 5 AS n_ctx,
    length({_codes("' ' || ending")}) // 5 AS n_end FROM choices),
padded AS MATERIALIZED (SELECT *, CAST(max(n_ctx + n_end) OVER (PARTITION BY item_id) AS INT) AS max_len
                        FROM rendered)"""

# The pre-tokens of both texts of a choice, those of the context with negative places, and the codes of each distinct one.
_CHOICE_PIECES = f"""
choice_pieces AS MATERIALIZED (
    SELECT item_id, j, unnest(l) AS p, unnest(range(1, len(l) + 1)) - 1000000 AS i
    FROM (SELECT item_id, j, {_pieces("ctx", GPT4_SQL)} AS l FROM choices)
    UNION ALL SELECT item_id, j, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i
    FROM (SELECT item_id, j, {_pieces("' ' || ending", GPT4_SQL)} AS l FROM choices)),
piece_codes AS MATERIALIZED (SELECT p, {_large(_codes("p"))} AS s FROM (SELECT DISTINCT p FROM choice_pieces))"""

# The list form avoids walking a long string for every position.
_BIGRAM_TABLES = """
bigrams AS MATERIALIZED (SELECT a, b, count(*) AS n FROM (
    SELECT unnest(l[1:len(l)-1]) AS a, unnest(l[2:len(l)]) AS b
    FROM (SELECT string_split(rtrim(string_agg(s, '' ORDER BY shard_pos), '|'), '|') AS l
          FROM shards WHERE split = 'train' GROUP BY shard)) GROUP BY a, b),
bigram_totals AS MATERIALIZED (SELECT a, sum(n) AS n FROM bigrams GROUP BY a)"""
BIGRAMS = f"{_shards(q.SHARD_SIZE)},{_BIGRAM_TABLES}"


def _loss(table: str) -> str:
    """Loss of rows with codes (a, b) under the smoothed counts."""
    return f"""(SELECT x.*, -ln((coalesce(g.n, 0) + 1) / (coalesce(t.n, 0) + {q.BYTE_VOCAB})) AS loss FROM {table} x
        LEFT JOIN bigrams g ON g.a = x.a AND g.b = x.b LEFT JOIN bigram_totals t ON t.a = x.a)"""


POSITIONS = f"""{RENDERED},
{BIGRAMS},
positions AS (SELECT item_id, ending_idx, CAST(i AS INT) AS pos,
        coalesce(nullif(substr(s, 5 * i + 1, 4), ''), '0000') AS a,
        coalesce(nullif(substr(s, 5 * i + 6, 4), ''), '0000') AS b,
        CASE WHEN i + 1 >= n_ctx AND i + 1 < n_ctx + n_end THEN 1 ELSE 0 END AS mask
    FROM padded, unnest(range(0, max_len - 1)) AS g(i)),
losses AS MATERIALIZED (SELECT item_id, ending_idx, pos, loss, CAST(mask AS INT) AS mask FROM {_loss("positions")}),
scores AS MATERIALIZED (SELECT item_id, ending_idx, sum(loss * mask) AS sum_loss, CAST(sum(mask) AS BIGINT) AS n_masked,
           sum(loss * mask) / nullif(sum(mask), 0) AS avg_loss FROM losses GROUP BY item_id, ending_idx),
ranked AS (SELECT item_id, ending_idx,
           row_number() OVER (PARTITION BY item_id ORDER BY sum_loss NULLS LAST, ending_idx) AS by_sum,
           row_number() OVER (PARTITION BY item_id ORDER BY avg_loss NULLS LAST, ending_idx) AS by_avg FROM scores),
preds AS MATERIALIZED (SELECT item_id, max(CASE WHEN by_sum = 1 THEN ending_idx END) AS pred,
          max(CASE WHEN by_avg = 1 THEN ending_idx END) AS pred_norm, CAST(item_id % 4 AS INT) AS label
          FROM ranked GROUP BY item_id)"""

_COUNTERS = f"""count(*) AS num_total, CAST(coalesce(sum(CAST(pred = label AS INT)), 0) AS BIGINT) AS num_correct,
    CAST(coalesce(sum(CAST(pred_norm = label AS INT)), 0) AS BIGINT) AS num_correct_norm,
    round(sum(CAST(pred = label AS INT)) / count(*), {q.DIGITS}) AS acc,
    round(sum(CAST(pred_norm = label AS INT)) / count(*), {q.DIGITS}) AS acc_norm"""


def _pieces_digest(pattern: str) -> str:
    return (
        "SELECT doc_id, CAST(len(ps) AS INT) AS n_pieces, md5(array_to_string(ps, '␟')) AS digest FROM "
        f"(SELECT doc_id, {_pieces('text', pattern)} AS ps FROM documents)"
    )


_BYTE_PAIRS = """
lists AS (SELECT doc_id, string_split(rtrim(s, '|'), '|') AS l FROM
          (SELECT doc_id, {codes} AS s FROM documents)),
pairs AS (SELECT doc_id, unnest(l[1:len(l)-1]) AS a, unnest(l[2:len(l)]) AS b, unnest(range(0, len(l) - 1)) AS i
          FROM lists),
counted AS (SELECT CAST('0x' || a AS INT) AS "left", CAST('0x' || b AS INT) AS "right", count(*) AS cnt,
            min(doc_id * 16777216 + i) AS f FROM pairs GROUP BY a, b)""".format(codes=_codes("text"))
_PAIR_COLUMNS = '"left", "right", cnt, f // 16777216 AS first_doc, f % 16777216 AS first_pos'

# A token of the trained vocabulary as text: a lone byte above 7f is invalid, a merge may hold whole characters.
_READABLE = (
    "CASE WHEN length(b) = 2 AND b >= '80' THEN chr(65533) "
    "WHEN regexp_matches(b, '^([0-7].|c[2-9a-f][89ab].|d.[89ab].|e.[89ab].[89ab].)+$') THEN decode(unhex(b)) "
    "ELSE decode(unhex(regexp_replace(b, '(c[2-9a-f]|d.)$', ''))) || chr(65533) END"
)
_NAMES = f"{VOCAB},\nnames AS MATERIALIZED (SELECT token_id, b, {_READABLE} AS s FROM vocab)"
_ESCAPED = (
    "CASE WHEN length(s) = 1 AND (ord(s) < 32 OR ord(s) = 127) THEN '\\u' || lpad(lower(to_hex(ord(s))), 4, '0') "
    "ELSE s END"
)
_RENDER_LIST = (
    "list_transform(string_split(text, ''), lambda c: CASE WHEN regexp_matches(c, '\\p{C}') "
    "THEN '\\u' || lpad(lower(to_hex(ord(c))), CAST(greatest(4, length(to_hex(ord(c)))) AS INT), '0') ELSE c END)"
)


def _specials_hit() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {_text(token)} AS token, count(*) AS docs FROM documents WHERE contains(text, {_text(token)})"
        for token in q.LITERALS
    )
    return f"SELECT * FROM ({rows}) WHERE docs > 0"


_VAL_PAIRS = (
    f"{_BIGRAM_TABLES}, val_pairs AS (SELECT rank, batch_index, \"row\", CAST(i AS INT) AS pos, "
    f"substr(inputs, 5 * i + 1, 4) AS a, substr(targets, 5 * i + 1, 4) AS b FROM batches, range(0, {q.SEQ}) AS g(i))"
)

ORACLE: dict[str, str] = {
    "read_corpus": "SELECT doc_id, octet_length(encode(text)) AS n_bytes FROM documents",
    "read_corpus_lang": "SELECT lang, count(*) AS docs, max(doc_id) AS last_doc FROM documents "
    "WHERE lang IN ('fr', 'es') GROUP BY lang",
    "read_corpus_lists": "SELECT doc_id, lang, octet_length(encode(text)) AS n_bytes FROM documents "
    "WHERE lang IS NOT NULL",
    "corpus_order": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_ord FROM documents",
    "read_choice_items": f"WITH {ITEMS} SELECT item_id, ctx, label, string_agg(ending, ' ## ' ORDER BY j) AS endings "
    "FROM choices GROUP BY item_id, ctx, label",
    "byte_tokens": f"SELECT doc_id, {_DIGEST} FROM (SELECT doc_id, {_codes('text')} AS s FROM documents)",
    "pretokenize_gpt2": _pieces_digest(GPT2_SQL),
    "pretokenize_gpt4": _pieces_digest(GPT4_SQL),
    "pretokenize_custom": "SELECT doc_id, CAST(len(ps) AS INT) AS n_pieces, md5(array_to_string(ps, '␟')) AS digest "
    f"FROM (SELECT doc_id, regexp_extract_all(text, {_text(q.CUSTOM_PATTERN)}) AS ps FROM documents)",
    "split_pretokens": "SELECT doc_id, count(*) AS n, CAST(max(idx) AS INT) AS last_idx, "
    "md5(string_agg(p, '␟' ORDER BY idx)) AS digest FROM "
    "(SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS idx FROM (SELECT doc_id, "
    f"regexp_extract_all(text, {_text(q.CUSTOM_PATTERN)}) AS ps FROM documents)) GROUP BY doc_id",
    "pretoken_counts": f"WITH {OCCURRENCES} SELECT p AS pretoken, count(*) AS n, "
    "min(doc_id * 16777216 + idx) // 16777216 AS first_doc, min(doc_id * 16777216 + idx) % 16777216 AS first_idx "
    "FROM occ GROUP BY p",
    "pair_counts": f"WITH {_BYTE_PAIRS} SELECT {_PAIR_COLUMNS} FROM counted",
    "top_pair": f"WITH {_BYTE_PAIRS} SELECT {_PAIR_COLUMNS} FROM counted ORDER BY cnt DESC, f LIMIT 1",
    "merge_pair": f"SELECT doc_id, {_DIGEST} FROM (SELECT doc_id, replace({_codes('text')}, "
    f"'{_code(q.MERGED_PAIR[0])}{_code(q.MERGED_PAIR[1])}', '{_code(q.MERGED_PAIR[2])}') AS s FROM documents)",
    "train_bpe_text": f'WITH {TEXT_TRAINED} SELECT rank AS round, l AS "left", r AS "right", id AS token_id, c AS cnt '
    "FROM m",
    "train_bpe_pretoken": f'WITH {TRAINED} SELECT rank, l AS "left", r AS "right", id AS token_id FROM m',
    "train_bpe_long": f"WITH {WORDS}, {_rounds(q.LONG_ROUNDS, _word_pairs)} {_TRACE}",
    "train_bpe_stops": f"WITH {SOURCES_TRAINED} {_TRACE}",
    "merge_trace": f'WITH {TRAINED} SELECT rank AS round, l AS "left", r AS "right", id AS token_id, c AS cnt FROM m',
    "train_bpe_sparse_ids": f"WITH {TRAINED} {_TRACE}",
    "merges_pretty": f"WITH {_NAMES} SELECT m.rank, '[' || a.s || '][' || b.s || '] -> [' || c.s || ']' AS merge "
    "FROM m JOIN names a ON a.token_id = m.l JOIN names b ON b.token_id = m.r JOIN names c ON c.token_id = m.id",
    "build_vocab": f"WITH {VOCAB} SELECT token_id, b AS bytes FROM vocab",
    "vocab_size": f"WITH {VOCAB} SELECT count(*) AS vocab_size FROM vocab",
    "vocab_report": f"WITH {_NAMES}, esc AS MATERIALIZED (SELECT token_id, {_ESCAPED} AS s FROM names) "
    "SELECT e.token_id, CASE WHEN m.id IS NULL THEN '[' || e.s || '] ' || e.token_id "
    "ELSE '[' || a.s || '][' || b.s || '] -> [' || e.s || '] ' || e.token_id END AS line FROM esc e "
    "LEFT JOIN m ON m.id = e.token_id LEFT JOIN esc a ON a.token_id = m.l LEFT JOIN esc b ON b.token_id = m.r",
    "render_token": "SELECT doc_id, md5(r) AS digest, CAST(length(r) AS INT) AS n_chars FROM "
    f"(SELECT doc_id, array_to_string({_RENDER_LIST}, '') AS r FROM documents)",
    "special_tokens": f"WITH {VOCAB} SELECT '<|endoftext|>' AS token, CAST(count(*) AS INT) AS token_id FROM vocab "
    "UNION ALL SELECT '<|' || lang || '|>', CAST(row_number() OVER (ORDER BY lang) + (SELECT count(*) FROM vocab) "
    "AS INT) FROM (SELECT DISTINCT lang FROM documents)",
    "save_load_tokenizer": f"WITH {TRAINED} SELECT 'merge' AS kind, l || ' ' || r AS value, id AS token_id FROM m "
    f"UNION ALL SELECT 'special', '<|endoftext|>', {256 + q.TRAINED_ROUNDS} "
    f"UNION ALL SELECT 'pattern', {_text(GPT4PAT)}, NULL",
    "encode_text": f"WITH {TRAINED} SELECT doc_id, {_DIGEST} FROM "
    f"(SELECT doc_id, {_merged(_codes('text'))} AS s FROM documents)",
    "encode_text_dictionary": f"WITH {TRAINED} SELECT doc_id, {_DIGEST} FROM "
    f"(SELECT doc_id, {_merged(_codes('text'))} AS s FROM documents)",
    "encode_pretoken": f"WITH {ENCODED} SELECT doc_id, {_DIGEST} FROM enc",
    "encode_pretoken_dictionary": f"WITH {ENCODED} SELECT doc_id, {_DIGEST} FROM enc",
    "encode_text_large": f"WITH {LARGE_MERGES} SELECT doc_id, {_DIGEST} FROM "
    f"(SELECT doc_id, {_large(_codes('text'))} AS s FROM documents)",
    "encode_pretoken_large": f"WITH {OCCURRENCES}, {LARGE_MERGES}, merged AS MATERIALIZED (SELECT p, "
    f"{_large(_codes('p'))} AS s FROM (SELECT DISTINCT p FROM occ)) SELECT doc_id, {_DIGEST} FROM (SELECT doc_id, "
    "string_agg(merged.s, '' ORDER BY idx) AS s FROM occ JOIN merged USING (p) GROUP BY doc_id)",
    "decode": "SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INT) AS n_chars FROM documents",
    "round_trip_report": f"WITH {ENCODED} SELECT lang, count(*) AS docs, count(*) AS exact, "
    "CAST(sum(octet_length(encode(d.text))) AS BIGINT) AS bytes, CAST(sum(length(s) // 5) AS BIGINT) AS tokens, "
    f"round(sum(length(s) // 5) / sum(octet_length(encode(d.text))), {q.DIGITS}) AS tokens_per_byte "
    "FROM enc JOIN (SELECT doc_id, text FROM documents) d USING (doc_id) GROUP BY lang",
    "special_token_audit": _specials_hit(),
    "special_token_audit_many": "SELECT token, count(*) AS docs FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS token "
    "FROM benchmark) JOIN documents ON token <> '' AND contains(text, token) GROUP BY token",
    "tokenize_documents": f"WITH {ENCODED} SELECT doc_id, {_DIGEST} FROM "
    f"(SELECT doc_id, '{_code(256 + q.TRAINED_ROUNDS)}' || s AS s FROM enc)",
    "validate_token_ids": "SELECT doc_id, CAST(nullif(bad, 0) AS INT) AS n_bad, "
    "CAST(CASE WHEN bad = 0 THEN n END AS INT) AS n_tokens FROM (SELECT doc_id, octet_length(encode(text)) AS n, "
    "len(list_filter(regexp_extract_all(lower(hex(encode(text))), '..'), lambda b: b >= '80')) AS bad FROM documents)",
    "token_offsets": f'WITH {DOC_CODES} SELECT doc_id, n_tokens, o AS "offset" FROM placed',
    "pack_shards": f"WITH {_shards(q.SHARD_SIZE)} SELECT split, shard, shard_pos, doc_id, {_DIGEST} FROM shards",
    "pack_small_shards": f"WITH {_shards(q.SMALL_SHARD_SIZE)} SELECT split, shard, shard_pos, doc_id, {_DIGEST} "
    "FROM shards",
    "assign_split": f"WITH {_shards(q.SHARD_SIZE)} SELECT split, min(shard) AS first_shard, max(shard) AS last_shard, "
    "count(*) AS pieces FROM shards GROUP BY split",
    "shard_manifest": f"WITH {MANIFEST} SELECT split, shard, 'corpus_' || split || '_' || lpad(CAST(shard AS VARCHAR), "
    "6, '0') AS name, n_tokens, n_docs FROM manifest",
    "plan_shards": f"WITH {MANIFEST} SELECT CAST(sum(n_tokens) // {q.SHARD_SIZE} AS BIGINT) AS planned, "
    "count(*) AS found, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM manifest",
    "write_read_shards": f"WITH {_shards(q.SHARD_SIZE)} SELECT split, shard, shard_pos, doc_id, 'corpus_' || split || "
    f"'_' || lpad(CAST(shard AS VARCHAR), 6, '0') AS name, {_DIGEST} FROM shards",
    "batch_plan": f'WITH {_plan("train")} SELECT rank, batch_index, shard, start AS "start" FROM plan',
    "rank_totals": f"WITH {_plan('train')} SELECT shard, rank, count(*) AS batches, min(batch_index) AS first_index "
    "FROM plan GROUP BY shard, rank",
    "epochs": f'WITH {_epochs("train", q.STEPS_PER_RANK)} SELECT epoch, rank, batch_index, shard, start AS "start" '
    "FROM epochs",
    "epochs_restarted": f'WITH {_epochs("train", q.RESTARTED_STEPS, q.RESTART_EVERY)} SELECT epoch, rank, batch_index, '
    'shard, start AS "start" FROM epochs',
    "materialize_batches": f'WITH {_plan("train")}, {_batches("plan")} SELECT rank, batch_index, "row", shard, '
    "md5(inputs) AS inputs, md5(targets) AS targets FROM batches",
    "step_plan": f"WITH {_plan('train')} SELECT step, count(*) AS micro_batches, count(*) * {_N} AS tokens, "
    f'count(*) * {_N} = {q.STEP_TOKENS} AS "full" FROM (SELECT batch_index // {q.STEP_TOKENS // (_N * _W)} AS step '
    "FROM plan) GROUP BY step",
    "validation_batches": f'WITH {_epochs("valid", q.VALIDATION_BATCHES)} SELECT epoch, rank, batch_index, shard, '
    'start AS "start" FROM epochs',
    "render_choices": f"WITH {RENDERED} SELECT item_id, ending_idx, s AS tokens, "
    "repeat('0', n_ctx) || repeat('1', n_end) AS mask, label FROM rendered",
    "render_choices_large": f"WITH {ITEMS}, {LARGE_MERGES}, {_CHOICE_PIECES}, coded AS (SELECT item_id, j, "
    "coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE i < 0), '') AS c, coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE i > 0), '') AS e "
    "FROM choice_pieces LEFT JOIN piece_codes USING (p) GROUP BY item_id, j) SELECT item_id, j AS ending_idx, c || e AS tokens, "
    "repeat('0', length(c) // 5) || repeat('1', length(e) // 5) AS mask, label FROM coded JOIN choices USING (item_id, j)",
    "pad_choices": f"WITH {RENDERED} SELECT item_id, ending_idx, s || repeat('0000|', max_len - n_ctx - n_end) "
    "AS tokens, repeat('0', n_ctx) || repeat('1', n_end) || repeat('0', max_len - n_ctx - n_end) AS mask, max_len "
    "FROM padded",
    "position_losses": f"WITH {POSITIONS} SELECT item_id, ending_idx, pos, round(loss, {q.DIGITS}) AS loss, mask "
    "FROM losses",
    "position_losses_sliced": f"WITH {POSITIONS} SELECT item_id, ending_idx, pos, round(loss, {q.DIGITS}) AS loss, mask "
    "FROM losses",
    "bigram_scores": f"WITH {POSITIONS} SELECT item_id, ending_idx, pos, round(loss, {q.DIGITS}) AS loss, mask "
    "FROM losses",
    "bigram_counts": f"WITH {BIGRAMS} SELECT CAST('0x' || a AS INT) AS prev, CAST('0x' || b AS INT) AS \"next\", n "
    "FROM bigrams",
    "choice_scores": f"WITH {POSITIONS} SELECT item_id, ending_idx, round(sum_loss, {q.DIGITS}) AS sum_loss, n_masked, "
    f"round(avg_loss, {q.DIGITS}) AS avg_loss FROM scores",
    "choice_predictions": f"WITH {POSITIONS} SELECT item_id, pred, pred_norm, label FROM preds",
    "choice_accuracy": f"WITH {POSITIONS} SELECT {_COUNTERS} FROM preds",
    "choice_accuracy_by_rank": f"WITH {POSITIONS} SELECT item_id % {_W} AS rank, {_COUNTERS} FROM preds "
    f"GROUP BY ROLLUP (item_id % {_W})",
    "choice_examples": f"WITH {POSITIONS} SELECT c.item_id, c.ctx, string_agg(c.j || ' (loss: ' || "
    "printf('%.4f', s.avg_loss) || ') ' || c.ending, ' ## ' ORDER BY c.j) AS endings, any_value(p.pred_norm) AS "
    "predicted, any_value(c.label) AS actual FROM choices c JOIN scores s ON s.item_id = c.item_id AND "
    "s.ending_idx = c.j JOIN preds p ON p.item_id = c.item_id WHERE c.item_id IN (SELECT item_id FROM benchmark "
    "ORDER BY item_id LIMIT 9) GROUP BY c.item_id, c.ctx",
    "validation_loss": f"WITH {_epochs('valid', q.VALIDATION_BATCHES)}, {_batches('epochs')}, "
    f"{_VAL_PAIRS}, val_batch AS (SELECT rank, batch_index, avg(loss) AS loss "
    f"FROM {_loss('val_pairs')} GROUP BY rank, batch_index), val_rank AS (SELECT rank, avg(loss) AS loss, "
    f"count(*) AS batches FROM val_batch GROUP BY rank) SELECT round(avg(loss), {q.DIGITS}) AS val_loss, "
    "CAST(sum(batches) AS BIGINT) AS batches, count(*) AS ranks FROM val_rank",
    "batch_position_losses": f"WITH {_epochs('valid', q.VALIDATION_BATCHES)}, {_batches('epochs')}, {_VAL_PAIRS} "
    f'SELECT rank, batch_index, "row", pos, round(loss, {q.DIGITS}) AS loss FROM {_loss("val_pairs")}',
    "step_log_report": f"""WITH log AS (SELECT event_id // 8 AS step, value AS loss, ts AS t0,
        lead(ts) OVER (ORDER BY event_id) AS t1 FROM events),
    agg AS (SELECT step, avg(loss) AS loss, epoch_us(max(t1)) - epoch_us(min(t0)) AS micros FROM log GROUP BY step)
    SELECT step, round(loss, {q.DIGITS}) AS loss, round(micros / 1000.0, {q.DIGITS}) AS elapsed_ms,
        round({_N * 4 * 2 * 1e6} / nullif(micros, 0), {q.DIGITS}) AS tokens_per_sec FROM agg""",
}
