"""DuckDB forms of the queries that SQL can express over whole tables."""

from __future__ import annotations

from lakegov.llm import quality_rules, source_mix

#: Document ids are unique in the given tables, so they alone rank the blocks. A
#: unit ends behind a line break or a mark and its blanks (chr(1) stands for the
#: cut); a block begins at every unit that is not empty and has 150 normalised characters or more.
LINE_DEDUP = r"""
WITH cut AS (SELECT doc_id, string_split(regexp_replace(COALESCE(text, ''), '([.!?][ \t]+|\n)', '\1' || chr(1), 'g'), chr(1)) AS a,
    length(COALESCE(text, '')) AS n_chars FROM documents),
unit AS (SELECT doc_id, n_chars, UNNEST(a) AS line, UNNEST(range(0, len(a))) AS no FROM cut),
placed AS (SELECT *, SUM(length(line)) OVER (PARTITION BY doc_id ORDER BY no) AS e,
    trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS norm FROM unit),
filled AS (SELECT *, e - length(line) AS s, SUM(length(norm)) OVER p AS c, row_number() OVER p AS k FROM placed WHERE norm <> ''
    WINDOW p AS (PARTITION BY doc_id ORDER BY no)),
listed AS (SELECT doc_id, list(norm ORDER BY k) AS norms FROM filled GROUP BY doc_id),
block AS (SELECT a.doc_id, a.no, a.s, z.e, md5(array_to_string(l.norms[a.k : z.k], chr(10))) AS h
    FROM filled a ASOF JOIN filled z ON a.doc_id = z.doc_id AND z.c >= a.c - length(a.norm) + 150 JOIN listed l ON l.doc_id = a.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, no) > 1 AS gone FROM block),
later AS (SELECT *, MAX(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ranked WHERE gone),
numbered AS (SELECT *, SUM(CASE WHEN before IS NULL OR before < s THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM later),
runs AS (SELECT doc_id, run, MIN(s) AS s, MAX(e) AS e FROM numbered GROUP BY doc_id, run),
total AS (SELECT doc_id, CAST(SUM(e - s) AS BIGINT) AS n_removed, COUNT(*) AS n_spans,
    string_agg(CAST(s AS VARCHAR) || '-' || CAST(e AS VARCHAR), ',' ORDER BY s) AS spans FROM runs GROUP BY doc_id)
SELECT c.doc_id, c.n_chars, len(c.a) AS n_units, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
    COALESCE(spans, '') AS spans
FROM cut c LEFT JOIN total l ON l.doc_id = c.doc_id"""
CHAT_FORMAT: str | None = None


def _quality_rules() -> str:
    q = quality_rules
    listed = ", ".join(f"'{s}'" for s in q.STRATA)
    share = q.ALPHA / len(q.RULES)
    level = q.DELTA / ((len(q.STRATA) + 1) * len(q.RULES))
    grid = ", ".join(f"('{r}', {i}, CAST({c!r} AS DOUBLE))" for r, (_, cuts) in q.RULES.items() for i, c in enumerate(cuts))
    scores = " UNION ALL ".join(f"SELECT doc_id, stratum, good, base_failed, '{r}' AS rule, CAST({e} AS DOUBLE) AS score FROM judged"
                                for r, (e, _) in q.RULES.items())
    return rf"""
WITH d AS (SELECT doc_id, lang, COALESCE(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
word AS (SELECT doc_id, UNNEST(ws) AS x, UNNEST(range(0, len(ws))) AS i FROM w),
gram AS (SELECT doc_id, i, x || ' ' || lead(x, 1) OVER p || ' ' || lead(x, 2) OVER p AS g FROM word
    WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS c FROM gram WHERE g IS NOT NULL),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM twice, range(0, 3) AS r(k) WHERE c > 1 GROUP BY doc_id),
fact AS (SELECT doc_id, CASE WHEN lang IN ({listed}) THEN lang ELSE 'other' END AS stratum, len(ws) AS n_words,
    length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[{q.SYMBOLS}]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, COALESCE(n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good FROM fact),
scored AS ({scores}),
grid(rule, step, cutoff) AS (VALUES {grid}),
cell AS (SELECT stratum, rule, step, cutoff, COUNT(*) AS n, COUNT(*) FILTER (WHERE score > cutoff) AS k
    FROM scored JOIN grid USING (rule) WHERE good AND NOT base_failed GROUP BY stratum, rule, step, cutoff),
tested AS (SELECT *, CASE WHEN k >= n * {share!r} THEN 1.0 ELSE (
    SELECT SUM(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({share!r}) + (n - j) * ln(1 - {share!r})))
    FROM range(0, 1000000) AS r(j) WHERE j <= k) END AS p FROM cell),
stop AS (SELECT stratum, rule, COALESCE(MIN(step) FILTER (WHERE p > {level!r}), 1000000) AS s FROM tested GROUP BY stratum, rule),
chosen AS (SELECT t.stratum, t.rule, MIN(cutoff) AS cutoff FROM tested t JOIN stop USING (stratum, rule) WHERE step < s
    GROUP BY t.stratum, t.rule),
over AS (SELECT DISTINCT doc_id FROM scored JOIN chosen USING (stratum, rule) WHERE score > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM over) AS kept FROM judged"""


QUALITY_RULES = _quality_rules()


def _source_mix() -> str:
    weights = source_mix.TARGET_WEIGHTS
    values = ", ".join(f"('{k}', CAST({w!r} AS DOUBLE))" for k, w in weights.items())
    named = ", ".join(f"'{k}'" for k in weights if k != source_mix.OTHER)
    seed = source_mix.SEED

    def unit(seed: str, *cols: str) -> str:
        drawn_by = "CAST(doc_id AS VARCHAR) || '/' || md5(COALESCE(text, '')) || '/'"
        parts = " || ':' || ".join([f"'{seed}'", drawn_by, *(f"CAST({c} AS VARCHAR)" for c in cols)])
        return f"CAST(CAST('0x' || substr(md5({parts}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"

    return f"""
WITH base AS (SELECT *, CASE WHEN source IN ({named}) THEN source ELSE '{source_mix.OTHER}' END AS s FROM documents),
weight(s, w) AS (VALUES {values}),
mass AS (SELECT s, CAST(SUM(COALESCE(LENGTH(text), 0)) AS DOUBLE) AS m FROM base GROUP BY s),
live AS (SELECT s, w, m FROM weight JOIN mass USING (s) WHERE m > 0),
rate AS (SELECT s, w / (SELECT SUM(w) FROM live) * (SELECT SUM(m) FROM mass) / m AS r FROM live),
step AS (SELECT s, k, SUM(exp(k * ln(r) - r - lgamma(k + 1.0))) OVER (PARTITION BY s ORDER BY k) AS f
         FROM rate, LATERAL (SELECT UNNEST(range(0, CAST(r + 12 * sqrt(r) + 40 AS BIGINT))) AS k)),
drawn AS (SELECT b.*, (SELECT COUNT(*) FROM step t WHERE t.s = b.s AND t.f <= b.u) AS n_copies
          FROM (SELECT *, {unit(seed)} AS u FROM base) b)
SELECT d.* EXCLUDE (s, u), c.copy_no, {unit(seed + '-order', 'c.copy_no')} AS mix_key
FROM drawn d, LATERAL (SELECT UNNEST(range(0, d.n_copies)) AS copy_no) c"""


SOURCE_MIX = _source_mix()


#: crc32 of the decimal id byte by byte (reflected polynomial 0xEDB88320); node
#: keys are the lists of turn digests, a node's ancestors are its own smallest member's prefixes.
CONVERSATION_TRIE = r"""
WITH RECURSIVE step(i, n, v) AS (SELECT i, 0, i::UBIGINT FROM range(0, 256) AS g(i)
    UNION ALL SELECT i, n + 1, xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END) FROM step WHERE n < 8),
tab AS (SELECT i, v FROM step WHERE n = 8),
ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS t FROM conversations WHERE conv_id IS NOT NULL),
crc(c, t, place, v) AS (SELECT c, t, 1, 4294967295::UBIGINT FROM ids
    UNION ALL SELECT c, t, place + 1, xor(crc.v >> 8, tab.v) FROM crc JOIN tab ON tab.i = xor(crc.v & 255, ascii(substr(t, place, 1))::UBIGINT)
    WHERE place <= length(t)),
h AS (SELECT c, CAST(xor(v, 4294967295::UBIGINT) % 6 AS BIGINT) AS h FROM crc WHERE place = length(t) + 1),
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lent AS (SELECT h.c, o.pos AS place, o.role, o.text FROM h JOIN own o ON o.c = h.c - h.c % 100 AND o.pos <= h.h
    UNION ALL SELECT o.c, o.pos + 10, o.role, o.text FROM own o JOIN h ON h.c = o.c AND o.pos > h.h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY place) AS d, md5(length(role) || ':' || role || text) AS m, length(text) AS n FROM lent),
pre AS (SELECT c, d, n, list(m) OVER (PARTITION BY c ORDER BY d) AS k FROM turns
    UNION ALL SELECT c, 0, 0, [] FROM ids),
named AS (SELECT *, MIN(c) OVER (PARTITION BY d, k) AS node, MAX(d) OVER (PARTITION BY c) AS len FROM pre),
kept AS (SELECT node, d, COUNT(*) AS n_convs, MAX(n) AS n, MAX(k) AS k,
    sha256(COALESCE(string_agg(CASE WHEN d = len THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends FROM named GROUP BY node, d),
up AS (SELECT k.*, p.node AS parent FROM kept k LEFT JOIN named p ON p.c = k.node AND p.d = k.d - 1),
kids AS (SELECT parent, d - 1 AS d, COUNT(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL),
all_up AS (SELECT a.node AS node, a.d AS d, COUNT(*) FILTER (WHERE kids.n_children IS NULL) AS n_leaves,
    SUM((u.n_convs - 1) * u.n) AS saved
    FROM up u JOIN named a ON a.c = u.node AND a.d <= u.d LEFT JOIN kids ON kids.parent = u.node AND kids.d = u.d GROUP BY a.node, a.d)
SELECT u.node AS conv_id, u.d AS depth, u.parent AS parent_conv_id, u.n_convs, COALESCE(kids.n_children, 0) AS n_children,
    a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, u.ends AS ends_sha256
FROM up u JOIN all_up a ON a.node = u.node AND a.d = u.d LEFT JOIN kids ON kids.parent = u.node AND kids.d = u.d"""
