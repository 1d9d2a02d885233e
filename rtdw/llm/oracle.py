"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

STOP = ", ".join(f"'{w}'" for w in (
    "the of and to in a is that it for on was be as with by at from this are or an not "
    "le la les de des du et un une que qui en est pour par dans pas sur "
    "der die das und zu den von mit für auf ist im nicht ein eine als dem "
    "el los las del y se por con para no su al lo").split())

# Documents that share an id keep separate row numbers.
OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
pos AS (SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i+4], ' ')) AS n FROM pos),
gaps AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS g FROM win WHERE n > 1),
rep AS (SELECT r, sum(g)::BIGINT AS n_repeat FROM gaps GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(DISTINCT l) AS n_distinct
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{WORD}') GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_lines - n_distinct, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines,
             len(list_filter(ws, lambda x: x IN ({STOP}))) AS n_stop,
             length(t) - length(replace(t, '!', '')) AS n_excl,
             length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper
      FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
         AND word_chars / n_words BETWEEN 2.0 AND 15.0
         AND n_symbols / n_words <= 0.3
         AND n_excl / n_words <= 0.5
         AND (n_words < 50 OR n_stop / n_words >= 0.01)
         AND (n_words < 20 OR n_upper / word_chars <= 0.5)
         AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
FROM v
"""


def draw(*key: str) -> str:
    """SQL of the uniform draw: 52 bits of the MD5 of the key's parts."""
    text = "concat_ws('|', " + ", ".join(f"coalesce(({k})::VARCHAR, '')" for k in key) + ")"
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def _closer(k: int, table: str) -> str:
    """Turn the one document per source that brings its words nearest the target."""
    return f"""
g{k} AS (SELECT source, any_value(target) - sum((whole + more::INT) * size) AS gap FROM {table} GROUP BY source),
h{k} AS (SELECT t.source, doc_id, digest, occurrence, row_number() OVER (
             PARTITION BY t.source ORDER BY abs(gap + CASE WHEN more THEN size ELSE -size END), rank, doc_id, digest, occurrence) AS rn
         FROM {table} t JOIN g{k} g ON t.source IS NOT DISTINCT FROM g.source
         WHERE rank IS NOT NULL AND abs(gap + CASE WHEN more THEN size ELSE -size END) < abs(gap)),
c{k} AS (SELECT t.* EXCLUDE (more), more <> (h.rn IS NOT NULL) AS more
         FROM {table} t LEFT JOIN h{k} h ON h.rn = 1 AND t.source IS NOT DISTINCT FROM h.source
              AND t.doc_id IS NOT DISTINCT FROM h.doc_id AND t.digest = h.digest AND t.occurrence = h.occurrence)"""


def _ctes_mixing(table: str) -> str:
    """CTEs m0..m9; the last has rows (doc_id, source, digest, occurrence, size,
    source_size, target, copies)."""
    return rf"""
m0 AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
              len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM {table}),
m1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, digest, source) AS occurrence FROM m0),
m2 AS (SELECT source, sum(size)::BIGINT AS words,
              [1.0, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
       FROM m1 GROUP BY source),
m3 AS (SELECT *, 3.0 * words AS cap,
              coalesce(sum(3.0 * words) OVER need, 0) AS cap_before, coalesce(sum(weight) OVER need, 0) AS weight_before,
              sum(words) OVER () AS all_words, sum(weight) OVER () AS all_weight
       FROM m2 WINDOW need AS (ORDER BY 3.0 * words / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m3b AS (SELECT *, (all_words - cap_before)::DOUBLE / (all_weight - weight_before) AS level FROM m3),
lvl AS (SELECT arg_min(level, cap_before) AS level FROM m3b WHERE cap >= level * weight),
m4 AS (SELECT source, words, least(cap::DOUBLE, weight * coalesce((SELECT level FROM lvl), 0)) AS target FROM m3b),
f1 AS (SELECT m1.source, size, count(*) AS docs, any_value(target) AS target
       FROM m1 JOIN m4 ON m1.source IS NOT DISTINCT FROM m4.source WHERE size > 0 GROUP BY 1, 2),
f2 AS (SELECT *, (target - coalesce(sum(docs * size * 3.0) OVER (PARTITION BY source ORDER BY size DESC
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(docs * size * sqrt(size)) OVER (PARTITION BY source ORDER BY size DESC
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS k FROM f1),
f3 AS (SELECT source, arg_max(k, size) AS k FROM f2 WHERE k * sqrt(size) <= 3.0 GROUP BY source),
m5 AS (SELECT m1.*, words, target,
              CASE WHEN size = 0 THEN 0.0 WHEN k IS NULL THEN 3.0 ELSE least(3.0, k * sqrt(size)) END AS expected
       FROM m1 JOIN m4 ON m1.source IS NOT DISTINCT FROM m4.source LEFT JOIN f3 ON m1.source IS NOT DISTINCT FROM f3.source),
m6 AS (SELECT *, floor(expected) AS whole, expected - floor(expected) AS p,
              {draw('doc_id', 'digest', 'occurrence')} AS u FROM m5),
m7 AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM m6),
m7b AS (SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS room,
               sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, digest, occurrence
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM m7),
m8 AS (SELECT *, rank IS NOT NULL AND upto <= room AS more FROM m7b),
{_closer(1, 'm8')},
{_closer(2, 'c1')},
m9 AS (SELECT doc_id, source, digest, occurrence, size, words AS source_size, target,
              (whole + more::INT)::BIGINT AS copies FROM c2)"""


OP3 = f"""WITH {_ctes_mixing('documents')}
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken FROM m9"""


# words hold no blanks, so a phrase is known by its words joined by one space
COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1),
             lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND a >= 30),
inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most
           FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i
                 FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase)
         WHERE 100::HUGEINT * coalesce(most, 0) < 80::HUGEINT * a),
cuts AS (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM kept),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, cuts.j, x.a AS l, y.a AS r,
                  (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:j], ' ')
                     JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[j + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best JOIN n USING (lang) QUALIFY rank <= 2000
"""

LLM_ORACLE = {
    "op12_collocations": COLLOCATIONS,
    "op3_mixing": OP3,
    "op10_quality_rules": OP10,
}
