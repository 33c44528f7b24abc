"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from functools import reduce

from tallyshelf.llm.licenses import COPYRIGHT_LINE, KNOWN, NO_WORD, RUN_WORDS, SPELLINGS, full_texts

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS digest
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l
), b AS (
  SELECT source, length(bin(size)) AS digits, sum(size)::BIGINT AS words FROM d GROUP BY ALL
), r AS (
  SELECT b.*, source_size, target, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS base
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source
), o AS (
  SELECT *, target - base * source_size AS to_draw FROM r
), v AS (
  SELECT *, sum(words * digits) OVER (PARTITION BY source) - coalesce(sum(words * digits) OVER o, 0) AS rest,
         to_draw - coalesce(sum(words) OVER o, 0) AS remaining
  FROM o WINDOW o AS (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), x AS (
  SELECT *, coalesce(max(CASE WHEN rest > 0 THEN remaining / rest END) OVER (PARTITION BY source), 0) * digits AS raw FROM v
), p AS (
  SELECT *, CASE WHEN raw >= 1 THEN base + 1 ELSE base END AS whole, CASE WHEN raw >= 1 THEN 0 ELSE raw END AS p,
         to_draw - sum(CASE WHEN raw >= 1 THEN words ELSE 0 END) OVER (PARTITION BY source) AS open
  FROM x
), u AS (
  SELECT d.doc_id, d.source, d.size, p.source_size, p.target, p.whole, p.p, p.open,
         (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || d.size || ':' || d.digest), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND length(bin(d.size)) = p.digits
), q AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM u
), k AS (
  SELECT *, CASE WHEN q IS NOT NULL THEN q / (1 + q) END AS rank FROM q
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM k WHERE rank IS NOT NULL
  UNION ALL SELECT *, 0 FROM k WHERE rank IS NULL
)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN rank IS NOT NULL AND 2 * (through - size) + size <= 2 * open THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c
"""

QUALITY = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), d AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t
), b AS (
  SELECT doc_id, text, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM d
), g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, n_words - 6)) AS i FROM b WHERE n_words >= 8)
), c AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM c, range(8) AS x(k) GROUP BY doc_id
), f AS (
  SELECT b.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
  FROM b LEFT JOIN r ON b.doc_id IS NOT DISTINCT FROM r.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 10 * n_symbols > n_words
         OR 100 * n_dup_lines > 50 * n_lines
         OR 100 * len(regexp_extract_all(text, '\p{L}')) < 60 * word_chars
         OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > word_chars
         OR 100 * len(regexp_extract_all(text, '\p{Nd}')) > 20 * word_chars
         OR 100 * len(regexp_extract_all(text, '(?m)(\.\.\.|…)$')) > 30 * n_lines
         OR 100 * len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) > 30 * n_words
         OR 100 * len(regexp_extract_all(text, '(?m)^[ \t]*[-*•]')) > 90 * n_lines) AS kept
FROM f
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), r AS (
  SELECT doc_id, doc_id AS root FROM n UNION SELECT b, root FROM r JOIN l ON a = r.doc_id
), m AS (
  SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
         CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS head
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM d
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM t
), f AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>') + length(replace(replace(replace(role, '\', '\'), '<|', '<\|'), chr(10), '<\/')) + 1
             + length(replace(replace(text, '\', '\'), '<|', '<\|')) + length('<|im_end|>') + 1) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM f
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """The canonical form, word by word."""
    line = COPYRIGHT_LINE.replace("(?imd)", "(?im)")
    words = f"regexp_replace(lower(regexp_replace({text}, {_quoted(line)}, '', 'g')), {_quoted(NO_WORD)}, '  ', 'g')"
    spaced = [tuple(f" {x} ".replace(" ", "  ")[1:-1] for x in pair) for pair in SPELLINGS]
    form = reduce(lambda f, pair: f"replace({f}, {_quoted(pair[0])}, {_quoted(pair[1])})", spaced, f"' ' || trim({words}) || ' '")
    return f"trim(replace({form}, '  ', ' '))"


_FIRSTS = ", ".join(_quoted(w) for w in sorted({spelled.split()[0] for spelled, _ in SPELLINGS}))
_LINES = f"len(list_filter(string_split(text, chr(10)), lambda x: {_canonical('x')} <> ''))"
LICENSES = f"""
WITH t AS (
  SELECT license_id, text, {_canonical("text")} AS form
  FROM (VALUES {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in (*KNOWN, *full_texts()))}) AS v(license_id, text)
), k AS (
  SELECT DISTINCT license_id, form FROM t
), m AS (
  SELECT DISTINCT license_id, form, split_part(form, ' ', 1) AS first FROM t
  WHERE len(string_split(form, ' ')) >= {RUN_WORDS} OR {_LINES} > 1
), d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), s AS (
  SELECT row, doc_id, unnest(range(1, len(lines) + 1)) AS place, unnest(lines) AS line FROM d
), c AS (
  SELECT row, doc_id, place FROM (SELECT *, split_part({_canonical("line")}, ' ', 1) AS first FROM s)
  WHERE first IN (SELECT first FROM m) OR first IN ({_FIRSTS})
), r AS (
  SELECT row, c.doc_id, place, {_canonical("array_to_string(lines[place:], chr(10))")} AS form FROM c JOIN d USING (row)
), u AS (
  SELECT doc_id, 'text' AS unit, coalesce(text, '') AS body FROM documents
  UNION ALL SELECT doc_id, 'line', unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
), f AS (
  SELECT doc_id, unit, {_canonical("body")} AS form FROM u
), e AS (
  SELECT doc_id, unit, license_id FROM f JOIN k USING (form) WHERE form <> ''
  UNION ALL
  SELECT doc_id, 'lines', license_id
  FROM (SELECT DISTINCT row, r.doc_id, place, license_id FROM r JOIN m ON split_part(r.form, ' ', 1) = first AND starts_with(r.form || ' ', m.form || ' '))
)
SELECT doc_id, unit, license_id, count(*) AS n_found FROM e GROUP BY ALL
"""

SQL: dict[str, str] = {
    "op2_quality": QUALITY,
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op6_warc": WARC,
    "op7_licenses": LICENSES,
    "op8_chat": CHAT,
    "op10_mixing": MIXING,
}
