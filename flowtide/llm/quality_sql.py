"""The quality rules as SQL, for the check of ``op6_quality_rules``."""

from flowtide.llm.quality import (CLOSERS, LATIN_CLOSERS, LATIN_ENDERS, MAX_LOST, MAX_REPEAT, MIN_WORDS, OTHER_ENDERS,
                                  PHRASE_WORDS, PHRASES, SEPARATORS, SYMBOLS)

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_q = lambda x: "'" + x.replace("'", "''") + "'"

_class = lambda x: "[" + x.replace("]", r"\]") + "]"
_SPACES = r"[ \t\r\x0b\x0c]"
_ENDED = f"[{LATIN_ENDERS}{OTHER_ENDERS}]{_class(CLOSERS)}*{_SPACES}*$"
_FINISHED = rf"[\p{{L}}\p{{N}}][{LATIN_ENDERS}]+{_class(LATIN_CLOSERS)}*{_SPACES}|[{OTHER_ENDERS}]"
# Every character that parts words is doubled, so that each phrase has a border of its own on both sides.
_BORDER = r"[^\p{L}\p{N}_]"
_PHRASE = f"{_BORDER}(?:{'|'.join(p.replace(' ', '  ') for p in PHRASES)})s?{_BORDER}"

QUALITY_SQL = rf"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS w FROM numbered),
tokens AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
grams AS (
  SELECT r, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3,
         lead(word, 3) OVER o AS w4, lead(word, 4) OVER o AS w5
  FROM tokens WINDOW o AS (PARTITION BY r ORDER BY i)),
repeated AS (
  SELECT r, i FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3, w4, w5) AS n FROM grams WHERE w5 IS NOT NULL)
  WHERE n >= 2),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(5) t(k) GROUP BY r),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM numbered),
judged AS (
  SELECT r, line, i, len(regexp_extract_all(line, '{_WORD}')) AS n,
         (NOT regexp_matches(line, {_q(_ENDED)})
          AND (len(regexp_extract_all(line, '{_WORD}')) < {MIN_WORDS} OR NOT regexp_matches(line, {_q(_FINISHED)})))
         OR len(regexp_extract_all(line, '{_WORD}')) <= {PHRASE_WORDS} * len(regexp_extract_all(
              regexp_replace(' ' || translate(line, '{_UPPER}', '{_LOWER}') || ' ', {_q(f"({_BORDER})")}, '\1\1', 'g'),
              {_q(_PHRASE)}))
         OR 10 * len(regexp_extract_all(line, '[{SYMBOLS}]')) > 3 * len(regexp_extract_all(line, '{_WORD}'))
         OR 5 * len(list_filter(regexp_extract_all(line, '{_WORD}'),
                    lambda x: list_contains([{", ".join(map(_q, SEPARATORS))}], x)))
            >= len(regexp_extract_all(line, '{_WORD}')) AS bad,
         row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth
  FROM lines),
per_doc AS (
  SELECT r, count(*) FILTER (n > 0 AND nth > 1) AS dup, count(*) FILTER (n > 0 AND bad) AS failed,
         coalesce(sum(n) FILTER (bad), 0) AS lost
  FROM judged GROUP BY r),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[{SYMBOLS}]')) AS n_symbols, dup, failed, lost, coalesce(hit.n, 0) AS rep
  FROM words JOIN per_doc USING (r) LEFT JOIN hit USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       dup::BIGINT AS n_dup_lines, rep::BIGINT AS n_repeat_words, failed::BIGINT AS n_failed_lines,
       lost::BIGINT AS n_lost_words,
       n_words < {MIN_WORDS} OR 100 * rep > {MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * rep > {MAX_REPEAT} * n_words)
         AND 100 * lost <= {MAX_LOST} * n_words AS kept
FROM measured
"""
