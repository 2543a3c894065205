"""Results of the operators that SQL can express, as SQL for DuckDB.

The other operators learn, draw or shuffle; their queries are tested against brute force,
exact round trips and held-out accuracy in tests/llm.
"""

from __future__ import annotations

from tillhouse.llm.host_rules import (
    DEVIATIONS,
    LEAST_FAILING,
    LEAST_WORDS,
    MOST_DUPLICATE_LINES,
    MOST_REPEATED_PERCENT,
    MOST_SYMBOLS_PER_WORD,
    WORD_LENGTHS,
)

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
    array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS phrase
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i)
  WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT r, size, i, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM docs, sizes, LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS i)),
found AS (SELECT r, i, p.size, item FROM places AS p JOIN windows AS w
  ON p.size = w.size AND p.phrase = w.phrase),
hits AS (
  SELECT r, count(DISTINCT spot) AS n_hit
  FROM (SELECT DISTINCT r, i, size FROM found), LATERAL (SELECT unnest(range(i, i + size)) AS spot)
  GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(coalesce(len(words), 0) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""

RULES = ("short", "repeated", "symbols", "dup_lines", "lengths")


def _prior(rule: str) -> str:
    """Mean and strength of a rule's beta prior, from one row of sums over the hosts."""
    mean = f"(sum({rule}) / sum(n))"
    between = (
        f"(sum({rule} * {rule} / n) - sum(n) * {mean} * {mean} - "
        f"(count(*) - 1) * {mean} * (1 - {mean})) / nullif(sum(n) - sum(n * n) / sum(n), 0)"
    )
    return (
        f"{mean} AS m_{rule}, greatest({mean} * (1 - {mean}) / "
        f"greatest(coalesce({between}, 0), 1e-6) - 1, 1) AS s_{rule}"
    )


OP3 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
places AS (
  SELECT r, i, words[i : i + 2] AS three
  FROM docs, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)),
twice AS (SELECT r, i FROM places
  QUALIFY count(*) OVER (PARTITION BY r, three) > 1),
covered AS (
  SELECT r, count(DISTINCT spot) AS n_repeat_words
  FROM twice, LATERAL (SELECT unnest(range(i, i + 3)) AS spot) GROUP BY r),
figures AS (
  SELECT docs.r, doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
flags AS (
  SELECT *, n_words < {LEAST_WORDS} AS short,
    100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS repeated,
    n_symbols > {MOST_SYMBOLS_PER_WORD}::DOUBLE * n_words AS symbols,
    n_dup_lines > {MOST_DUPLICATE_LINES}::DOUBLE * n_lines AS dup_lines,
    coalesce(word_chars / nullif(n_words, 0) NOT BETWEEN {WORD_LENGTHS[0]} AND {WORD_LENGTHS[1]},
      TRUE) AS lengths
  FROM figures),
hosts AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n,
    {", ".join(f"CAST(count(*) FILTER ({rule}) AS DOUBLE) AS {rule}" for rule in RULES)}
  FROM flags GROUP BY host),
priors AS (SELECT {", ".join(map(_prior, RULES))} FROM hosts),
verdicts AS (
  SELECT host, {" OR ".join(
    f"({r} + m_{r} * s_{r}) / (n + s_{r}) > greatest({LEAST_FAILING}, "
    f"m_{r} + {DEVIATIONS} * sqrt(m_{r} * (1 - m_{r}) / (s_{r} + 1)))" for r in RULES)} AS rejected
  FROM hosts, priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeated AS base_failed, NOT (short OR repeated) AND NOT rejected AS kept
FROM flags JOIN verdicts ON flags.host IS NOT DISTINCT FROM verdicts.host"""

ORACLES: dict[str, str] = {"op2_decontamination": OP2, "op3_host_rules": OP3}
