"""DuckDB SQL for the operators that SQL can express, stated from the contracts."""

from __future__ import annotations

from claimsieve.llm.importance_resampling import BUCKETS, LEAST_WORDS, PERCENT, SEED
from claimsieve.llm.quality_rules import STOP_WORDS, THRESHOLDS
from claimsieve.llm.secret_scan import RULES

BLANK_CLASS = r"\x20\x09-\x0D"
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"


def _verdict() -> str:
    tests = [f"{t.measure} >= {t.least}" for t in THRESHOLDS if t.least is not None]
    tests += [f"{t.measure} <= {t.most}" for t in THRESHOLDS if t.most is not None]
    return " AND ".join(tests)


def quality_rules_sql() -> str:
    stop = ", ".join(f"'{word}'" for word in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents
), cut AS (
  SELECT *, regexp_extract_all(body, '[^{BLANK_CLASS}]+') AS words,
    list_filter(string_split(body, chr(10)), lambda line: regexp_matches(line, '[^{BLANK_CLASS}]')) AS lines
  FROM texts
), starts AS (
  SELECT row_no, words, unnest(range(1, len(words) - 1)) AS spot FROM cut WHERE len(words) >= 3
), windows AS (
  SELECT row_no, spot, words[spot:spot + 2] AS three FROM starts
), twice AS (
  SELECT row_no, spot FROM windows QUALIFY count(*) OVER (PARTITION BY row_no, three) > 1
), covered AS (
  SELECT row_no, count(DISTINCT spot + step) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS step) GROUP BY row_no
), counted AS (
  SELECT doc_id, words, lines, len(words)::BIGINT AS n_words,
    length(regexp_replace(body, '[{BLANK_CLASS}]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (row_no)
), measured AS (
  SELECT *,
    coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
    coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
    coalesce(len(list_filter(words, lambda w: lower(rtrim(w, '.,;:!?')) IN ({stop}))) / nullif(n_words, 0), 0)
      AS stop_word_share,
    coalesce(n_dup_lines / nullif(len(lines), 0), 0) AS dup_line_share,
    coalesce(len(list_filter(lines, lambda l: regexp_matches(l, '^[ \t]*[-*•]'))) / nullif(len(lines), 0), 0)
      AS bullet_line_share,
    coalesce(len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[ \t]*\z'))) / nullif(len(lines), 0), 0)
      AS ellipsis_line_share,
    coalesce(len(list_filter(words, lambda w: NOT regexp_matches(w, '[a-z]') AND regexp_matches(w, '[A-Z].*[A-Z]')))
      / nullif(n_words, 0), 0) AS shouting_share,
    coalesce(len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) / nullif(n_words, 0), 0)
      AS alphabetic_word_share
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_verdict()}) AS kept
FROM measured
"""


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digested AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), latest AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS kept
  FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN coalesce(page_id, kept - 1) < kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN coalesce(page_id, kept - 1) < kept THEN kept END AS refers_to
FROM latest
"""


def secrets_sql() -> str:
    def found(rank: int, rule) -> str:
        pattern = rule.pattern.replace("'", "''")
        return f"""
  SELECT row_no, {rank} AS rank, '{rule.kind}' AS kind, {rule.base} AS base, gap, hit, tested, place
  FROM (
    SELECT row_no, unnest(gaps) AS gap, unnest(hits) AS hit, unnest(tests) AS tested, unnest(range(len(gaps))) AS place
    FROM (
      SELECT row_no, string_split_regex(body, '{pattern}') AS gaps, regexp_extract_all(body, '{pattern}', 0) AS hits,
        list_transform(regexp_extract_all(body, '{pattern}', {rule.group}), lambda t: length(t) >= {rule.least}) AS tests
      FROM texts
    )
  )"""

    kinds = " UNION ALL ".join(found(rank, rule) for rank, rule in enumerate(RULES))
    counts = ",\n  ".join(
        f"count(*) FILTER (kind = '{rule.kind}')::BIGINT AS n_{rule.kind}" for rule in RULES if rule.base
    )
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents
), cut AS ({kinds}
), ended AS (
  SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY row_no, rank ORDER BY place) AS finish FROM cut
), spans AS (
  SELECT row_no, rank, kind, base, finish - length(hit) AS start,
    kind || ':' || (finish - length(hit)) || ':' || finish AS span
  FROM ended WHERE tested
)
SELECT doc_id,
  {counts},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM texts LEFT JOIN spans USING (row_no)
GROUP BY row_no, doc_id
"""

# crc32 of text: `crc_table` holds the 256 steps of the reflected polynomial, a text goes through it byte by byte
CRC_TABLE = """
crc_table AS (
  SELECT list(step ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _:
      CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS step
    FROM range(256) t(i))
)"""


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of the UTF-8 bytes of `text`, where `steps` of `crc_table` is in reach."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    numbers = f"list_transform(range(strlen({text})), lambda k: {byte})"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {numbers}),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"""


def resampling_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(table: str) -> str:
        cut = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD_CLASS}+')"
        return f"SELECT row_number() OVER () AS row_no, *, {cut} AS words FROM {table}"

    return f"""
WITH {CRC_TABLE}, docs AS ({words("documents")}), goal AS ({words("benchmark")}),
raw_words AS (SELECT row_no, unnest(words) AS word FROM docs),
goal_words AS (SELECT unnest(words) AS word FROM goal),
known AS (SELECT DISTINCT word FROM (SELECT word FROM raw_words UNION ALL SELECT word FROM goal_words)),
bucketed AS (SELECT word, {_crc32("word")} % {BUCKETS} AS bucket FROM known, crc_table),
raw_counts AS (SELECT bucket, count(*) AS s FROM raw_words JOIN bucketed USING (word) GROUP BY bucket),
goal_counts AS (SELECT bucket, count(*) AS t FROM goal_words JOIN bucketed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM raw_words) AS raw_total, (SELECT count(*) FROM goal_words) AS goal_total),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (raw_total + {BUCKETS}))
    / ((s + 1)::DOUBLE * (goal_total + {BUCKETS}))))::BIGINT AS gain
  FROM raw_counts LEFT JOIN goal_counts USING (bucket), totals
), weights AS (
  SELECT row_no, sum(gain) AS total, count(*) AS n
  FROM raw_words JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY row_no
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features,
    coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
    ('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM docs LEFT JOIN weights USING (row_no)
), noisy AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM noisy WHERE n_features >= {LEAST_WORDS}
)
SELECT noisy.doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * able // 100 THEN place END AS rank
FROM noisy LEFT JOIN placed USING (doc_id)
"""
