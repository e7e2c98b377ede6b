"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from coppice.llm.quality import BULLETS, ELLIPSES, RULES, STOP_WORDS

_WORDS = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5,
    len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::HUGEINT AS w,
    3 * source_size::HUGEINT AS cap, (SELECT sum(source_size) FROM sources) AS total
  FROM sources
), levels AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM weighed
), capped AS (SELECT *, w * (total - used) > cap * open AS is_full FROM levels),
rest AS (
  SELECT any_value(total) - coalesce(sum(cap) FILTER (is_full), 0) AS words,
    coalesce(sum(w) FILTER (NOT is_full), 0) AS weight FROM capped
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN cap::DOUBLE ELSE (w * words)::DOUBLE / weight::DOUBLE END AS target
  FROM capped, rest
), rates AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
    ('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '') || '|' || text_md5), 1, 8))::BIGINT::DOUBLE
      / 4294967296.0 AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) AS taken
FROM rates
"""


def _tests() -> str:
    """The threshold table as SQL."""
    out = []
    for r in RULES:
        if r.at_least is not None:
            out.append(f"{r.measure} >= {r.at_least}::DOUBLE * {r.per}")
        if r.at_most is not None:
            out.append(f"{r.measure} <= {r.at_most}::DOUBLE * {r.per}")
    return " AND ".join(out)


def _marked(test: str, marks: tuple[str, ...]) -> str:
    return " OR ".join(f"{test}(trim(x, ' '), '{m}')" for m in marks)


QUALITY = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_WORDS}') AS words,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{_WORDS}')] AS lines
  FROM base
), placed AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM parts
), windows AS (
  SELECT r, i, w, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM placed
  WINDOW p AS (PARTITION BY r ORDER BY i)
), counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL
), repeats AS (
  SELECT r, count(DISTINCT i + d) AS n_repeat_words
  FROM counted, (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY r
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len([x FOR x IN lines IF {_marked("starts_with", BULLETS)}]) AS n_bullet_lines,
    len([x FOR x IN lines IF {_marked("ends_with", ELLIPSES)}]) AS n_ellipsis_lines,
    len([x FOR x IN words IF lower(x) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})])
      AS n_stop_words,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_tests()} AS kept
FROM judged
"""

EXACT_DEDUP = rf"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g') AS text FROM documents
), grouped AS (
  SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS keep_id,
    count(*) OVER (PARTITION BY text) AS group_size
  FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
  sha256(text) AS text_sha256
FROM grouped
"""

PREFERENCE = """
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text)::INTEGER AS part
  FROM (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
  )
), openings AS (
  SELECT conv_id, role, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, part) AS k
    FROM turns
  ) WHERE k = 1
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY role, text ORDER BY conv_id) - 1 AS k FROM openings
), pairs AS (
  SELECT a.conv_id AS chosen_id, b.conv_id AS rejected_id
  FROM numbered a JOIN numbered b ON a.role = b.role AND a.text = b.text AND b.k = a.k + 1
  WHERE a.k % 2 = 0
), replies AS (
  SELECT conv_id, turn, part, text FROM turns
  WHERE role = 'assistant'
    AND conv_id NOT IN (SELECT chosen_id FROM pairs UNION ALL SELECT rejected_id FROM pairs)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, part DESC) = 1
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY conv_id) AS r, count(*) OVER () AS n FROM replies
), derived AS (
  SELECT a.conv_id, a.turn AS last_turn, a.part AS last_part, b.conv_id AS rejected_id, b.text AS reply
  FROM ordered a JOIN ordered b ON b.r = CASE WHEN a.r < a.n THEN a.r + 1 ELSE a.n - 1 END
), before AS (
  SELECT conv_id AS chosen_id, rejected_id, turn, part, role, text,
    turn IS NOT DISTINCT FROM last_turn AND part = last_part AS is_last
  FROM derived JOIN turns USING (conv_id)
  WHERE (coalesce(turn, -9223372036854775808), part)
    <= (coalesce(last_turn, -9223372036854775808), last_part)
), placed AS (
  SELECT chosen_id AS pair_id, * FROM (
    SELECT chosen_id, rejected_id, 'chosen' AS side, turn, part, role, text
    FROM pairs JOIN turns ON conv_id = chosen_id
    UNION ALL
    SELECT chosen_id, rejected_id, 'rejected', turn, part, role, text
    FROM pairs JOIN turns ON conv_id = rejected_id
    UNION ALL SELECT chosen_id, rejected_id, 'chosen', turn, part, role, text FROM before
    UNION ALL SELECT chosen_id, rejected_id, 'rejected', turn, part, role, text FROM before WHERE NOT is_last
    UNION ALL SELECT conv_id, rejected_id, 'rejected', last_turn, last_part, 'assistant', reply FROM derived
  )
), forks AS (
  SELECT pair_id, min((coalesce(turn, -9223372036854775808), part)) AS fork FROM (
    SELECT pair_id, turn, part FROM placed GROUP BY ALL
    HAVING count(*) < 2 OR count(DISTINCT (role, text)) > 1
  ) GROUP BY pair_id
), judged AS (
  SELECT *, fork IS NULL OR (coalesce(turn, -9223372036854775808), part) < fork AS common
  FROM placed LEFT JOIN forks USING (pair_id)
)
SELECT pair_id, chosen_id, rejected_id, CASE WHEN common THEN 'prompt' ELSE side END AS segment,
  turn, part, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered,
  NOT common AND role = 'assistant' AS loss
FROM judged WHERE NOT common OR side = 'chosen'
"""

TOP_PRODUCTS = """
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS r, [floor(64 * x::DOUBLE) FOR x IN embedding] AS code
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.code, c.code)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.r <> c.r WHERE q.vec_id % 20 = 0
)
SELECT query_id, vec_id, score,
  (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank
FROM scored QUALIFY rank <= 20
"""

ORACLES: dict[str, str] = {
    "op4_mixing": MIXING,
    "op5_preference": PREFERENCE,
    "op6_quality_rules": QUALITY,
    "op7_exact_dedup": EXACT_DEDUP,
    "op11_exact_topk": TOP_PRODUCTS,
}
