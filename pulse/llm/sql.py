"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from pulse.llm.chat import Template
from pulse.llm.license_texts import DIGESTS, TEXTS
from pulse.llm.licenses import COPYRIGHT_LINE, NOT_WORD, RESERVED_LINE, SPELLINGS

WORD = r"[^\x20\x09-\x0D]+"

MIX_SOURCES = rf"""
WITH sized AS (
  SELECT doc_id, source, source IS NULL AS missing, coalesce(source, '') AS name,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size
  FROM documents
), sources AS (
  SELECT missing, name, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY missing, encode(name)) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY missing, name
), ratios AS (
  SELECT *, source_size * 3 AS stop, CAST(source_size * 3 AS DOUBLE) / weight AS ratio FROM sources
), levels AS (
  SELECT *,
    CAST(sum(source_size) OVER () - coalesce(sum(stop) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM ratios
  WINDOW before AS (
    ORDER BY ratio, missing, encode(name) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT *, least(weight * first_value(CASE WHEN level <= ratio THEN level END IGNORE NULLS) OVER (
      ORDER BY ratio, missing, encode(name) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING
    ), CAST(stop AS DOUBLE)) AS target
  FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0 END AS rate,
    CAST('0x' || substr(md5('mix' || CASE WHEN s.missing THEN '1' ELSE '0' END || s.name), 1, 8)
      AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS shift,
    row_number() OVER (
      PARTITION BY s.missing, s.name
      ORDER BY s.size, substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 3), s.doc_id
    ) AS place
  FROM sized s JOIN targets t ON s.missing = t.missing AND s.name = t.name
)
SELECT doc_id, size, source_size, target,
  CAST(floor(place * rate + shift) - floor((place - 1) * rate + shift) AS BIGINT) * size AS taken
FROM placed
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

URL_FILTERS = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '{URL}', 2), '') AS path
  FROM pages
), fitting AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (
      PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC NULLS LAST
    ) AS place
  FROM parsed LEFT JOIN rules
    ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM fitting WHERE place = 1
"""


def license_scan() -> str:
    """The canonical form, step by step, and the known digests as values."""
    spelled = "plain"
    for other, chosen in SPELLINGS:
        spelled = f"regexp_replace({spelled}, '\\b{other}\\b', '{chosen}', 'g')"
    bodies = [(name, body) for name, _, body in TEXTS]
    bodies += [(name, f"{title}\n\n{body}") for name, title, body in TEXTS if title]
    bodies += [(name, f"The {title} ({name})\n\n{body}") for name, title, body in TEXTS if title]
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in bodies)
    longer = "".join(f" UNION ALL SELECT '{d}', '{name}'" for d, name in DIGESTS.items())

    def digest(text: str, rows: str, keep: str) -> str:
        lower = f"translate({text}, '{UPPER}', '{LOWER}')"
        lines = f"regexp_replace({lower}, '{COPYRIGHT_LINE}', '', 'g')"
        lines = f"regexp_replace({lines}, '{RESERVED_LINE}', '', 'g')"
        return (
            f"SELECT sha256({spelled}) AS digest, {keep} FROM (SELECT {keep}, "
            f"trim(regexp_replace({lines}, '{NOT_WORD}', ' ', 'g')) AS plain FROM {rows})"
        )

    return f"""
WITH bodies(license_id, body) AS (VALUES {values}),
listed AS ({digest("body", "bodies", "license_id")}{longer}),
known AS (SELECT digest, min(license_id) AS license_id FROM listed GROUP BY digest),
texts AS ({digest("coalesce(text, '')", "documents", "doc_id")})
SELECT doc_id, digest, license_id FROM texts LEFT JOIN known USING (digest)
"""


HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""


def chat_format() -> str:
    """Turns, replies and lengths from the table itself; the format adds marks and backslashes."""
    template = Template()
    plain = "coalesce(text, '')"
    body = f"regexp_replace(replace({plain}, '\\', '\\\\'), '{template.control_pattern}', '\\1\\\\\\2', 'g')"
    start, middle, end = template.other
    named = f"regexp_replace(replace(role, '\\', '\\\\'), '{template.control_pattern}', '\\1\\\\\\2', 'g')"
    marked = " ".join(
        f"WHEN role = '{role}' THEN '{before}' || body || '{after}'"
        for role, (before, after) in template.marks.items()
    )
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT conv_id, turn, role, {plain} AS said,
    CASE {marked} ELSE '{start}' || {named} || '{middle}' || body || '{end}' END AS piece
  FROM (SELECT *, {body} AS body FROM said)
), placed AS (
  SELECT *, sum(length(piece)) OVER upto AS chars,
    row_number() OVER upto = count(*) OVER (PARTITION BY conv_id) AS last
  FROM marked
  WINDOW upto AS (
    PARTITION BY conv_id ORDER BY turn NULLS LAST, role, piece
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn NULLS LAST, role, piece) AS turns,
    coalesce(string_agg(said, '' ORDER BY turn NULLS LAST, role, piece)
      FILTER (role = '{template.trained}'), '') AS loss,
    CAST(sum(chars + {len(template.begin)}) FILTER (last OR role = '{template.trained}') AS BIGINT)
      AS formatted_chars
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""


SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), used AS (
  SELECT d, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS c FROM used GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), vocabulary AS (
  SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY lang
), pairs AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT p.lang, p.source, k.term, k.c AS lang_c, coalesce(u.c, 0) AS c
  FROM pairs p JOIN kept k ON p.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM used GROUP BY lang, source, term) u
    ON u.lang = p.lang AND u.source = p.source AND u.term = k.term
), shares AS (
  SELECT c.lang, c.source, c.term, c.c,
    1 + (1000000000::HUGEINT * (c.c + 5)) // (sum(c.c) OVER (PARTITION BY c.lang, c.source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (c.lang_c + 5)) // (total + 5 * v) AS q
  FROM counts c JOIN vocabulary USING (lang)
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, encode(term)) AS INTEGER) AS rank
  FROM shares WHERE c > 0 AND p > q
), apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM pairs a JOIN pairs b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM every_pair
UNION ALL SELECT * FROM terms WHERE rank <= 50
"""

ORACLES = {
    "op1_mix_sources": MIX_SOURCES,
    "op2_url_filters": URL_FILTERS,
    "op5_licenses": license_scan(),
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_chat_format": chat_format(),
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
