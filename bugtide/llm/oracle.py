"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from bugtide.llm.licenses import NOTICES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = "list_filter(regexp_split_to_array(lower({}), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
_SHINGLES = "list_distinct([list_aggregate(w[i:i + 4], 'string_agg', ' ') for i in range(1, len(w) - 3)])"

LICENSES = f"""
WITH notice(license, notice) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in NOTICES.items())}),
template AS (
  SELECT license, unnest(s) AS shingle, len(s) AS n_template
  FROM (SELECT license, {_SHINGLES} AS s FROM (SELECT license, {_WORDS.format("notice")} AS w FROM notice))
),
shingles AS (
  SELECT n, doc_id, unnest({_SHINGLES}) AS shingle
  FROM (SELECT row_number() OVER () AS n, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents)
),
hits AS (
  SELECT n, any_value(doc_id) AS doc_id, license, count(*) AS n_shared, any_value(n_template) AS n_template,
         count(*) / any_value(n_template)::DOUBLE AS containment, list(shingle) AS shared
  FROM shingles JOIN template USING (shingle)
  GROUP BY n, license
  HAVING count(*) / any_value(n_template)::DOUBLE >= 0.8
),
whole AS (SELECT license AS other, list(shingle) AS other_shingles FROM template GROUP BY license)
SELECT doc_id, license, n_shared, n_template, containment FROM hits AS h
WHERE NOT EXISTS (
  SELECT 1 FROM hits AS o JOIN whole ON other = o.license
  WHERE o.n = h.n AND (o.containment > h.containment OR (o.containment = h.containment AND o.n_shared > h.n_shared))
    AND list_has_all(other_shingles, h.shared)
)
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source FROM documents
),
words AS (SELECT doc, lang, source, unnest({_TERMS}) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS in_lang FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v, sum(in_lang) AS n_lang FROM kept GROUP BY lang),
counted AS (
  SELECT g.lang, g.source, k.term, k.in_lang, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) c USING (lang, source, term)
),
totals AS (SELECT lang, source, sum(n) AS n_group FROM counted GROUP BY ALL),
priced AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 5)) // (n_group + 5 * v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (in_lang + 5)) // (n_lang + 5 * v)::HUGEINT AS q
  FROM counted JOIN totals USING (lang, source) JOIN sizes USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM priced x JOIN priced y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
),
terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

_MARKED = r"(?:(<)(\\*)(s>|/s>|<SYS>>|</SYS>>)|(\[)(\\*)(INST\]|/INST\]))"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length('<s>' || '</s>') + 2
           + length(regexp_replace(text, '{_MARKED}', '\1\4\2\5\\\3\6', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE = {
    "op10_license_scan": LICENSES,
    "op12_source_divergence": DIVERGENCE,
    "op13_chat_formatting": CHAT,
}
