"""Plain SQL for operator 12's rows: every word with its place, joined to the templates' words."""

from __future__ import annotations

from flowguard.llm.licenses import LOWER, RARE, TEMPLATES, UPPER, WORD


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def whole_table() -> str:
    words, keys = [], []
    for t, template in enumerate(TEMPLATES):
        own = template.text.split()
        words += [(t, p, w) for p, w in enumerate(own)]
        for key in template.keys:
            k = key.split()
            at = next(i for i in range(len(own)) if own[i : i + len(k)] == k)
            keys += [(t, at + j, w) for j, w in enumerate(k)]
    return f"""
WITH templates(t, label, base) AS (VALUES {_values([(t, x.label, x.base) for t, x in enumerate(TEMPLATES)])}),
lic(t, p, w) AS (VALUES {_values(words)}),
keys(t, p, w) AS (VALUES {_values(keys)}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
w AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM d),
df AS (SELECT w, count(DISTINCT r) AS n FROM w WHERE w IN (SELECT w FROM lic) GROUP BY w),
rare AS (
  SELECT t, w FROM (
    SELECT t, w, row_number() OVER (PARTITION BY t ORDER BY coalesce(n, 0), w) AS k FROM (SELECT DISTINCT t, w FROM lic) LEFT JOIN df USING (w))
  WHERE k <= {RARE}),
post AS (SELECT t, p, w FROM lic JOIN rare USING (t, w)),
sizes AS (SELECT t, count(*) AS size FROM post GROUP BY t),
met AS (SELECT r, t, i - p AS s, count(*) AS n FROM w JOIN post USING (w) WHERE i >= p GROUP BY ALL),
stands AS (
  SELECT met.r, met.t, met.s, met.n FROM met JOIN keys ON met.t = keys.t LEFT JOIN w ON w.r = met.r AND w.i = met.s + keys.p AND w.w = keys.w
  GROUP BY ALL HAVING count(*) = count(w.w)),
places AS (
  SELECT r, s, label, base, n / size AS share FROM stands JOIN templates USING (t) JOIN sizes USING (t)
  WHERE n >= CASE WHEN base THEN size ELSE (size + 1) // 2 END)
SELECT doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words, count(*) FILTER (WHERE base) AS n_base,
  CAST(min(s) FILTER (WHERE base) AS BIGINT) AS first_word, CAST(max(s) FILTER (WHERE base) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
FROM d LEFT JOIN places USING (r) GROUP BY r, doc_id"""
