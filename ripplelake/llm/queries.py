"""The operators as named queries over their whole tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ripplelake.llm import (
    arc, decontaminate, divergence, language, line_templates, manifest, packing, quality, sharding, simhash, suffix_dedup, tokens,
    toxicity,
)
from ripplelake.llm.common import table
from ripplelake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]


def _over(*names: str) -> Callable[[Callable[..., DataFrame]], Query]:
    return lambda make: lambda spark, sf_dir: make(*(table(use_utc(spark), sf_dir, n) for n in names))


def queries() -> dict[str, Query]:
    documents = _over("documents")
    return {
        "op1_line_templates": documents(line_templates.report),
        "op2_quality_cascade": documents(quality.report),
        "op3_arc_to_warc": _over("pages")(arc.round_trip),
        "op4_bm25_packing": documents(packing.pack),
        "op5_token_counts": documents(tokens.token_counts),
        "op6_repeated_bytes": documents(suffix_dedup.report),
        "op7_simhash_classes": documents(simhash.report),
        "op8_minimax_shards": documents(sharding.assign),
        "op9_toxicity": _over("documents", "labels")(toxicity.report),
        "op10_spaced_seeds": _over("documents", "benchmark")(decontaminate.report),
        "op11_language_families": documents(language.report),
        "op12_source_divergence": documents(divergence.audit),
        "op13_merkle_manifest": documents(manifest.manifest),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_cascade": QUALITY, "op12_source_divergence": DIVERGENCE, "op13_merkle_manifest": MANIFEST}


QUALITY = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(following - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM repeated) GROUP BY doc_id
), figures AS (
  SELECT w.doc_id, text, words, lines,
    len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS upper_letters,
    length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words
    OR 10 * n_symbols > n_words
    OR 5 * length(regexp_replace(text, '[^!]+', '', 'g')) > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 2 * upper_letters > letters
    OR 2 * letters < word_chars
    OR 10 * len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) > 3 * n_words
    OR 100 * n_dup_lines > 70 * len(lines)
  ) AS kept
FROM figures
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'
    ) AS terms
  FROM documents
), w AS (
  SELECT id, lang, source, term, count(*) AS n FROM (SELECT id, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS q_n FROM w GROUP BY lang, term HAVING count(*) >= 10
), grouped AS (
  SELECT w.lang, source, term, CAST(sum(n) AS HUGEINT) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), v AS (SELECT lang, count(*) AS v, sum(q_n) AS q_total FROM kept GROUP BY lang
), g AS (
  SELECT d.lang, d.source, coalesce(any_value(t.total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM grouped GROUP BY ALL) t ON t.lang = d.lang AND t.source = d.source
  GROUP BY ALL
), priced AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v.v) AS p,
    1 + (1000000000::HUGEINT * (k.q_n + 2)) // (v.q_total + 2 * v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept k USING (lang)
  LEFT JOIN grouped c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM priced WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

MANIFEST = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text
  FROM documents
), crc AS (  -- CRC-32 of the decimal doc_id, bit by bit; only whether it is even counts
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(c, ascii(s[i // 9 + 1])::BIGINT)
    WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc WHERE i < 9 * length(s)
), even AS (
  SELECT doc_id, xor(c, 4294967295) % 2 = 0 AS even FROM crc WHERE i = 9 * length(s)
), leaves AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS other
  FROM d
), placed AS (
  SELECT l.*, coalesce(e.even, false) AS tampered,
    row_number() OVER (PARTITION BY tree ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves l LEFT JOIN even e ON e.doc_id = l.doc_id
), up AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, pos // 3, n
), sides AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM up a JOIN up b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL
), top_sides AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM top a JOIN top b ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL
), climb AS (
  SELECT tree, pos AS place, doc_id, leaf, 0 AS level, pos, '' AS proof, CASE WHEN tampered THEN other ELSE leaf END AS h FROM placed
  UNION ALL
  SELECT c.tree, c.place, c.doc_id, c.leaf, c.level + 1, c.pos // 3, c.proof || s.l || s.r, sha256(s.l || c.h || s.r)
  FROM climb c JOIN sides s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos
), arrived AS (
  SELECT c.*, s.pos AS top_pos, s.subroot FROM climb c JOIN (SELECT tree, max(level) AS level FROM up GROUP BY tree) e USING (tree, level)
  JOIN subroots s USING (tree)
), climb_top AS (
  SELECT tree, place, doc_id, leaf, subroot, 0 AS level, top_pos AS pos, proof, h FROM arrived
  UNION ALL
  SELECT c.tree, c.place, c.doc_id, c.leaf, c.subroot, c.level + 1, c.pos // 3, c.proof || s.l || s.r, sha256(s.l || c.h || s.r)
  FROM climb_top c JOIN top_sides s ON s.level = c.level AND s.pos = c.pos
)
SELECT c.doc_id, c.leaf, c.subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.h AS verified
FROM climb_top c JOIN (SELECT level, h FROM top WHERE n = 1) r ON c.level = r.level
"""
