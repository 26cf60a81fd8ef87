"""SQL counterparts of the training-data queries, where SQL can express them."""

from __future__ import annotations

from costledger.llm import quality
from costledger.llm.chat import CONTROLS, END, TEXT, TURN

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped_length(column: str) -> str:
    """Length of a text in the template: a backslash more for each backslash and each control string."""
    strings = ["\\", *CONTROLS]
    counts = [f"(length({column}) - length(replace({column}, {_quoted(c)}, ''))) // {len(c)}" for c in strings]
    return f"(length({column}) + {' + '.join(counts)})"


def _listed(texts) -> str:
    return "(" + ", ".join(_quoted(t) for t in sorted(texts)) + ")"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


_STOCK = " OR ".join(f"contains({_lower('line')}, {_quoted(p)})" for p in quality.STOCK_PHRASES)

QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d
), lines AS (
  SELECT r, pos, line, regexp_extract_all(line, '{WORD}') AS words FROM parts
), tested AS (
  SELECT r, words, list_sum(list_transform(words, lambda w: length(w))) AS chars,
    row_number() OVER (PARTITION BY r, line ORDER BY pos) > 1 AS copy,
    len(list_filter(words, lambda w: regexp_matches(w, {_quoted(quality.SENTENCE_END)}))) = 0
      OR 2 * len(regexp_extract_all(line, {_quoted(quality.SYMBOL.pattern)})) > len(words)
      OR 4 * len(regexp_extract_all(line, {_quoted(quality.DOUBLED.pattern)})) > len(words) AS punctuation,
    len(list_filter(words, lambda w: w IN {_listed(quality.SEPARATORS)})) AS separators,
    len(list_filter(words, lambda w: {_lower("w")} IN {_listed(quality.MENU_WORDS)})) = len(words) AS menu,
    len(words) <= {quality.SHORT_LINE} AND ({_STOCK}) AS stock
  FROM lines WHERE len(words) > 0
), ruled AS (
  SELECT *, CASE WHEN punctuation THEN 'p' WHEN menu OR separators >= 2 AND len(words) - separators <= 3 * (separators + 1) THEN 'n'
    WHEN stock OR copy THEN 'b' END AS rule
  FROM tested
), counted AS (
  SELECT r, sum(len(words))::BIGINT AS n_words, sum(chars)::BIGINT AS word_chars, count(*) AS n_lines, count(*) FILTER (copy) AS n_dup_lines,
    count(*) FILTER (rule = 'p') AS removed_punctuation, count(*) FILTER (rule = 'n') AS removed_navigation,
    count(*) FILTER (rule = 'b') AS removed_boilerplate, coalesce(sum(chars) FILTER (rule IS NOT NULL), 0)::BIGINT AS removed_chars
  FROM ruled GROUP BY r
), words AS (
  SELECT r, regexp_extract_all(text, '{WORD}') AS words FROM d
), placed AS (
  SELECT r, words, unnest(range(1, len(words) + 1)) AS pos FROM words
), windows AS (
  SELECT r, pos, CASE WHEN pos + {quality.WINDOW - 1} <= len(words) THEN array_to_string(words[pos:pos + {quality.WINDOW - 1}], ' ') END AS win FROM placed
), marked AS (
  SELECT r, pos, win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 AS again FROM windows
), covered AS (
  SELECT r, max(again::INT) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN {quality.WINDOW - 1} PRECEDING AND CURRENT ROW) AS inside FROM marked
), repeated AS (
  SELECT r, sum(inside)::BIGINT AS n_repeat_words FROM covered GROUP BY r
), together AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    len(regexp_extract_all(text, {_quoted(quality.SYMBOL.pattern)}))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(removed_punctuation, 0) AS removed_punctuation,
    coalesce(removed_navigation, 0) AS removed_navigation, coalesce(removed_boilerplate, 0) AS removed_boilerplate,
    coalesce(removed_chars, 0) AS removed_chars
  FROM d LEFT JOIN counted USING (r) LEFT JOIN repeated USING (r)
)
SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words OR 100 * removed_chars > {quality.MOST_LOST} * word_chars) AS kept
FROM together
"""


def clusters(k: int = 8, rounds: int = 10) -> str:
    """Lloyd's rounds one after the other; the nearest centroid is the smallest distance * k + number."""

    def assigned(i: int) -> str:
        squares = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: ((p[1] - p[2]) * (p[1] - p[2]))::HUGEINT))"
        return f"a{i} AS MATERIALIZED (SELECT n, v.vec_id, v.x, min({squares} * {k} + c.c) AS best FROM v, c{i} c GROUP BY ALL)"

    steps = [assigned(0)]
    for i in range(rounds):
        steps.append(f"s{i} AS (SELECT (best % {k})::INT AS c, unnest(x) AS x, generate_subscripts(x, 1) AS j FROM a{i})")
        steps.append(f"t{i} AS (SELECT c, j, sum(x)::HUGEINT AS s, count(*) AS n FROM s{i} GROUP BY c, j)")
        # floor, as // cuts towards zero
        steps.append(f"m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM t{i} GROUP BY c)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (c))")
        steps.append(assigned(i + 1))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST) - 1)::INT AS c, x FROM v QUALIFY c < {k}
), {", ".join(steps)}
SELECT vec_id, c.c AS cluster, (best // {k})::BIGINT AS distance, (sum(best // {k}) OVER (PARTITION BY c.c))::BIGINT AS cluster_inertia,
  (sum(best // {k}) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.c = best % {k}
"""


ORACLE = {
    "op3_chat": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_escaped_length("role")} + {_escaped_length("text")} + {len(TURN) + len(TEXT) + len(END) + 1})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op7_line_dedup": f"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), r AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM l
), k AS (
  SELECT doc_id, line, pos, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS key FROM r
), f AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT doc_id, line, pos, key IN (SELECT key FROM f) AS dropped FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op9_mixing": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS hash
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM d GROUP BY source
), ranked AS (
  -- sources by the share at which they are full; the first k are full
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM s
), levels AS (
  SELECT k, source_size, weight,
    (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY k DESC) AS weights
  FROM ranked
), level AS (
  SELECT k, rest, weights FROM levels WHERE rest::DOUBLE * weight / weights <= 3 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size,
    CASE WHEN r.k < l.k THEN (3 * source_size)::DOUBLE ELSE l.rest::DOUBLE * weight / l.weights END AS target
  FROM ranked r, level l
), w AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), x AS (
  SELECT d.source, length(bin(size)) AS stratum, hash, sum(size)::BIGINT AS words FROM d GROUP BY ALL
), b AS (
  SELECT x.source, x.stratum, (any_value(target) - any_value(whole) * any_value(source_size)) * sum(words)::DOUBLE / any_value(source_size) AS budget
  FROM x JOIN w ON x.source IS NOT DISTINCT FROM w.source GROUP BY x.source, x.stratum
), o AS (
  SELECT x.*, budget, sum(words) OVER (PARTITION BY x.source, x.stratum ORDER BY hash) - words AS before
  FROM x JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.stratum = b.stratum WHERE budget > 0
), edge AS (
  SELECT source, stratum, hash, budget, before::DOUBLE - budget AS low, (before + words)::DOUBLE - budget AS high,
    row_number() OVER (PARTITION BY source ORDER BY stratum DESC) AS n
  FROM o WHERE before < budget AND before + words >= budget
), walk AS (
  SELECT source, stratum, hash, n, 0.0::DOUBLE + high AS taken, 0.0::DOUBLE + low AS left_out FROM edge WHERE n = 1
  UNION ALL
  SELECT e.source, e.stratum, e.hash, e.n,
    CASE WHEN abs(p.taken) <= abs(p.left_out) THEN p.taken ELSE p.left_out END + e.high,
    CASE WHEN abs(p.taken) <= abs(p.left_out) THEN p.taken ELSE p.left_out END + e.low
  FROM walk p JOIN edge e ON p.source IS NOT DISTINCT FROM e.source AND e.n = p.n + 1
), decided AS (
  SELECT walk.source, walk.stratum, walk.hash, walk.n, budget, abs(taken) <= abs(left_out) AS inclusive,
    CASE WHEN abs(taken) <= abs(left_out) THEN taken ELSE left_out END AS error,
    CASE WHEN abs(taken) <= abs(left_out) THEN high ELSE low END AS own
  FROM walk JOIN edge ON walk.source IS NOT DISTINCT FROM edge.source AND walk.n = edge.n
), moved AS (
  -- the budget of a stratum that has to make up for the errors of all others
  SELECT decided.*, budget - (last_value(error) OVER (PARTITION BY source ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) - own) AS moved_budget
  FROM decided
), able AS (
  SELECT moved.source, min(moved.stratum) AS stratum
  FROM moved JOIN (SELECT source, stratum, sum(words) AS words FROM x GROUP BY ALL) f ON moved.source IS NOT DISTINCT FROM f.source AND moved.stratum = f.stratum
  WHERE moved_budget > 0 AND moved_budget <= f.words GROUP BY moved.source
), bounds AS (
  SELECT moved.source, moved.stratum, moved.hash, inclusive
  FROM moved LEFT JOIN able ON moved.source IS NOT DISTINCT FROM able.source AND moved.stratum = able.stratum WHERE able.stratum IS NULL
  UNION ALL
  SELECT o.source, o.stratum, o.hash, abs((before + words)::DOUBLE - moved_budget) <= abs(before::DOUBLE - moved_budget)
  FROM o JOIN able ON o.source IS NOT DISTINCT FROM able.source AND o.stratum = able.stratum
  JOIN moved ON o.source IS NOT DISTINCT FROM moved.source AND o.stratum = moved.stratum
  WHERE before < moved_budget AND before + words >= moved_budget
)
SELECT d.doc_id, d.size, w.source_size, w.target,
  (d.size * (w.whole + CASE WHEN d.hash < bounds.hash OR (d.hash = bounds.hash AND inclusive) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source
LEFT JOIN bounds ON d.source IS NOT DISTINCT FROM bounds.source AND bounds.stratum = length(bin(d.size))
""",
    "op4_near_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle
  FROM w
), n AS (
  SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id
), classes AS (
  -- equal sets go on as their smallest id
  SELECT doc_id, min(doc_id) OVER (PARTITION BY digest) AS rep FROM (SELECT doc_id, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS digest FROM s GROUP BY doc_id)
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT rep FROM classes) AND b.doc_id IN (SELECT rep FROM classes)
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rep AS id, rep AS other FROM classes UNION SELECT reach.id, edges.b FROM reach JOIN edges ON reach.other = edges.a
), least AS (
  SELECT id, min(other) AS component FROM reach GROUP BY id
)
SELECT n.doc_id, n.n AS n_shingles, coalesce(component, n.doc_id) AS component_id, coalesce(component, n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN classes USING (doc_id) LEFT JOIN least ON least.id = classes.rep
""",
    "op8_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
QUALIFY rank <= 20
""",
    "op10_vector_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (
  SELECT id, min(other) AS component FROM reach GROUP BY id
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id, component = vec_id AS kept
FROM embeddings JOIN least ON id = vec_id LEFT JOIN counted ON a = vec_id
""",
    "op11_quality": QUALITY,
    "op12_bitplanes": clusters(),
}
