"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from addrloom.llm.mixing import BLOCK_WORDS, ROUNDS, chunk_of, permutation_round

ORACLE: dict[str, str] = {}

ORACLE["op8_exact_dedup"] = """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))"""

ORACLE["op1_line_dedup"] = """
WITH lines AS (
  SELECT rowid_, doc_id, source, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, source,
               string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), common AS (
  SELECT line FROM lines WHERE trim(line, ' ') <> '' GROUP BY line
  HAVING count(DISTINCT coalesce('=' || source, '')) >= 5
), marked AS (
  SELECT l.*, c.line IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON l.line = c.line
)
SELECT any_value(doc_id) AS doc_id,
  CASE WHEN count(*) = 1 AND any_value(line) = '' THEN 0 ELSE count(*) END AS n_lines,
  count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rowid_"""


def _permuted(x: str, n: str, seed: str, *, inverse: bool = False) -> str:
    """The permutation of ``mixing.permuted`` as DuckDB SQL, from the definition of its rounds."""
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    body = permutation_round("v", "r", n, seed)
    return f"list_reduce({list(rounds)}::BIGINT[], lambda v, r: {body}, CAST({x} AS BIGINT))"


ORACLE["op9_mixing"] = f"""
WITH docs AS (
  SELECT doc_id AS id, source, coalesce('=' || source, '') AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents
), chunked AS (
  SELECT *, {chunk_of("id", "(SELECT greatest(1, floor(sqrt(count(*)))::BIGINT) FROM documents)")} AS chunk
  FROM docs
), placed AS (
  SELECT *, row_number() OVER () AS nr,
    (sum(size) OVER (PARTITION BY key ORDER BY chunk, id NULLS FIRST, size
      ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM chunked
), sizes AS (
  SELECT key, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1 AS rank
  FROM docs GROUP BY key
), weighed AS (
  SELECT *, [3, 1, 2][(rank % 3)::INT + 1] AS weight, source_size * 2 AS bound,
    source_size * 2 / [3, 1, 2][(rank % 3)::INT + 1] AS ratio, sum(source_size) OVER () AS total
  FROM sizes
), levels AS (
  SELECT *, row_number() OVER filling AS nth,
    (total * 1.5::DOUBLE - (sum(bound) OVER filling - bound)::DOUBLE)
      / (sum(weight) OVER () - (sum(weight) OVER filling - weight))::DOUBLE AS level
  FROM weighed WINDOW filling AS (ORDER BY ratio, rank ROWS UNBOUNDED PRECEDING)
), targets AS (
  SELECT key, rank, source_size,
    least(bound::DOUBLE, weight * (SELECT min_by(level, nth) FROM levels WHERE level <= ratio)) AS target
  FROM levels
), plans AS (
  SELECT *, take // source_size AS full_, take % source_size AS rest,
    blocks * {BLOCK_WORDS} - source_size AS short
  FROM (SELECT *, round(target)::BIGINT AS take,
      (source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS blocks
    FROM targets WHERE source_size > 0)
), places AS (
  SELECT *, {_permuted("blocks - 1", "blocks", "rank * 4 + full_", inverse=True)} AS short_at FROM plans
), each_block AS (
  SELECT *, {_permuted("block", "blocks", "rank * 4 + full_", inverse=True)} AS nth
  FROM (SELECT *, unnest(range(blocks)) AS block FROM places)
), slots AS (
  SELECT key, block, full_, greatest(0, least(
      CASE WHEN block = blocks - 1 THEN {BLOCK_WORDS} - short ELSE {BLOCK_WORDS} END,
      rest - nth * {BLOCK_WORDS} + CASE WHEN nth > short_at THEN short ELSE 0 END)) AS part
  FROM each_block
), pieces AS (
  SELECT nr, key, block, greatest(start - block * {BLOCK_WORDS}, 0) AS inset,
    least(start + size, (block + 1) * {BLOCK_WORDS}) - greatest(start, block * {BLOCK_WORDS}) AS length
  FROM (SELECT *, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block
    FROM placed WHERE size > 0)
), taken AS (
  SELECT nr, sum(full_ * length + greatest(0, least(length, part - inset)))::BIGINT AS taken
  FROM pieces JOIN slots USING (key, block) GROUP BY nr
)
SELECT id AS doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM placed JOIN targets USING (key) LEFT JOIN taken USING (nr)"""


ORACLE["op11_fill_in_middle"] = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, t, l, len(l)::BIGINT AS n,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS d
  FROM lines
), cuts AS (
  SELECT doc_id, t, l, n, least(d[1] % (n + 1), d[2] % (n + 1)) AS a,
    greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 100
      THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(l[1:a], '') AS prefix,
    array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:n], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""

ORACLE["op12_exact_topk_search"] = """
WITH points AS (
  SELECT row_number() OVER () AS nr, vec_id,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, p.vec_id, list_inner_product(q.v, p.v)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.nr
      ORDER BY list_inner_product(q.v, p.v) DESC, p.vec_id NULLS LAST)::INTEGER AS rank
  FROM points q JOIN points p ON q.nr <> p.nr
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

ORACLE["op13_source_divergence_audit"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT nr, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::BIGINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT nr) >= 30
), langs AS (
  SELECT lang, count(*)::BIGINT AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*)::BIGINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n)::BIGINT AS total FROM counts GROUP BY lang, source
), chances AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 5) // (coalesce(t.total, 0) + 5 * l.v) AS p,
    1 + 1000000000 * (k.n + 5) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM chances a JOIN chances b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM chances WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""
