"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from edgeloom.llm.decontaminate import op8_decontaminate
from edgeloom.llm.langid import op1_language_id
from edgeloom.llm.licenses import op10_license_scan
from edgeloom.llm.mixing import op3_mixing
from edgeloom.llm.periods import op12_periodic_runs
from edgeloom.llm.phrases import op11_collocations
from edgeloom.llm.quality import op4_quality
from edgeloom.llm.rpforest import op5_embedding_dedup
from edgeloom.llm.sharding import op9_sharding
from edgeloom.llm.simhash import op7_simhash_dedup
from edgeloom.llm.surrogates import op2_surrogates
from edgeloom.llm.token_counts import op13_token_counts
from edgeloom.llm.tokens import op6_token_blocks

QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_surrogates, op3_mixing, op4_quality, op5_embedding_dedup, op6_token_blocks, op7_simhash_dedup,
    op8_decontaminate, op9_sharding, op10_license_scan, op11_collocations, op12_periodic_runs, op13_token_counts,
)}

WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: The raking as so many sweeps, each a chain of three scalings; more than any given table needs.
SWEEPS = 12


def _scaling(before: str, after: str, name: str) -> str:
    return f"""{after} AS MATERIALIZED (SELECT source, lang, topic, tokens,
  weight * t_{name} / sum(weight) OVER (PARTITION BY {name}) AS weight, t_source, t_lang, t_topic FROM {before})"""


def _raking() -> str:
    steps, last = [], "start"
    for sweep in range(SWEEPS):
        for name in ("source", "lang", "topic"):
            steps.append(_scaling(last, f"w{sweep}_{name}", name))
            last = f"w{sweep}_{name}"
    return ", ".join(steps) + f", raked AS (SELECT * FROM {last})"


def _share(characters: str) -> str:
    return f"(length(text) - length(translate(text, '{characters}', ''))) / greatest(1, length(text))"


MIXING = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, chr(0)) AS source, coalesce(lang, chr(0)) AS lang,
    CASE WHEN text IS NULL OR text = '' THEN 'empty'
      WHEN {_share("ABCDEFGHIJKLMNOPQRSTUVWXYZ")} > 0.3 THEN 'shouted' WHEN {_share("%$#&*|!<>{}=_")} > 0.02 THEN 'marked'
      WHEN {_share("0123456789")} > 0.01 THEN 'numeric' WHEN length(text) > 5000 THEN 'long' ELSE 'prose' END AS topic,
    greatest(1, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0))::BIGINT AS tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL),
s AS (SELECT source, sqrt(sum(tokens)) AS t FROM cells GROUP BY source),
l AS (SELECT lang, sqrt(sum(tokens)) AS t FROM cells GROUP BY lang),
o AS (SELECT topic, sqrt(sum(tokens)) AS t FROM cells GROUP BY topic),
start AS MATERIALIZED (
  SELECT source, lang, topic, tokens, tokens AS weight, s.t / (SELECT sum(t) FROM s) AS t_source,
    l.t / (SELECT sum(t) FROM l) AS t_lang, o.t / (SELECT sum(t) FROM o) AS t_topic
  FROM cells JOIN s USING (source) JOIN l USING (lang) JOIN o USING (topic)),
{_raking()},
full_first AS (  -- cells in the order in which they reach probability 1, with what is left for the others
  SELECT *, (0.5 * (SELECT sum(tokens) FROM cells) - coalesce(sum(tokens) OVER b, 0))
    / ((SELECT sum(weight) FROM raked) - coalesce(sum(weight) OVER b, 0)) AS level
  FROM raked WINDOW b AS (ORDER BY tokens / weight, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT arg_min(level, tokens / weight) AS level FROM full_first WHERE level * weight < tokens),
p AS (SELECT source, lang, topic, weight, least(1.0, level * weight / tokens) AS p FROM raked, k)
SELECT doc_id, source, lang, topic, d.tokens, round(weight, 9) AS weight, round(p, 7) AS p,
  ('0x' || substr(md5('mix:' || doc_id), 1, 12))::BIGINT / 281474976710656.0 < p AS drawn
FROM d JOIN p USING (source, lang, topic)"""

EMBEDDINGS = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda z: z <> 0)) > 0
    AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0),
p AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
cc(n, l) USING KEY (n) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT p.b, min(cc.l) FROM cc JOIN p ON p.a = cc.n JOIN recurring.cc q ON q.n = p.b
  GROUP BY p.b HAVING min(cc.l) < min(q.l)),
n AS (SELECT a, count(*) AS links FROM p GROUP BY a)
SELECT vec_id, coalesce(links, 0)::BIGINT AS n_links, l AS component_id, vec_id = l AS kept
FROM embeddings LEFT JOIN n ON a = vec_id JOIN cc ON cc.n = vec_id"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
v AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM v GROUP BY lang),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM v, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN t USING (lang) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (
  SELECT lang, part, max(f) AS most FROM (SELECT lang, f, unnest([array_to_string(w[:k - 1], ' '), array_to_string(w[2:], ' ')]) AS part
    FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 2)) GROUP BY lang, part),
q AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.part = b.phrase WHERE most IS NULL OR most < a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM q WHERE rank <= 2000"""

ORACLES = {
    "op3_mixing": MIXING,
    "op5_embedding_dedup": EMBEDDINGS,
    "op11_collocations": COLLOCATIONS,
    "op8_decontaminate": f"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS p, least(len(w), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN win USING (p)),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hit),
h AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
