"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from tidemark.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, block_length, needed, telling
from tidemark.llm.quality_rules import MIN_WORDS, RULES, STOP_FORMS, SYMBOLS
from tidemark.llm.url_filters import RULES as URL_RULES

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _texts(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _breaks(rule) -> str:
    value = f"{rule.measure}::DOUBLE / nullif({rule.per}, 0)" if rule.per != "one" else rule.measure
    tests = [f"{value} < {rule.least}"] if rule.least is not None else []
    tests += [f"{value} > {rule.most}"] if rule.most is not None else []
    return f"coalesce({' OR '.join(tests)}, FALSE)"


QUALITY_RULES = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    [line FOR line IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(line, '{WORD}')] AS lines
  FROM documents),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
covered AS (
  SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS word
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(*) AS n FROM covered GROUP BY r),
measured AS (
  SELECT doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[{SYMBOLS}]')) AS n_symbols,
    len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len([w FOR w IN words IF w IN ({_texts(STOP_FORMS)})]) AS n_stop_words,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
  AND NOT ({" OR ".join(_breaks(rule) for rule in RULES)}) AS kept
FROM measured
"""

URL_FILTERS = f"""
WITH rules(rule, host, path, verdict) AS (
  VALUES {", ".join(f"('{r.target}', '{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}),
sites AS (
  SELECT row_number() OVER () AS r, page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {LETTERS}) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM sites),
fits AS (
  SELECT parts.*, rules.rule, rules.verdict,
    row_number() OVER (PARTITION BY r ORDER BY length(rules.rule) DESC NULLS LAST, rules.verdict DESC) AS place
  FROM parts LEFT JOIN rules
  ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host)) AND starts_with(parts.path, rules.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

_TEMPLATE_ROWS = ", ".join(
    f"('{t.label}', [{_texts(t.words)}], {needed(t, CONTAINMENT)}, {block_length(t, CONTAINMENT)},"
    f" [{_texts(telling(t, TEMPLATES, CONTAINMENT))}]::VARCHAR[])"
    for t in TEMPLATES
)
_PHRASE_ROWS = ", ".join(f"([{_texts(phrase.split())}], '{label}')" for phrase, label in PHRASES.items())

LICENSE_SCAN = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
phrases(words, label) AS (VALUES {_PHRASE_ROWS}),
templates(label, words, least, length, must) AS (VALUES {_TEMPLATE_ROWS}),
starts AS (SELECT r, words, unnest(range(len(words))) AS i FROM split),
base AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM starts JOIN phrases p ON starts.words[i + 1] = p.words[1] AND starts.words[i + 1 : i + len(p.words)] = p.words
  GROUP BY r),
alike AS (
  SELECT r, split.words AS text, label, t.words, least, length, must FROM split, templates t
  WHERE len(list_intersect(split.words, t.words)) >= least),
blocks AS (
  SELECT r, label, words, least, must, text[i + 1 : i + length] AS block
  FROM (SELECT *, unnest(range(len(text))) AS i FROM alike)),
met AS (
  SELECT r, label, len(list_intersect(block, words)) AS shared, len(words) AS size, least FROM blocks
  WHERE list_has_all(block, must)),
found AS (
  SELECT r, list(DISTINCT label) AS labels, max(shared::DOUBLE / size) AS best FROM met WHERE shared >= least GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM split LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""

WARC_INDEX = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
typed AS (
  SELECT *, CASE WHEN payload_bytes >= 100 AND count(*) OVER w > 1 THEN min(page_id) OVER w END AS first
  FROM hashed WINDOW w AS (PARTITION BY payload_digest))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM typed
"""



def _encoded(values) -> str:
    return " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR))::VARCHAR || ':' || {v}, '-')" for v in values)


def _level(below: str, name: str) -> str:
    """One level up, for trees of more than one node: the runs of eight and what a leaf needs of its own."""
    before, after = "array_to_string(hs[1:(i % 8)], '')", "array_to_string(hs[(i % 8 + 2):], '')"
    return f"""
{name}_nodes AS (SELECT DISTINCT tree, i, h FROM {below}),
{name}_sizes AS (SELECT tree, count(*) AS n FROM {name}_nodes GROUP BY tree),
{name}_runs AS (SELECT tree, i // 8 AS p, list(h ORDER BY i) AS hs FROM {name}_nodes GROUP BY ALL),
{name} AS (
  SELECT r, tree, CASE WHEN n > 1 THEN i // 8 ELSE i END AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE h END AS h,
    CASE WHEN n > 1 THEN sha256({before} || f || {after}) ELSE f END AS f,
    CASE WHEN n > 1 THEN proof || {before} || {after} ELSE proof END AS proof
  FROM {below} l JOIN {name}_sizes USING (tree) JOIN {name}_runs m ON m.tree = l.tree AND m.p = l.i // 8)"""


_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# The digits of doc_id one by one, with eight marks after each that shift the remainder by a bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295, flatten([list_prepend(ascii(c)::BIGINT, repeat([-1::BIGINT], 8)) FOR c IN string_split(doc_id::VARCHAR, '')])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""
# Enough levels for 8 ** 8 rows of a language and 8 ** 3 languages.
_UP, _TREES_UP = 8, 3

MERKLE_MANIFEST = f"""
WITH leaves AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree, sha256({_encoded(_FIELDS)}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN sha256({_encoded([*_FIELDS[:4], f"translate(text, {LETTERS})"])}) END AS changed
  FROM documents),
up0 AS (
  SELECT r, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, leaf AS h,
    coalesce(changed, leaf) AS f, '' AS proof FROM leaves),
{",".join(_level(f"up{k}", f"up{k + 1}") for k in range(_UP))},
top0 AS (SELECT r, 'all' AS tree, dense_rank() OVER (ORDER BY tree) - 1 AS i, h, f, proof FROM up{_UP}),
{",".join(_level(f"top{k}", f"top{k + 1}") for k in range(_TREES_UP))}
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(t.proof) AS proof_sha256, t.f AS folded_root, t.f = t.h AS verified
FROM leaves JOIN up{_UP} s USING (r) JOIN top{_TREES_UP} t USING (r)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{_TERM}') AS terms
  FROM documents),
total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0),
asked AS (
  SELECT q, item_id, t, count(*) AS times FROM (
    SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{_TERM}')) AS t
    FROM benchmark) GROUP BY ALL),
held AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(terms) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM held GROUP BY t), total),
measures AS (SELECT r, doc_id, 100 - 25 + ((25 * len(d.terms) * docs) // total.terms) AS m FROM d, total),
scores AS (
  SELECT q, item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN measures USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT r, v FROM given
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.r AS a, b.r AS b FROM usable a, usable b WHERE a.r <> b.r AND list_cosine_similarity(a.v, b.v) >= 0.9),
reached(r, node) AS (SELECT r, r FROM given UNION SELECT reached.r, b FROM reached JOIN pairs ON node = a),
classes AS (SELECT reached.r, min(vec_id) AS component_id FROM reached JOIN given ON node = given.r GROUP BY reached.r),
degrees AS (SELECT a AS r, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM given JOIN classes USING (r) LEFT JOIN degrees USING (r)
"""

ORACLE = {
    "op2_quality_rules": QUALITY_RULES,
    "op4_url_filters": URL_FILTERS,
    "op5_warc_index": WARC_INDEX,
    "op10_license_scan": LICENSE_SCAN,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_embedding_dedup": EMBEDDING_DEDUP,
}
