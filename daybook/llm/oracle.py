"""SQL equivalents of those queries that SQL can express."""

from daybook.llm.url_filter import PATTERNS, SITE_RULES, Rule

_WORDS = """regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _url_filter() -> str:
    rules = ", ".join(f"({_quoted(verdict)}, {_quoted(rule)})" for verdict, rule in SITE_RULES)
    expressions = [Rule(name, "block", False).expression.pattern for name in PATTERNS]
    blocked = " OR ".join(
        f"regexp_matches(lowered, {_quoted(e.replace(chr(92) + '-', '-'))}, 's')" for e in expressions
    )
    return f"""
WITH rules(verdict, rule) AS (VALUES {rules}),
cut AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(coalesce(url, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id, lowered,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
),
ruled AS (
  SELECT parts.*,
    (SELECT max(struct_pack(size := length(rule), rule := rule, verdict := verdict)) FROM rules
     WHERE starts_with(path, substr(rule, position('/' IN rule)))
       AND (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))) AS best
  FROM parts
)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.verdict, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""


ORACLE_SQL = {
    "op3_exact_dedup": """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op7_decontaminate": f"""
WITH doc_words AS (SELECT doc_id, {_WORDS} AS words FROM documents),
item_words AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, words[start : start + 9] AS words
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start
        FROM item_words WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT len(words) AS size FROM windows),
spans AS (
  SELECT doc_id, start, size, words[start : start + size - 1] AS words
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
        FROM doc_words, sizes WHERE len(words) >= size)
),
found AS (
  SELECT doc_id, start, size, item_id FROM spans JOIN windows USING (words)
),
hits AS (
  SELECT doc_id, count(DISTINCT position) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + size)) AS position
        FROM (SELECT DISTINCT doc_id, start, size FROM found))
  GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
  GROUP BY doc_id
),
terms AS (
  SELECT words, w, min(place) AS place
  FROM (SELECT words, unnest(words) AS w, generate_subscripts(words, 1) AS place FROM (SELECT DISTINCT words FROM windows))
  GROUP BY words, w
),
positions AS (
  SELECT * FROM (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS position FROM doc_words)
  WHERE w IN (SELECT w FROM terms)
),
frequencies AS (SELECT w, count(*) AS n FROM positions GROUP BY w),
rarest AS (
  SELECT words, arg_min(w, struct_pack(n := coalesce(n, 0), place := place)) AS w, count(*) AS wanted
  FROM terms LEFT JOIN frequencies USING (w) GROUP BY words HAVING min(coalesce(n, 0)) > 0
),
anchors AS (SELECT words, wanted, doc_id, position FROM rarest JOIN positions USING (w)),
near AS (
  SELECT DISTINCT words, doc_id FROM (
    SELECT a.words, a.doc_id, a.position FROM anchors a JOIN terms t ON t.words = a.words
    JOIN positions p ON p.doc_id = a.doc_id AND p.w = t.w AND abs(p.position - a.position) <= 12
    GROUP BY a.words, a.doc_id, a.position, a.wanted HAVING count(DISTINCT t.w) = a.wanted)
),
near_items AS (
  SELECT doc_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM near JOIN windows USING (words))
  GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0) AS n_near, sha256(coalesce(near_listed, '')) AS near_sha256
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near_items USING (doc_id)
""",
    "op8_url_filter": _url_filter(),
    "op11_lexical": f"""
WITH docs AS (
  SELECT * FROM (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents)
  WHERE len(words) > 0
),
corpus AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs),
tfs AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
  GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus
),
items AS (
  SELECT DISTINCT row, item_id, unnest(words) AS term
  FROM (SELECT row_number() OVER () AS row, item_id, {_WORDS} AS words FROM benchmark)
),
scored AS (
  SELECT items.row AS item, item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term), corpus
  GROUP BY items.row, item_id, tfs.row, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
""",
    "op13_chat": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
pieces AS (
  SELECT *, '<s>' || replace(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'), '[', '%5B')
    || chr(10) || regexp_replace(text,
      '([<\\[]/?)(\\\\*)(s>|INST\\]|SYS\\]|<SYS>>|\\|im_start\\|>|\\|im_end\\|>)', '\\1\\\\\\2\\3', 'g')
    || '</s>' AS piece
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
""",
}
