"""SQL counterparts, for DuckDB, of the corpus queries that SQL can express."""

from __future__ import annotations

from eventloom.llm import mixing, quality

ORACLE: dict[str, str] = {"op5_mix_sources": mixing.copies_sql()}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')"

# The conditions of the rules are plain SQL in both engines.
_FAILED = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(quality.RULES.values()))

ORACLE["op4_quality_ledger"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
each AS (SELECT no, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
windows AS (
  SELECT no, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM each WINDOW o AS (PARTITION BY no ORDER BY i)),
often AS (SELECT no, i, count(*) OVER (PARTITION BY no, w, w1, w2) > 1 AS again FROM windows WHERE w2 IS NOT NULL),
covered AS (SELECT no, count(DISTINCT i + j) AS n FROM often, (VALUES (0), (1), (2)) AS v(j) WHERE again GROUP BY no),
lines AS (SELECT no, unnest(string_split(text, chr(10))) AS line FROM docs),
counted AS (SELECT no, count(*) AS n, count(DISTINCT line) AS d FROM lines WHERE regexp_matches(line, '[^ \x09-\x0D]') GROUP BY no),
measured AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n, 0) AS n_lines, coalesce(l.n - l.d, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_letter_words,
    length(regexp_replace(text, '\P{{L}}', '', 'g')) AS n_letters, length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS n_capitals
  FROM docs d LEFT JOIN counted l USING (no) LEFT JOIN covered c USING (no)),
judged AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & {quality.BASE.mask()} <> 0 AS base_failed, failed & {quality.STANDARD.mask()} = 0 AS kept, failed
FROM judged"""

ORACLE["op10_lattice_groups"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e LEFT JOIN counts c USING (vec_id) LEFT JOIN least l USING (vec_id)"""

# Messages as (no, lines); passages are runs of lines of one level without a blank one.
ORACLE["op1_quotation_linking"] = r"""
WITH RECURSIVE messages AS (SELECT row_number() OVER () AS no, * FROM conversations),
split AS (
  SELECT no, unnest(string_split(clean, chr(10))) AS line, generate_subscripts(string_split(clean, chr(10)), 1) AS i
  FROM (SELECT no, replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(1), chr(2)) AS clean FROM messages)),
prefixed AS (SELECT *, regexp_extract(line, '^(?:[ \t]*>)+') AS prefix FROM split),
levelled AS (
  SELECT no, i, len(prefix) - len(replace(prefix, '>', '')) AS level,
    CASE WHEN prefix <> '' THEN regexp_replace(substr(line, len(prefix) + 1), '^[ \t]', '') ELSE line END AS body FROM prefixed),
lines AS (
  SELECT no, i, body, CASE WHEN level = 0 AND coalesce(lead(level) OVER o, 0) > 0
    AND regexp_matches(body, '(?i)\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$') THEN -1 ELSE level END AS level
  FROM levelled WINDOW o AS (PARTITION BY no ORDER BY i)),
own AS (
  SELECT no, max(greatest(level, 0)) AS levels,
    regexp_replace(regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0), ''), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g') AS tidy
  FROM lines GROUP BY no),
beside AS (SELECT *, lag(body) OVER o AS b, lag(level) OVER o AS l FROM lines WINDOW o AS (PARTITION BY no ORDER BY i)),
cut AS (
  SELECT *, sum(CASE WHEN i = 1 OR NOT regexp_matches(body, '\S') OR NOT regexp_matches(b, '\S') OR l <> level THEN 1 ELSE 0 END)
    OVER (PARTITION BY no ORDER BY i) AS p FROM beside),
passages AS (SELECT no, p, any_value(level) AS level, string_agg(body, chr(10) ORDER BY i) AS body, count(*) AS n FROM cut GROUP BY no, p),
bodies AS (
  SELECT no, level, body FROM passages
  UNION ALL SELECT c.no, c.level, c.body FROM cut c JOIN passages p ON p.no = c.no AND p.p = c.p WHERE p.n > 1),
units AS (
  SELECT m.conv_id AS conv, m.turn, b.level, trim(regexp_replace(lower(b.body), '\s+', ' ', 'g')) AS words
  FROM bodies b JOIN messages m USING (no) WHERE m.conv_id IS NOT NULL AND m.turn IS NOT NULL AND trim(regexp_replace(b.body, '\s+', ' ', 'g')) <> ''),
here AS (SELECT words, conv, min(turn) AS first FROM units WHERE level = 0 GROUP BY ALL),
anywhere AS (SELECT words, min({'c': conv, 't': first}) AS elsewhere FROM here GROUP BY words),
quoted AS (SELECT conv, turn, level, words, sum(len(words)) AS weight FROM units WHERE level > 0 GROUP BY ALL),
links AS (
  SELECT q.conv, q.turn, q.level, q.weight, coalesce(CASE WHEN h.first < q.turn THEN {'c': q.conv, 't': h.first} END,
    CASE WHEN a.elsewhere < {'c': q.conv, 't': q.turn} THEN a.elsewhere END) AS origin
  FROM quoted q LEFT JOIN here h ON h.words = q.words AND h.conv = q.conv LEFT JOIN anywhere a ON a.words = q.words),
origins AS (SELECT conv, turn, origin, min(level) AS level, sum(weight) AS weight, count(*) AS n FROM links GROUP BY conv, turn, origin),
answers AS (
  SELECT conv, turn, sum(n) AS quoted, coalesce(sum(n) FILTER (origin IS NOT NULL), 0) AS linked,
    arg_max(origin, {'l': -level, 'w': weight, 't': origin.t, 'c': origin.c}) FILTER (origin IS NOT NULL) AS parent
  FROM origins GROUP BY conv, turn),
climbed AS (
  SELECT conv, turn, parent AS root, 1 AS depth FROM answers WHERE parent IS NOT NULL
  UNION ALL SELECT c.conv, c.turn, a.parent, c.depth + 1 FROM climbed c JOIN answers a ON a.conv = c.root.c AND a.turn = c.root.t WHERE a.parent IS NOT NULL),
roots AS (SELECT conv, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM climbed GROUP BY conv, turn)
SELECT m.conv_id, m.turn, m.role, CASE WHEN o.levels > 0 THEN o.tidy ELSE m.text END AS text, CAST(o.levels AS INTEGER) AS levels,
  CAST(coalesce(a.quoted, 0) AS BIGINT) AS quoted, CAST(coalesce(a.linked, 0) AS BIGINT) AS linked,
  a.parent.c AS answers_conv, a.parent.t AS answers_turn, coalesce(r.root.c, m.conv_id) AS conversation,
  coalesce(r.root.t, m.turn) AS root_turn, CAST(coalesce(r.depth, 0) AS BIGINT) AS depth
FROM messages m JOIN own o USING (no)
LEFT JOIN answers a ON a.conv = m.conv_id AND a.turn = m.turn LEFT JOIN roots r ON r.conv = m.conv_id AND r.turn = m.turn"""


# The remainder of an unsigned CRC-32, bit by bit over the digits of an id.
_CRC = r"""xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, len({v}) + 1), lambda i: ascii(substr({v}, i, 1))::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(0, 8), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))))"""
_FIELDS = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("doc_id", "source", "lang", "n_chars", "text")
)

ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS no, doc_id, lang, sha256({_FIELDS}) AS leaf, {_CRC.format(v='CAST(doc_id AS VARCHAR)')} % 7 = 0 AS tampered,
    sha256({_FIELDS.replace('(n_chars', '(n_chars + 1')}) AS changed FROM documents),
nodes AS (
  SELECT lang, 0 AS level, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, no) - 1 AS i, leaf AS h,
    count(*) OVER (PARTITION BY lang) AS n, no FROM docs
  UNION ALL SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2, NULL FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, i // 2, n),
beside AS (
  SELECT d.no, s.level, s.h, s.i < (l.i >> s.level) AS before FROM docs d JOIN nodes l ON l.no = d.no
  JOIN nodes s ON s.lang IS NOT DISTINCT FROM d.lang AND s.level < 62 AND s.i = xor(l.i >> s.level, 1)
  UNION ALL SELECT d.no, 1000 + t.level, t.h, t.i < (s.i >> t.level) FROM docs d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
  JOIN tops t ON t.i = xor(s.i >> t.level, 1)),
heights AS (
  SELECT d.no, unnest(range(0, (SELECT max(level) FROM nodes x WHERE x.lang IS NOT DISTINCT FROM d.lang)) || range(1000, 1000 + (SELECT max(level) FROM tops))) AS level FROM docs d),
steps AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY level) AS k FROM heights LEFT JOIN beside USING (no, level)),
proofs AS (SELECT no, string_agg(coalesce(h, ''), '' ORDER BY k) AS proof FROM steps GROUP BY no),
folds AS (
  SELECT no, 0 AS k, CASE WHEN tampered THEN changed ELSE leaf END AS h FROM docs
  UNION ALL SELECT f.no, f.k + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.before THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f JOIN steps s ON s.no = f.no AND s.k = f.k + 1),
ends AS (SELECT no, arg_max(h, k) AS folded_root FROM folds GROUP BY no)
SELECT d.doc_id, d.leaf, s.subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.folded_root,
  e.folded_root = (SELECT h FROM tops WHERE n = 1) AS verified
FROM docs d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang JOIN ends e USING (no) LEFT JOIN proofs p USING (no)"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op12_best_position_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS no, doc_id, {_TERMS} AS terms FROM documents),
sized AS (SELECT no, doc_id, len(terms) AS n, terms FROM docs WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sized),
postings AS (SELECT no, term, count(*) AS tf FROM (SELECT no, unnest(terms) AS term FROM sized) GROUP BY no, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, totals GROUP BY term),
items AS (SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark)),
scores AS (
  SELECT item, any_value(item_id) AS item_id, p.no, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)))) AS score
  FROM items JOIN postings p USING (term) JOIN weights USING (term) JOIN sized s ON s.no = p.no, totals GROUP BY item, p.no),
places AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM places WHERE place <= 50"""
