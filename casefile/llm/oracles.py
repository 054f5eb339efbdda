"""SQL counterparts of the queries that SQL can express."""

ORACLES = {}

# Line breaks, tabs and the like by code; keys as the contract says.
ORACLES["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, line, regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT l.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f USING (key) GROUP BY l.doc_id
"""

# The template's fixed parts: "[INST] " + " [/INST]\n" is 16 characters, "<a>" + " </s>\n" 9,
# "<s>[ROLE " + "] " + " [/ROLE]\n" 20; one more for every backslash, bracket and angle.
ORACLES["op7_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(text, '([\\\[\]<>])', '\\\1', 'g')) +
    CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 9
      ELSE 20 + length(regexp_replace(role, '([\\\[\]<>])', '\\\1', 'g')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS unreadable_turns
FROM sized GROUP BY conv_id
"""

ORACLES["op8_jaccard_join"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b, c, x.n AS n, y.n AS m FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)
), texts AS (  -- documents with equal sets: the smallest id stands for them
  SELECT d.doc_id, least(d.doc_id, coalesce(min(l.b) FILTER (WHERE l.c = l.n AND l.c = l.m), d.doc_id)) AS rep
  FROM documents d LEFT JOIN links l ON l.a = d.doc_id GROUP BY 1
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY 1)
SELECT d.doc_id, k.class_id, count(l.b) AS n_links,
  count(DISTINCT CASE WHEN t.rep <> own.rep THEN t.rep END) AS n_text_links
FROM documents d JOIN class k ON k.a = d.doc_id JOIN texts own ON own.doc_id = d.doc_id
LEFT JOIN links l ON l.a = d.doc_id LEFT JOIN texts t ON t.doc_id = l.b
GROUP BY 1, 2
"""

ORACLES["op11_hard_negatives"] = r"""
WITH rows_ AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, a.label = b.label AS same, b.rid AS item, b.vec_id,
    CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.rid <> b.rid AND len(a.vec) = len(b.vec) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT rid, item AS p_item, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, item) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN positives USING (rid)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY rid, p_item ORDER BY score DESC, vec_id, item)
QUALIFY row_number() OVER w <= 10
"""

ORACLES["op13_spelling"] = r"""
WITH RECURSIVE steps AS (  -- the checksum's table, from its polynomial
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents) GROUP BY ALL
), summed AS (
  SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(id || ':' || run, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [195::BIGINT, unicode(ch) - 64] END))),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h FROM runs, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM summed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (  -- every word with each of its characters taken out, and as it is
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
    CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)
), reach AS (
  SELECT word, form AS root FROM formed WHERE form IS NOT NULL
  UNION SELECT r.word, f.form FROM reach r JOIN formed f ON f.word = r.root WHERE f.form IS NOT NULL
), ends AS (SELECT word, root FROM reach r WHERE NOT EXISTS (SELECT 1 FROM formed f WHERE f.word = r.root AND f.form IS NOT NULL))
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM formed f LEFT JOIN ends e ON e.word = f.word
"""
