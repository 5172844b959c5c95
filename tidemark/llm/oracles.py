"""The queries that SQL can express, in the SQL of another engine."""

from __future__ import annotations

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[s:s + least(len(w), 10) - 1], ' ') FOR s IN range(1, len(w) - least(len(w), 10) + 2)]) AS gram
  FROM i WHERE len(w) > 0
),
ns AS (SELECT DISTINCT n FROM g),
dw AS (
  SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS s, unnest([array_to_string(w[s:s + n - 1], ' ') FOR s IN range(1, len(w) - n + 2)]) AS gram
  FROM d, ns WHERE len(w) >= n
),
h AS (SELECT rid, s, n, item_id FROM dw JOIN g USING (n, gram)),
p AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS place FROM h) GROUP BY rid),
q AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN q USING (rid)
"""

_TOKENS = "list_filter(regexp_split_to_array(line, '[ \\t\\x0B\\f\\r]+'), lambda t: t <> '')"
_STRETCH = "array_to_string(m[3 + CAST(floor((n - 2) * {i} / 5.0) AS INT):2 + CAST(floor((n - 2) * {j} / 5.0) AS INT)], ' ')"
_OPEN = ", ".join(
    "'open {i} ' || n || ' ' || array_to_string(m[1:2], ' ') || ' | ' || {rest}".format(
        i=i, rest=" || ' | ' || ".join(_STRETCH.format(i=k, j=k + 1) for k in range(5) if k != i)
    )
    for i in range(5)
)

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(range(0, len(ls))) AS place, unnest(ls) AS line FROM d),
t AS (SELECT rid, doc_id, place, list_transform({_TOKENS}, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS m FROM l),
u AS (SELECT *, len(m) AS n FROM t WHERE doc_id IS NOT NULL AND len(m) > 0),
k AS (
  SELECT rid, doc_id, place, 'whole ' || array_to_string(m, ' ') AS template FROM u
  UNION ALL SELECT rid, doc_id, place, unnest([{_OPEN}]) FROM u WHERE n >= 10
),
f AS (SELECT template, min(doc_id) AS first FROM k GROUP BY template),
x AS (SELECT DISTINCT rid, place FROM k JOIN f USING (template) WHERE first < doc_id),
y AS (SELECT rid, count(*) AS n FROM x GROUP BY rid),
z AS (SELECT rid, string_agg(line, chr(10) ORDER BY place) AS kept FROM l ANTI JOIN x USING (rid, place) GROUP BY rid)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS text_sha256
FROM d LEFT JOIN y USING (rid) LEFT JOIN z USING (rid)
"""

LM_SCORE = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> '') AS w
  FROM documents
),
p AS (SELECT rid, unnest([chr(2)] || w[:-2]) AS a, unnest(w) AS b FROM d WHERE len(w) > 0),
u AS (
  SELECT word, count(*) AS n FROM (SELECT b AS word FROM p UNION ALL SELECT chr(2) FROM d WHERE len(w) > 0) GROUP BY word
),
t AS (SELECT sum(n) AS words FROM u WHERE word <> chr(2)),
c AS (SELECT a, b, count(*) AS n FROM p GROUP BY a, b),
s AS (
  SELECT p.rid, count(*) AS n_words, count(*) FILTER (WHERE c.n < 2) AS n_backed_off,
    avg(CASE WHEN c.n >= 2 THEN ln(c.n / x.n) ELSE ln(0.4 * y.n / t.words) END) AS score
  FROM p JOIN c USING (a, b) JOIN u x ON x.word = p.a JOIN u y ON y.word = p.b, t GROUP BY p.rid
)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_backed_off, 0) AS BIGINT) AS n_backed_off,
  round(score, 6) AS mean_log_score
FROM d LEFT JOIN s USING (rid)
"""

QUOTES = """
WITH RECURSIVE m AS (
  SELECT conv_id || '/' || turn AS id, turn AS sent, trim(coalesce(text, ''), chr(10)) AS own,
    lag(coalesce(text, ''), 1) OVER w AS q1, lag(coalesce(text, ''), 2) OVER w AS q2
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)
),
n AS (
  SELECT *, nullif(trim(regexp_replace(own, '\\s+', ' ', 'g')), '') AS own_n, nullif(trim(regexp_replace(q1, '\\s+', ' ', 'g')), '') AS q1_n,
    nullif(trim(regexp_replace(q2, '\\s+', ' ', 'g')), '') AS q2_n FROM m
),
o AS (
  SELECT own_n, coalesce(q1_n, '') AS q1_n, min((sent, id)) AS place FROM n WHERE own_n IS NOT NULL GROUP BY ALL
),
l AS (
  SELECT n.*, CASE WHEN o.place < (n.sent, n.id) THEN o.place[2] END AS parent
  FROM n LEFT JOIN o ON o.own_n = n.q1_n AND o.q1_n = coalesce(n.q2_n, '')
),
r AS (
  SELECT id, id AS thread, 0 AS depth FROM l WHERE parent IS NULL
  UNION ALL SELECT l.id, r.thread, r.depth + 1 FROM l JOIN r ON l.parent = r.id
)
SELECT id, thread, parent, CAST(depth AS BIGINT) AS depth, CAST((q1 IS NOT NULL)::INT + (q2 IS NOT NULL)::INT AS BIGINT) AS n_levels,
  sha256(own) AS own_sha256
FROM l JOIN r USING (id)
"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w)) AS words FROM d WHERE len(w) > 0),
q AS (SELECT iid, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS iid, item_id, list_distinct({_TERMS}) AS w FROM benchmark)),
v AS (SELECT DISTINCT term FROM q),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) JOIN v USING (term) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY term, docs),
m AS (SELECT rid, doc_id, 10 + (90 * len(w) * docs) // words AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT term, rid, doc_id, weight * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS share FROM t JOIN f USING (term) JOIN m USING (rid)),
r AS (SELECT iid, item_id, rid, doc_id, CAST(sum(share) AS BIGINT) AS score FROM q JOIN x USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) <= 10
"""

#: CRC-32 bit by bit: a byte is mixed in, then eight steps (-1) follow.
_BYTES = "flatten(list_transform(string_split({0}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"
_STEPS = "flatten(list_transform({0}, lambda b: [CAST(b AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC = "xor(list_reduce([CAST(4294967295 AS BIGINT)] || {0}, lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), CAST(4294967295 AS BIGINT))"

SPELLING = f"""
WITH RECURSIVE t AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
),
r AS (SELECT doc, run, count(*) AS k FROM t WHERE length(run) >= 5 GROUP BY ALL),
h AS (SELECT run, k, {_CRC.format(_STEPS.format(_BYTES.format("(doc || ':' || run)")))} AS h FROM r),
w AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM h
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
),
g AS (SELECT word, n, p, substring(word, 1, p) || substring(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM w)),
e AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM g a JOIN g b USING (p, rest) WHERE a.word <> b.word
  UNION SELECT w.word, g.word, g.n FROM w JOIN g ON g.rest = w.word
  UNION SELECT g.word, w.word, w.n FROM w JOIN g ON g.rest = w.word
),
b AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM e GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
  FROM w LEFT JOIN b USING (word)
),
z AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, z.root FROM f JOIN z ON f.form = z.word
)
SELECT word, form, root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN z USING (word)
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_quotes": QUOTES,
    "op6_decontamination": DECONTAMINATION,
    "op9_lm_score": LM_SCORE,
    "op12_ranked_search": LEXICAL,
    "op13_spelling_variants": SPELLING,
}
