"""DuckDB SQL for the operators that it can express whole."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 by its table, one step a byte; words near each other share a text with one place masked or taken out
OP11 = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, step:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY doc_id, run),
coded AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS code FROM counted),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(length(code) // 2 AS BIGINT)),
    lambda i: CAST('0x' || code[2 * i + 1:2 * i + 2] AS BIGINT))), lambda c, byte: xor(c >> 8, t[(xor(c, byte) & 255) + 1])), 4294967295) AS h
  FROM coded, crc_table),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, times FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled GROUP BY word HAVING length(word) >= 5 AND sum(times) >= 3),
places AS (SELECT word, n, unnest(range(length(word))) AS p FROM words),
masked AS (SELECT word, n, word[:p] || '*' || word[p + 2:] AS mask, word[:p] || word[p + 2:] AS rest FROM places),
shorter AS (SELECT DISTINCT word, n, rest FROM masked),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON w.word = s.rest
  UNION ALL SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON w.word = s.rest),
best AS (
  SELECT word, n, count(*) AS n_near, min(struct_pack(minus := -other_n, other := other)) AS b FROM near GROUP BY word, n),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.minus >= 2 * w.n THEN b.other END AS form,
    CASE WHEN -b.minus >= 2 * w.n THEN -b.minus END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""

OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS size FROM lists),
placed AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM sized),
f AS (
  SELECT lang, size, w[p:p + size - 1] AS words, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, size, words, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scores AS (
  SELECT c.*, x.f AS l, y.f AS r, t.n, (1000 * CAST(a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.words = c.words[:k] JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1:]
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
  SELECT lang, words[s:s + inner_size - 1] AS words, max(f) AS f FROM (
    SELECT lang, words, f, size, inner_size, unnest(range(1, size - inner_size + 2)) AS s FROM (
      SELECT *, unnest(range(2, size)) AS inner_size FROM f WHERE size > 2)) GROUP BY 1, 2),
kept AS (
  SELECT z.*, array_to_string(z.words, ' ') AS phrase FROM lowest z LEFT JOIN inside i ON i.lang = z.lang AND i.words = z.words
  WHERE i.f IS NULL OR 100 * i.f < 100 * z.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
places AS (SELECT row, id, w, unnest(range(1, len(w) - 11)) AS p FROM d),
windows AS (SELECT row, id, p, array_to_string(w[p:p + 12], ' ') AS words FROM places),
later AS (SELECT row, p FROM (SELECT *, min(id) OVER (PARTITION BY words) AS least FROM windows) WHERE least < id),
gone AS (SELECT DISTINCT row, unnest(range(p, p + 13)) AS p FROM later),
single AS (SELECT row, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n FROM single ANTI JOIN gone USING (row, p) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""
