"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from daybook.llm.licence_digests import DIGESTS
from daybook.llm.licences import COPYRIGHT_LINE, COPYRIGHT_PART, LICENCES, NOTICES, PUNCTUATION, SPELLINGS, UPPER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    x = f"translate({column}, '{UPPER}', '{UPPER.lower()}')"
    x = f"regexp_replace({x}, {_text(COPYRIGHT_PART)}, '\\2', 'g')"
    x = f"regexp_replace({x}, {_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    x = f"regexp_replace({x}, {_text(PUNCTUATION)}, ' ', 'g')"
    for other, usual in SPELLINGS:
        x = f"replace({x}, '{other}', '{usual}')"
    return f"trim(regexp_replace({x}, '  +', ' ', 'g'))"


def _known(texts) -> str:
    rows = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in texts)
    return f"SELECT sha256({_canonical('text')}) AS digest, min(license) AS license FROM (VALUES {rows}) AS t(license, text) GROUP BY 1"


_LICENSE_SCAN = f"""
WITH licences AS ({_known(LICENCES)} UNION ALL SELECT * FROM (VALUES {", ".join(f"('{d}', '{n}')" for n, d in DIGESTS)}) AS t(digest, license)), notices AS ({_known(NOTICES)}),
docs AS (SELECT doc_id, text, sha256({_canonical("text")}) AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
named AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM lines WHERE regexp_matches(line, '(?i)licen')) JOIN notices USING (digest)
  GROUP BY doc_id
)
SELECT doc_id, digest, license, notices FROM docs LEFT JOIN licences USING (digest) LEFT JOIN named USING (doc_id)
"""

_WARC = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM r
"""

_TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, d.v)]) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

_SUBSTRING = r"""
WITH d AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents
), w AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 19)) AS start, words FROM d WHERE len(words) >= 20
), h AS (SELECT doc_id, start, array_to_string(list_slice(words, start, start + 19), ' ') AS win FROM w
), r AS (SELECT doc_id, start, row_number() OVER (PARTITION BY win ORDER BY doc_id, start) AS nth FROM h
), gone AS (SELECT DISTINCT doc_id, start + k AS place FROM r, (SELECT unnest(generate_series(0, 19)) AS k) WHERE nth > 1
), u AS (SELECT doc_id, unnest(generate_series(1, len(words))) AS place, unnest(words) AS word FROM d WHERE len(words) > 0
), kept AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone.place IS NULL) AS kept, count(gone.place) AS n_removed
  FROM u LEFT JOIN gone USING (doc_id, place) GROUP BY u.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LEXICAL = rf"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL
), c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term
), m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n, c
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""

_SPELLING = rf"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) FOR b IN range(256)] AS crc
), t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS line, run, count(*) AS n FROM t GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten([CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END
    FOR c IN string_split(line, '')]) AS b FROM d
), h AS (
  SELECT run, n, xor(4294967295, list_reduce(b, lambda c, x: xor(crc[1 + (xor(c, x) & 255)], c >> 8), CAST(4294967295 AS BIGINT))) AS h FROM bytes, crc
), changed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM words
), less AS (SELECT word, place, substr(word, 1, place - 1) || substr(word, place + 1) AS part FROM places
), near AS (
  SELECT l.word, w.word AS other FROM less l JOIN words w ON l.part = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.part = w.word
  UNION SELECT l.word, r.word FROM less l JOIN less r ON l.place = r.place AND l.part = r.part AND l.word <> r.word
), best AS (
  SELECT near.word, other, n, row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS nth, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words ON words.word = other
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN other END AS form, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM best WHERE nth = 1) b ON b.word = w.word
), steps AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON steps.root = forms.word WHERE forms.form IS NOT NULL
), last AS (SELECT word, root FROM steps WHERE root NOT IN (SELECT word FROM forms WHERE form IS NOT NULL))
SELECT forms.word, form, coalesce(root, forms.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms LEFT JOIN last ON last.word = forms.word
"""

_NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(list_slice(words, i, i + 3), ' ') FOR i IN range(1, greatest(2, len(words) - 2))]) AS gram FROM d WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""

ORACLES = {
    "op3_warc": _WARC, "op4_license_scan": _LICENSE_SCAN, "op7_topk": _TOPK, "op8_substring_dedup": _SUBSTRING, "op11_lexical_search": _LEXICAL,
    "op12_spelling_variants": _SPELLING, "op13_ngram_join": _NGRAM_JOIN,
}
