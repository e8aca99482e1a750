"""DuckDB SQL of the registered queries that SQL can express."""

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

EXACT_DEDUP = f"""
WITH d AS (
  SELECT doc_id, sha256({_NORM}) AS text_sha256, length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256, true AS is_new
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

_PIECE = r"[.,;:!?\x0A-\x0D]"

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '{_PIECE}')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, h.k AS cut, h.n AS l, t.n AS r,
         2000000::HUGEINT * c.a // (h.n + t.n) AS score
  FROM c JOIN f AS h ON h.lang = c.lang AND h.k < c.k AND h.phrase = array_to_string(c.w[1:h.k], ' ')
         JOIN f AS t ON t.lang = c.lang AND t.k = c.k - h.k
                    AND t.phrase = array_to_string(c.w[h.k + 1:c.k], ' ')),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
spots AS (SELECT lang, k, w, a, unnest(range(1, k)) AS i FROM c WHERE k > 2),
around AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM spots, (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY 1, 2),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM scored AS s LEFT JOIN around AS o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * s.a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op13_phrase_collocations": COLLOCATIONS,
}
