"""SQL of the registered queries, for those that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


LEAKS = f"""
WITH doc AS (SELECT doc_id, {_words("text")} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS size FROM item WHERE len(w) > 0),
spot AS (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized),
win AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM spot),
place AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size
),
seen AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM place),
found AS (SELECT doc_id, item, size, i FROM seen JOIN win USING (size, s)),
-- Items without an id hit; only their name is left out.
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def url_rules(rules: list[tuple[str, str, str]]) -> str:
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH rule(verdict, h, p) AS (VALUES {listed}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
url AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
fit AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM url JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM url LEFT JOIN fit USING (page_id)
"""


#: Base 32 of a hex digest: five hex digits are twenty bits, four characters.
CAPTURES = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
first AS (SELECT h, min(page_id) AS first FROM page GROUP BY h),
quad AS (
  SELECT h, g, CAST('0x' || substr(h, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT) AS n FROM first, range(8) AS r(g)
),
named AS (
  SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n // (32 ** (3 - c))::BIGINT) % 32 + 1, 1), '' ORDER BY g, c) AS digest
  FROM quad, range(4) AS s(c) GROUP BY h
)
SELECT page_id, payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM page JOIN first USING (h) JOIN named USING (h)
"""


def quality_rules(
    common: list[str], least: dict[str, int], spreads: dict[str, int], least_spreads: dict[str, int], min_judged: int, min_words: int
) -> str:
    listed = ", ".join(f"'{w}'" for w in common)
    kept = {
        "symbol": "[^#*$%&|<>]+",
        "upper": "[^A-Z]+",
        "digit": "[^0-9]+",
        "mark": r"[^!-/:-@\[-`{-~]+",
        "beyond": r"[\x00-\x7F]+",
        "space": r"[^\x20\x09-\x0D]+",
    }
    counts = ", ".join(f"length(regexp_replace(t, '{p}', '', 'g')) AS {c}" for c, p in kept.items())

    def distance(histogram: str) -> str:
        part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
        both = part.format("p", "q") + " + " + part.format("q", "p")
        return f"""
          SELECT doc_id, sqrt(greatest(sum({both}) / 2, 0)) AS distance FROM (
            SELECT doc_id, n / greatest(sum(n) OVER d, 1) AS p, rest / greatest(sum(rest) OVER d, 1) AS q
            FROM {histogram}_rest WINDOW d AS (PARTITION BY doc_id)
          ) GROUP BY doc_id
        """

    def limit(half: str, key: str) -> str:
        return f"""
          SELECT {key} any_value(total) AS total, (min(bin) FILTER (WHERE below * 2 >= total) + {spreads[half]} * greatest(
            min(bin) FILTER (WHERE below * 4 >= 3 * total) - min(bin) FILTER (WHERE below * 2 >= total), {least_spreads[half]}) + 1)
            * 0.001 AS cap
          FROM (
            SELECT {key} bin, sum(count(*)) OVER (PARTITION BY {key or '1,'} 1 ORDER BY bin) AS below,
              sum(count(*)) OVER (PARTITION BY {key or '1,'} 1) AS total
            FROM (SELECT lang, CAST(floor({half}_distance / 0.001) AS bigint) AS bin FROM far WHERE {half}_judged)
            GROUP BY {key} bin
          ) {"GROUP BY lang" if key else ""}
        """

    return f"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT doc_id, lang, t, length(t) AS n_chars, {counts},
    list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split_regex(lower(t), '[^\\pL]+'), lambda x: x IN ({listed})) AS known,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM doc
),
win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM cut)
),
twice AS (SELECT doc_id, s FROM win GROUP BY 1, 2 HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM win JOIN twice USING (doc_id, s)) GROUP BY 1
),
base AS (
  SELECT cut.*, CAST(len(w) AS BIGINT) AS n_words, n_chars - space AS word_chars, symbol AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN repeats USING (doc_id)
),
chars AS (
  UNPIVOT (
    SELECT doc_id, lang, n_chars - space - upper - digit - mark - beyond AS lower, upper, digit,
      mark - symbol AS plain, symbol, space, beyond FROM base
  ) ON lower, upper, digit, plain, symbol, space, beyond INTO NAME class VALUE n
),
chars_ref AS (SELECT lang, class, sum(n) AS n FROM chars GROUP BY 1, 2),
chars_all AS (SELECT class, sum(n) AS n FROM chars GROUP BY 1),
sizes AS (
  SELECT doc_id, sum(n_words) OVER (PARTITION BY lang) - n_words < {min_words} AS few FROM base
),
chars_rest AS (
  SELECT doc_id, c.n, CASE WHEN few THEN a.n ELSE r.n END - c.n AS rest
  FROM chars c JOIN sizes USING (doc_id) JOIN chars_ref r USING (lang, class) JOIN chars_all a USING (class)
),
listed AS (
  SELECT doc_id, lang, class, CAST(len(list_filter(known, lambda x: x = class)) AS BIGINT) AS n
  FROM base, (SELECT unnest([{listed}]) AS class)
),
listed_ref AS (SELECT lang, class, sum(n) AS n FROM listed GROUP BY 1, 2),
listed_all AS (SELECT class, sum(n) AS n FROM listed GROUP BY 1),
listed_rest AS (
  SELECT doc_id, c.n, CASE WHEN few THEN a.n ELSE r.n END - c.n AS rest
  FROM listed c JOIN sizes USING (doc_id) JOIN listed_ref r USING (lang, class) JOIN listed_all a USING (class)
),
words_of AS (
  SELECT doc_id, n_words, CASE WHEN few THEN sum(n_words) OVER () ELSE sum(n_words) OVER (PARTITION BY lang) END - n_words AS others
  FROM base JOIN sizes USING (doc_id)
),
words_rest AS (
  SELECT doc_id, n, rest FROM listed_rest UNION ALL
  SELECT doc_id, greatest(any_value(n_words) - sum(n), 0), greatest(any_value(others) - sum(rest), 0)
  FROM words_of JOIN listed_rest USING (doc_id) GROUP BY doc_id
),
char_far AS ({distance("chars")}),
word_far AS ({distance("words")}),
far AS (
  SELECT base.*, char_far.distance AS char_distance, word_far.distance AS word_distance,
    n_chars >= {least["char"]} AS char_judged, n_words >= {least["word"]} AS word_judged,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM base JOIN char_far USING (doc_id) JOIN word_far USING (doc_id)
),
char_own AS ({limit("char", "lang,")}),
word_own AS ({limit("word", "lang,")}),
char_pool AS ({limit("char", "")}),
word_pool AS ({limit("word", "")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND NOT (char_judged AND char_distance > coalesce(char_own.cap, char_pool.cap, 1.0))
    AND NOT (word_judged AND word_distance > coalesce(word_own.cap, word_pool.cap, 1.0)) AS kept,
  round(char_distance, 6) AS char_distance, round(word_distance, 6) AS word_distance
FROM far LEFT JOIN char_own ON far.lang = char_own.lang AND char_own.total >= {min_judged}
  LEFT JOIN word_own ON far.lang = word_own.lang AND word_own.total >= {min_judged}
  LEFT JOIN char_pool ON true LEFT JOIN word_pool ON true
"""


#: Every document's score for every item, then the ten best of each.
RANKED = """
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
corpus AS (
  SELECT count(*) FILTER (WHERE len(words) > 0) AS n_docs, CAST(sum(len(words)) AS bigint) AS total FROM doc
),
held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM doc) GROUP BY r, term
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS double) / CAST(2 * count(*) + 1 AS double))) AS bigint) AS w
  FROM held, corpus GROUP BY term, n_docs
),
damped AS (
  SELECT r, doc_id, 100 - 90 + (90 * CAST(len(words) AS bigint) * n_docs) // total AS m FROM doc, corpus WHERE len(words) > 0
),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS bigint) AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN damped USING (r)
  GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS int) AS rank,
  doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

#: All anchors scored against all rows.
HARD_NEGATIVES = """
WITH vec AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS double))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS bigint) AS score
  FROM vec a JOIN vec r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS int) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
