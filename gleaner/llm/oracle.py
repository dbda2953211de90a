"""DuckDB counterparts of the registered queries that SQL can express.

Left out: packing, training order and language identification, which SQL has no form for, and the Jaccard join, whose
transitive closure over all pairs is too slow in SQL on whole tables. Those are tested against brute force.
"""

from __future__ import annotations

from gleaner.llm import quality
from gleaner.llm.queries import TRAP, URL_RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACED = r"[^\x20\x09-\x0D]+"
_LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str = _SPACED) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_words('text')} AS words FROM documents),
     p AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
     g AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS gram FROM p),
     least_doc AS (SELECT gram, min(doc_id) AS least FROM g GROUP BY gram),
     gone AS (SELECT DISTINCT doc_id, i + j AS at FROM g JOIN least_doc USING (gram), range(0, 13) t(j) WHERE least < doc_id),
     kept AS (
       SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.at) AS text, count(*) AS n
       FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM w) x
       ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.at = gone.at GROUP BY x.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

_TRAP = TRAP.replace("'", "''")
CHAT = f"""
WITH turns AS (
       SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
       UNION ALL SELECT -7, 0, 'user', '{_TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{_TRAP}'),
     sized AS (
       SELECT *, length(replace(replace(replace(role, '\\', '\\\\'), '<', '\\<'), '"', '\\"')) AS role_chars,
              length(replace(replace(text, '\\', '\\\\'), '<', '\\<')) AS text_chars
       FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + role_chars + 3 + text_chars + 8)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_CUTOFFS = ", ".join(f"('{name}', {place}, {cutoff}::DOUBLE)" for name, cutoffs in quality.CUTOFFS.items() for place, cutoff in enumerate(cutoffs))
_FEATURES = " UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, '{name}' AS feature, {name} AS value FROM f" for name in quality.CUTOFFS)
_RISK = quality.RISK


def _share(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END"


QUALITY = f"""
WITH w AS (
       SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, {_words('text')} AS words,
              list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
       FROM documents),
     p AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8),
     g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM p),
     twice AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
     rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g JOIN twice USING (doc_id, gram), range(0, 8) t(j) GROUP BY doc_id),
     c AS (
       SELECT w.doc_id, stratum, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
              length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
              coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
              length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks
       FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
     f AS (
       SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
              {_share('n_symbols', 'n_words')} AS symbols_per_word, {_share('n_dup_lines', 'n_lines')} AS dup_line_share,
              {_share('n_repeat_words', 'n_words')} AS repeat_share, {_share('n_upper', 'word_chars')} AS upper_share,
              {_share('n_marks', 'n_words')} AS marks_per_word
       FROM c),
     v AS ({_FEATURES}),
     cuts(feature, place, cutoff) AS (VALUES {_CUTOFFS}),
     n AS (
       SELECT stratum, v.feature, place, cutoff, sum(quality) AS good, sum(CASE WHEN value > cutoff THEN quality ELSE 0 END) AS good_out,
              sum(CASE WHEN value > cutoff THEN 1 - quality ELSE 0 END) AS bad_out
       FROM v JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) USING (doc_id) JOIN cuts ON cuts.feature = v.feature
       WHERE NOT base_failed GROUP BY ALL),
     t AS (
       SELECT *, CASE WHEN good_out > good * {_RISK} THEN 1.0 ELSE list_sum(list_transform(range(0, good_out::BIGINT + 1),
                lambda i: exp(CASE WHEN good = 0 THEN 0 ELSE lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) END + i * ln({_RISK}) + (good - i) * ln(1 - {_RISK})))) END
              <= {quality.ERROR} / (SELECT count(DISTINCT (stratum, feature)) FROM n) AS passed
       FROM n),
     s AS (SELECT *, min(CASE WHEN passed THEN NULL ELSE place END) OVER (PARTITION BY stratum, feature) AS stop FROM t),
     best AS (
       SELECT stratum, feature, arg_max(cutoff, (bad_out - {quality.GOOD_COST} * good_out) * 100 - place) AS cutoff FROM s
       WHERE (stop IS NULL OR place < stop) AND bad_out > {quality.GOOD_COST} * good_out GROUP BY stratum, feature),
     broken AS (SELECT DISTINCT doc_id FROM v JOIN best USING (stratum, feature) WHERE value > cutoff)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND broken.doc_id IS NULL) AS kept
FROM f LEFT JOIN broken ON f.doc_id = broken.doc_id
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
#: The pages hold no canonical or refresh links, so alias groups are the same-page forms.
URLS = f"""
WITH parsed AS (
       SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
              list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS asked
       FROM pages),
     formed AS (
       SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
              || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS form
       FROM parsed),
     rules(h, p, v) AS (VALUES {_RULES}),
     best AS (
       SELECT url, max(struct_pack(n := length(h || p), allow := v = 'allow', rule := h || p, v := v)) AS b
       FROM (SELECT DISTINCT url, host, path FROM parsed) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
       GROUP BY url),
     ruled AS (SELECT formed.*, b.rule AS rule, b.v AS says FROM formed LEFT JOIN best ON formed.url = best.url),
     passed AS (SELECT form FROM ruled WHERE rule IS NOT NULL GROUP BY form HAVING bool_or(says = 'block') AND NOT bool_or(says = 'allow'))
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN passed.form IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN passed ON ruled.form = passed.form
"""


def _lettered(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{_LETTERED}')"


DECONTAMINATE = f"""
WITH items AS (SELECT item_id, {_lettered('text')} AS words FROM benchmark),
     grams AS (
       SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS gram
       FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)),
     docs AS (SELECT doc_id, {_lettered('text')} AS words FROM documents),
     sizes AS (SELECT DISTINCT size FROM grams),
     places AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes WHERE len(words) >= size)),
     hits AS (SELECT doc_id, item_id, size, i FROM places JOIN grams USING (size, gram)),
     n AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, range(0, 10) t(j) WHERE j < size GROUP BY doc_id),
     names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT docs.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN n ON docs.doc_id = n.doc_id LEFT JOIN names ON docs.doc_id = names.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     m AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes < 1000 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 1000 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM m
"""

HARD_NEGATIVES = """
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
     s AS (SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
           FROM r AS a JOIN r ON a.id % 100 = 0 AND a.id <> r.id),
     p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""

PHRASES = f"""
WITH pieces AS (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
       FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
     placed AS (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, range(1, 5) AS t(m) WHERE len(words) >= m),
     f AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 30),
     c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m >= 2),
     cuts AS (
       SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
       FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
       JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:k], ' ')
       JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(words[k + 1:], ' ')
       QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
     inner_phrases AS (
       SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, max(a) AS longer
       FROM (SELECT lang, words, a, size, unnest(range(1, m - size + 2)) AS i FROM c, range(2, 4) AS t(size) WHERE size < m) GROUP BY ALL),
     n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM cuts JOIN n USING (lang) LEFT JOIN inner_phrases USING (lang, phrase)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op3_substring_dedup": SUBSTRING,
    "op4_chat_format": CHAT,
    "op6_quality_rules": QUALITY,
    "op7_url_filter": URLS,
    "op9_decontaminate": DECONTAMINATE,
    "op10_warc": WARC,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_phrases": PHRASES,
}
