"""The numbered queries in SQL, where it can express them.

Tokenizer files (3 and 6) and edit distances (10) have no SQL; those queries are tested against
plain versions.
"""

from __future__ import annotations

from mercata.llm.quality import STOP_WORDS
from mercata.llm.rollups import PATTERNS
from mercata.llm.secrets import RULES
from mercata.llm.urlfilter import LOWER, SITES, UPPER

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_scan() -> str:
    """Ends of matches are running sums over the texts between them and their own lengths."""
    def hits(order: int) -> str:
        rule, pattern = RULES[order], _quoted(RULES[order].pattern)
        return (f"SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind, {rule.least} AS least, "
                f"unnest(regexp_extract_all(t, {pattern}, 0)) AS whole, "
                f"unnest(regexp_extract_all(t, {pattern}, {rule.group})) AS part, "
                f"unnest(regexp_split_to_array(t, {pattern})) AS gap, "
                f"unnest(range(len(regexp_extract_all(t, {pattern}, 0)) + 1)) AS nth FROM d")

    def joined(where: str) -> str:
        return (f"coalesce(string_agg(kind || ':' || (upto - length(whole)) || ':' || upto, ',' "
                f"ORDER BY upto - length(whole), ord) FILTER ({where}), '')")

    base = "ord < 3"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES[:3])
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({' UNION ALL '.join(map(hits, range(len(RULES))))}),
ends AS (SELECT *, CAST(sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, ord ORDER BY nth) AS BIGINT) AS upto
         FROM hits WHERE whole IS NOT NULL),
found AS (SELECT * FROM ends WHERE length(part) >= least)
SELECT d.doc_id, {counts}, sha256({joined(base)}) AS base_sha256, {joined('ord IS NOT NULL')} AS spans
FROM d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id"""


SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS seq
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
again AS (SELECT doc_id, i FROM windows
          QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS at FROM again, range(20) r(k)),
spots AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM w),
kept AS (SELECT s.doc_id, count(*) FILTER (g.at IS NOT NULL) AS n_removed,
                string_agg(s.word, ' ' ORDER BY s.at) FILTER (g.at IS NULL) AS rest
         FROM spots s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.at = s.at GROUP BY s.doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id"""

REVISITS = r"""
WITH u AS (SELECT page_id, html, split_part(trim(url), '#', 1) AS bare FROM pages),
a AS (SELECT page_id, html, CASE WHEN bare ILIKE 'http://%' OR bare ILIKE 'https://%' THEN substr(bare, strpos(bare, '://') + 3)
      END AS rest FROM u),
b AS (SELECT page_id, html, split_part(rest, '?', 1) AS address,
      CASE WHEN strpos(rest, '?') > 0 THEN string_split(substr(rest, strpos(rest, '?') + 1), '&') ELSE [] END AS args FROM a),
c AS (SELECT page_id, html, split_part(address, '/', 1) AS site, address, list_sort(list_filter(args, lambda q: q <> '' AND
      NOT regexp_full_match(q, '(utm_[a-z]+|ref|sessionid|gclid|fbclid)=.*'))) AS args FROM b),
d AS (SELECT page_id, html, CASE WHEN site <> '' THEN
      regexp_replace(regexp_replace(lower(site), '^www\.', ''), ':(80|443)$', '') || rtrim(substr(address, length(site) + 1), '/')
      || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS resource FROM c),
captures AS (SELECT page_id, crawl, page_id * 4 + crawl AS record, crawl * 1000000000 + page_id AS seen, resource,
    (page_id + crawl) % 3 <> 0 AS revisit, CAST((page_id + 13 * crawl) // 40 AS VARCHAR) AS version,
    page_id % 7 <> 0 AND page_id % 11 <> 0 AS tagged, page_id % 11 <> 0 AS dated, length(coalesce(html, '')) AS size
    FROM d, range(4) r(crawl)),
found AS (SELECT *, CASE WHEN resource IS NOT NULL THEN arg_max(record, seen) FILTER (NOT revisit) OVER (
    PARTITION BY resource ORDER BY seen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS source FROM captures),
judged AS (SELECT o.*, r.size AS full_size, CASE WHEN r.record IS NULL THEN 'orphan'
    WHEN (o.tagged AND r.tagged) OR (o.dated AND r.dated) THEN CASE WHEN o.version = r.version THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome
    FROM found o LEFT JOIN captures r ON r.record = o.source WHERE o.revisit)
SELECT page_id, crawl, resource AS url, source AS source_record, outcome, CASE WHEN outcome IN ('resolved', 'unverified') THEN
    'content-length=' || full_size || ';date=' || seen || ';etag=' || version END AS headers
FROM judged"""


def _url_filter() -> str:
    sites = ", ".join("({}, {}, {})".format(*map(_quoted, (*_halves(r.name), r.action))) for r in SITES)
    return rf"""
WITH s(site, folder, action) AS (VALUES {sites}),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1) AS tail FROM cut),
best AS (SELECT page_id, site || folder AS rule, action FROM p JOIN s
         ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, folder)
         QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(site || folder) DESC) = 1)
SELECT p.page_id, host, path, rule, coalesce(action, CASE
    WHEN regexp_matches(host || tail, '^(?:[^/?#]*\.)?(?:adult-x|ads|tracker)\.') OR contains(tail, '/banners/')
      OR regexp_matches(host || tail, '[^A-Za-z0-9_.%-]sessionid(?:[^A-Za-z0-9_.%-]|$)')
      OR ends_with(host || tail, '.exe') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best b ON b.page_id = p.page_id"""


def _halves(name: str) -> tuple[str, str]:
    site, slash, folder = name.partition("/")
    return site, slash + folder


def _rollups() -> str:
    def count(version: str) -> str:
        return f"len(regexp_extract_all(coalesce(text, ''), {_quoted(PATTERNS[version])}))"
    return f"""
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM (
    SELECT CASE WHEN l.doc_id IS NULL THEN source ELSE 'quality ' || quality END AS source, lang,
           'words_1' AS version, {count('words_1')} AS tokens
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    UNION ALL
    SELECT source, lang, 'marks_2', {count('marks_2')} FROM documents WHERE length(coalesce(text, '')) >= 200)
GROUP BY source, lang, version"""


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS seq
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
often AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, seq) > 1),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, range(5) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
    coalesce(l.n, 0) AS n_lines, coalesce(a.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda w: w IN ({', '.join(map(_quoted, STOP_WORDS))}))) AS stops,
    len(list_filter(words, lambda w: regexp_matches(w, '^(?:[#*$%&|<>]+|[^#*$%&|<>]+[#*$%&|<>]{{3,}})$'))) AS marks,
    len(list_filter(words, lambda w: ends_with(w, '!!'))) AS shouts
    FROM d LEFT JOIN again a ON a.doc_id = d.doc_id LEFT JOIN lines l ON l.doc_id = d.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR word_chars / n_words < 1.5 OR word_chars / n_words > 25
         OR (n_words >= 20 AND (n_symbols / n_words > 0.5 OR marks / n_words > 0.4 OR shouts / n_words > 0.3
                                OR n_dup_lines / n_lines > 0.75))
         OR (n_words >= 100 AND stops / n_words < 0.01)) AS kept
FROM b"""

def _jaccard(n: int) -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                       '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(words[i:i + {n - 1}], ' ') AS gram FROM
    (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {n - 2}, least(len(words), 1) + 1))) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b
           ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT x, y FROM shared s JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * s.n >= 85 * (p.n + q.n - s.n)),
reach AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""

INFILL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
           FROM documents),
h AS (SELECT doc_id, t, n, CAST('0x' || x[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || x[9:16] AS BIGINT) % (n + 1) AS b,
      CAST('0x' || x[17:24] AS BIGINT) % 100 AS c, CAST('0x' || x[25:32] AS BIGINT) % 100 AS e FROM d),
p AS (SELECT doc_id, t, n, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90
      THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form, least(a, b) AS i, greatest(a, b) AS j FROM h),
o AS (SELECT *, substr(t, 1, i) AS prefix, substr(t, i + 1, j - i) AS middle, substr(t, j + 1) AS suffix FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM o"""

SEARCH = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS words FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY doc_id, term),
c AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term
      FROM benchmark),
w AS (SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM q JOIN f USING (term), c),
m AS (SELECT doc_id, 50 + (50 * len(words) * n) // l AS m FROM d, c WHERE len(words) > 0),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM w JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""

SQL: dict[str, str] = {
    "op1_secret_scan": _secret_scan(),
    "op2_substring_dedup": SUBSTRINGS,
    "op4_revisit_resolution": REVISITS,
    "op5_url_filter": _url_filter(),
    "op7_token_rollups": _rollups(),
    "op8_quality_rules": QUALITY,
    "op9_ngram_jaccard": _jaccard(4),
    "op11_near_copies": f"SELECT *, doc_id = component_id AS kept FROM ({_jaccard(3)})",
    "op12_fill_in_middle": INFILL,
    "op13_ranked_search": SEARCH,
}
