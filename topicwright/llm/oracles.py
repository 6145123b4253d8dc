"""SQL for DuckDB with the rows of each query that SQL can express."""

from topicwright.llm.licenses import RULES, SENTENCES, plain
from topicwright.llm.url_filter import CLOSE, DAMPING, STEPS, THRESHOLD

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ", ".join(f"{_quoted(plain(text))}: {_quoted(name)}" for name, text in SENTENCES.items())
_SPELLED = {"".join(f"<{x}>" for x in rule): name for name, rule in RULES}
_NAMES = ", ".join(f"{_quoted(rule)}: {_quoted(name)}" for rule, name in _SPELLED.items())
_LONGEST_FIRST = "|".join(sorted(_SPELLED, key=lambda s: (-s.count("<"), s)))
_NORMALISED = "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))"

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLES = {
    # The ranks are the sums over all paths of links, step by step.
    "op2_url_filter": rf"""
        WITH RECURSIVE parts AS (
            SELECT page_id, html,
                   translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ), judged AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM parts
        ), said AS (
            SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said
            FROM judged
        ), targets AS (
            SELECT DISTINCT page_id, host AS source, translate(unnest(regexp_extract_all(
                html, '(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
            FROM said
        ), links AS (
            SELECT source, target, count(*) AS pages FROM targets
            WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL
        ), flow AS (
            SELECT source AS a, target AS b, pages / sum(pages) OVER (PARTITION BY source) AS share, 'allow' AS kind FROM links
            UNION ALL SELECT target, source, pages / sum(pages) OVER (PARTITION BY target), 'block' FROM links
        ), paths AS (
            SELECT 0 AS step, host, k.kind, avg((coalesce(said, '') = k.kind)::INT) AS value
            FROM said, (VALUES ('allow'), ('block')) k(kind) WHERE host <> '' GROUP BY ALL
            UNION ALL
            SELECT step + 1, flow.b, paths.kind, sum({DAMPING} * value * share)
            FROM paths JOIN flow ON flow.a = paths.host AND flow.kind = paths.kind
            WHERE step < {STEPS} AND value > {CLOSE} / 100 GROUP BY step + 1, flow.b, paths.kind
        ), sums AS (
            SELECT host, coalesce(sum(value) FILTER (kind = 'allow'), 0) AS trust, coalesce(sum(value) FILTER (kind = 'block'), 0) AS distrust
            FROM paths GROUP BY host
        ), seeds AS (
            SELECT host, avg((coalesce(said, '') = 'block')::INT) AS bad FROM said WHERE host <> '' GROUP BY host
        ), alone AS (
            SELECT source AS host, {DAMPING} * sum(pages * coalesce(bad, 0)) / sum(pages) AS alone
            FROM links LEFT JOIN seeds ON seeds.host = target GROUP BY source
        ), ranks AS (
            SELECT host, greatest(distrust, coalesce(bad, 0) + coalesce(alone, 0)) - trust >= {THRESHOLD} AS blocked
            FROM sums LEFT JOIN seeds USING (host) LEFT JOIN alone USING (host)
        )
        SELECT page_id, host, path, rule,
               coalesce(said, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
        FROM said LEFT JOIN ranks USING (host)
    """,
    "op3_license_scan": rf"""
        WITH cut AS (
            SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''),
                '([.!?;:])[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'), '\n[ \t\n\x0B\f\r]*\n', chr(1), 'g'), chr(1)) AS parts,
                MAP {{{_KNOWN}}} AS known
            FROM documents
        ), ids AS (
            SELECT doc_id, flatten(list_transform(parts, lambda s:
                CASE WHEN known[{_NORMALISED.format('s')}] IS NOT NULL THEN [known[{_NORMALISED.format('s')}]]
                ELSE flatten(list_transform(string_split_regex(s, '\n(?:[^\p{{L}}\p{{N}}\n]*\n)+'), lambda p:
                    CASE WHEN known[{_NORMALISED.format('p')}] IS NOT NULL THEN [known[{_NORMALISED.format('p')}]]
                    ELSE list_filter(list_transform(string_split(p, chr(10)), lambda l: known[{_NORMALISED.format('l')}]),
                                     lambda x: x IS NOT NULL) END)) END)) AS sentences
            FROM cut
        ), taken AS (
            SELECT *, regexp_extract_all(array_to_string(list_transform(sentences, lambda x: '<' || x || '>'), ''),
                                         '{_LONGEST_FIRST}') AS taken
            FROM ids
        )
        SELECT doc_id, coalesce(list_sort(list_distinct(list_transform(taken, lambda t: MAP {{{_NAMES}}}[t]))), []) AS licenses,
               sentences,
               (len(sentences) - coalesce(list_sum(list_transform(taken, lambda t: len(t) - len(replace(t, '<', '')))), 0))::INT AS unexplained
        FROM taken
    """,
    "op7_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256({LOWER}) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY {LOWER})
    """,
    "op8_ngram_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
            FROM words
        ), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common >= 80 * (x.n + y.n - common)
        ), ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reached.a, ends.b FROM reached JOIN ends ON ends.a = reached.b
        )
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN sizes s USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) c USING (doc_id)
    """,
    "op11_lexical_search": f"""
        WITH docs AS (
            SELECT *, len(terms) AS n
            FROM (SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents) WHERE len(terms) > 0
        ), total AS (SELECT count(*) AS number, CAST(sum(n) AS BIGINT) AS length FROM docs),
        tf AS (SELECT place, term, count(*) AS times FROM (SELECT place, unnest(terms) AS term FROM docs) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(number) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total GROUP BY term
        ), asked AS (
            SELECT item_id, text, term, count(*) AS times
            FROM (SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY ALL
        ), scored AS (
            SELECT item_id, text, place, doc_id, CAST(sum(asked.times * w * ((1000000000 * tf.times)
                // (1000 * tf.times + 8 * (25 + (75 * n * number) // length)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (place), total GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS place_of
            FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(place_of AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place_of <= 10
    """,
}
