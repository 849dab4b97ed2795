"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from marginflow.llm.queries import URL_RULES

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPLIT = r"""list_filter(string_split_regex(coalesce(translate(text, {az}), ''),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')""".format(az=_AZ)

ORACLE: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
        WITH d AS MATERIALIZED (SELECT doc_id, {_SPLIT} AS w FROM documents),
        b AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
        win AS MATERIALIZED (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        dw AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        hit AS MATERIALIZED (SELECT doc_id, i, dw.n, item_id FROM dw JOIN win ON dw.g = win.g AND dw.n = win.n),
        n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_url_filters": f"""
        WITH p AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_AZ}) AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        r(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
        fit AS (
            SELECT page_id, r.host || r.path AS rule, verdict, row_number() OVER (
                   PARTITION BY page_id ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS k
            FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
        SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
        FROM p LEFT JOIN fit ON fit.page_id = p.page_id AND fit.k = 1""",
    "op11_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       coalesce(translate(text, {_AZ}), ''), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, k, phrase, count(*) AS n
              FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k)))
              GROUP BY ALL),
        total AS (SELECT lang, sum(n)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
        known AS MATERIALIZED (SELECT lang, k, phrase, n, string_split(phrase, ' ') AS w FROM g WHERE n >= 10),
        cut AS (SELECT lang, k, phrase, n AS a, w, unnest(range(1, k)) AS c FROM known WHERE k > 1),
        score AS (
            SELECT cut.lang, cut.phrase, a, l.n AS l, r.n AS r, c,
                   ((1000000::HUGEINT * a * a) // (l.n::HUGEINT * r.n))::BIGINT AS score
            FROM cut JOIN known l ON l.lang = cut.lang AND l.phrase = array_to_string(cut.w[1:c], ' ')
                     JOIN known r ON r.lang = cut.lang AND r.phrase = array_to_string(cut.w[c + 1:], ' ')),
        best AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
        longer AS (SELECT lang, part, max(n) AS most FROM (
                       SELECT lang, n, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
                       FROM known WHERE k = 3) GROUP BY ALL)
        SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, total.n, score
        FROM best JOIN total USING (lang) LEFT JOIN longer ON longer.lang = best.lang AND longer.part = best.phrase
        WHERE coalesce(100 * most < 50 * a, true)
        QUALIFY rank <= 2000""",
}
