"""DuckDB SQL with the same rows as the queries of the same name, where SQL can express them."""

from __future__ import annotations

from salesmart.llm import collocations, licenses, queries, ranked_search, url_filter

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _low(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def op2_line_dedup() -> str:
    return f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT doc_id, pos, line, {_low(f"trim(line, {_BLANKS})")} AS key FROM lines
    ), shared AS (
        SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
        GROUP BY key HAVING count(DISTINCT doc_id) > 1
    ), judged AS (
        SELECT k.doc_id, pos, line, s.key IS NOT NULL AND k.doc_id <> s.first_doc AS dropped
        FROM keyed k LEFT JOIN shared s ON k.key = s.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """


def op5_decontaminate() -> str:
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH items AS (
        SELECT item_id, {words.format(_low("coalesce(text, '')"))} AS w FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n,
               array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
    ), docs AS (
        SELECT doc_id, {words.format(_low("coalesce(text, '')"))} AS w FROM documents
    ), spans AS (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT n FROM windows)
        WHERE i + n - 1 <= len(w)
    ), hits AS (
        SELECT doc_id, i, s.n, item_id FROM spans s JOIN windows b ON s.n = b.n AND s.win = b.win
    ), marked AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs d LEFT JOIN marked m ON d.doc_id = m.doc_id LEFT JOIN named x ON d.doc_id = x.doc_id
    """


def op6_license_minhash() -> str:
    own = licenses.templates(licenses.TEMPLATES)
    rows = ", ".join(
        f"('{t.name}', {t.window[0]}, {t.window[1]}, {t.needed}, '{s}')" for t in own for s in t.shingles
    )
    return f"""
    WITH wanted(license, length, step, needed, shingle) AS (VALUES {rows}), docs AS (
        SELECT doc_id, regexp_extract_all({_low("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents WHERE text IS NOT NULL
    ), places AS (
        SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
    ), hits AS (
        SELECT doc_id, pos, license, length, step, needed, shingle FROM places JOIN wanted USING (shingle)
    ), inside AS (
        SELECT doc_id, license, needed, shingle,
               unnest(range(CAST(greatest(0, ceil((pos + 5 - length) / step)) AS BIGINT), pos // step + 1)) AS k
        FROM hits
    ), full_matches AS (
        SELECT DISTINCT doc_id, license FROM (
            SELECT doc_id, license, k, needed FROM inside GROUP BY ALL HAVING count(DISTINCT shingle) >= needed
        )
    ), named AS (
        SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names FROM full_matches GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses
    FROM documents LEFT JOIN named USING (doc_id)
    """


def op10_host_trust() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in url_filter.RULES)
    rounds = "".join(
        f"""
    , r{k + 1} AS MATERIALIZED (
        SELECT kind, host, sum(score) AS score FROM (
            SELECT kind, host, seed * {1 - url_filter.DAMPING} AS score FROM seeds
            UNION ALL
            SELECT w.kind, w.dst, share * score * {url_filter.DAMPING} FROM ways w JOIN r{k} r ON w.kind = r.kind AND w.src = r.host
        ) GROUP BY kind, host
    )"""
        for k in range(url_filter.ROUNDS)
    )
    return f"""
    WITH rules(verdict, rhost, rpath) AS (VALUES {rules}), cut AS (
        SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, html, {_low("regexp_extract(rest, '^[^/?#]*')")} AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
    ), fits AS (
        SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS ruled
        FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules
          ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
        GROUP BY page_id
    ), judged AS (
        SELECT p.page_id, html, host, path, rule, ruled FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id
    ), hosts AS (
        SELECT host, (count(*) FILTER (ruled = 'allow') > count(*) FILTER (ruled = 'block'))::INT AS trust,
               (2 * count(*) FILTER (ruled = 'block') > count(*))::INT AS distrust
        FROM judged WHERE host <> '' GROUP BY host
    ), seeds AS (
        SELECT 'trust' AS kind, host, 1.0::DOUBLE AS seed FROM hosts WHERE trust = 1
        UNION ALL SELECT 'distrust', host, 1.0 FROM hosts WHERE distrust = 1
    ), links AS (
        SELECT src, dst, count(*) AS n FROM (
            SELECT host AS src, {_low("regexp_replace(raw, '^[^@]*@', '')")} AS dst FROM (
                SELECT host, unnest(regexp_extract_all(html,
                    '(?i)\\b(?:href|src)\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s<>]+)', 1)) AS raw
                FROM judged WHERE host <> ''
            )
        ) WHERE dst <> '' AND src <> dst GROUP BY ALL
    ), both_ways AS (
        SELECT 'trust' AS kind, src, dst, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links
    ), ways AS (
        SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM both_ways
    ), r0 AS (SELECT kind, host, seed * {1 - url_filter.DAMPING} AS score FROM seeds){rounds}, spread AS (
        SELECT host FROM r{url_filter.ROUNDS} GROUP BY host
        HAVING coalesce(sum(score) FILTER (kind = 'distrust'), 0) - coalesce(sum(score) FILTER (kind = 'trust'), 0) >= {url_filter.MARGIN}
    )
    SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN s.host IS NOT NULL THEN 'block' END, 'allow') AS verdict
    FROM judged j LEFT JOIN spread s ON j.host = s.host
    """


def op11_chat_template() -> str:
    def escape(x: str) -> str:
        return f"regexp_replace({x}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"

    role = escape("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{queries.FORGED}' UNION ALL SELECT -1, 1, 'assistant', '{queries.FORGED}'
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length('<|im_start|>' || {role} || chr(10) || {escape("text")} || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
    """


def op12_ranked_search() -> str:
    terms = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, doc_id, {terms.format(_low("coalesce(text, '')"))} AS w FROM documents
    ), size AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM docs WHERE len(w) > 0), wanted AS (
        SELECT DISTINCT item_id, unnest({terms.format(_low("coalesce(text, '')"))}) AS term FROM benchmark
    ), counted AS (
        SELECT d, doc_id, n, term, count(*) AS tf
        FROM (SELECT d, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM docs)
        WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counted, size GROUP BY term, nn
    ), scored AS (
        SELECT item_id, d, doc_id,
               CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
        FROM counted JOIN weights USING (term) JOIN wanted USING (term), size GROUP BY item_id, d, doc_id
    ), ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
        FROM scored WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {ranked_search.TOP}
    """


def op13_collocations() -> str:
    longest = collocations.LONGEST
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex({_low("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ), words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces), placed AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
    ), grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM placed, range(1, {longest + 1}) AS t(k) WHERE i + k - 1 <= len(w)
    ), f AS MATERIALIZED (
        SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {collocations.LEAST}
    ), totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang), candidates AS (
        SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
    ), cuts AS (
        SELECT c.lang, c.k, c.phrase, c.a, j, CAST(n AS BIGINT) AS n, x.a AS l, y.a AS r,
               CAST(1000 * c.a::HUGEINT * n::HUGEINT // (x.a::HUGEINT * y.a::HUGEINT) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')
        JOIN totals t ON t.lang = c.lang
    ), best AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
    ), inner_ones AS (
        SELECT DISTINCT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
        FROM candidates, range(2, {longest}) AS t(m), range(1, {longest + 1}) AS u(s) WHERE m < k AND s + m - 1 <= k GROUP BY ALL
    ), kept AS (
        SELECT b.* FROM best b LEFT JOIN inner_ones i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
    ) WHERE rank <= {collocations.TOP}
    """


def build() -> dict[str, str]:
    own = (op2_line_dedup, op5_decontaminate, op6_license_minhash, op10_host_trust, op11_chat_template, op12_ranked_search, op13_collocations)
    return {f.__name__: f() for f in own}
