"""SQL, in DuckDB's dialect, for the operators it can express."""

from __future__ import annotations

from cratelake.llm import lexical, mixing, pii, urls

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _op1() -> str:
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}|{v}'"
        for v, h, p in sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    )

    def level(name: str, rows: str) -> str:
        return f"""
        {name}_k AS (
            SELECT 1 / least(greatest(CASE WHEN sum((n - 1) * m * (1 - m)) > 0
                THEN (sum(n * pow(g / n - m, 2)) - sum(m * (1 - m))) / sum((n - 1) * m * (1 - m))
                ELSE 0.001 END, 0.001), 0.999) - 1 AS k
            FROM ({rows}) WHERE n > 0),
        {name} AS (
            SELECT r.*, k, (g + k * m) / (n + k) AS mean
            FROM ({rows}) r, (SELECT coalesce(max(k), 999.0) AS k FROM {name}_k))"""

    return f"""
    WITH cut AS (
        SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    parsed AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut),
    good AS (
        SELECT doc_id, CAST(min(quality) = 1 AND max(coalesce(toxic, 0)) = 0 AS BIGINT) AS good
        FROM labels GROUP BY doc_id),
    outcome AS (
        SELECT host, sum(good) AS g, count(*) AS n
        FROM parsed JOIN good
          ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(\\.html)?/?$', 1) AS BIGINT)
        WHERE good IS NOT NULL GROUP BY host),
    hosts AS (
        SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
               array_to_string(list_slice(string_split(host, '.'), -1, -1), '.') AS suffix,
               CAST(coalesce(g, 0) AS DOUBLE) AS g, CAST(coalesce(n, 0) AS DOUBLE) AS n
        FROM (SELECT DISTINCT host FROM parsed) LEFT JOIN outcome USING (host)),
    base AS (SELECT (sum(g) + 1) / (sum(n) + 2) AS m FROM hosts),
    {level("suffixes", "SELECT suffix, sum(g) AS g, sum(n) AS n, (SELECT m FROM base) AS m FROM hosts GROUP BY suffix")},
    {level("domains", "SELECT h.suffix, domain, sum(h.g) AS g, sum(h.n) AS n, any_value(s.mean) AS m FROM hosts h JOIN suffixes s USING (suffix) GROUP BY h.suffix, domain")},
    {level("weighed", "SELECT h.host, h.g, h.n, d.mean AS m FROM hosts h JOIN domains d USING (domain)")},
    poor AS (
        SELECT host FROM weighed
        WHERE mean + {urls.DEVIATIONS} * sqrt(mean * (1 - mean) / (n + k + 1)) < {urls.BAR}),
    ruled AS (SELECT *, CASE {cases} END AS found FROM parsed)
    SELECT page_id, r.host, path, split_part(found, '|', 1) AS rule,
           CASE WHEN found IS NOT NULL THEN split_part(found, '|', 2)
                WHEN p.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled r LEFT JOIN poor p ON r.host = p.host"""


OP3 = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE
            WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
        FROM words),
    sizes AS (SELECT doc_id, coalesce(len(s), 0) AS n FROM sets),
    classes AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    items AS (SELECT rep, n, unnest(s) AS g FROM classes),
    pairs AS (
        SELECT a.rep AS a, b.rep AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
        FROM items a JOIN items b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
        GROUP BY a.rep, b.rep),
    links AS (
        SELECT a, b FROM pairs WHERE 100 * i >= 85 * (na + nb - i)
        UNION ALL SELECT b, a FROM pairs WHERE 100 * i >= 85 * (na + nb - i)),
    reach AS (
        SELECT rep AS a, rep AS b FROM classes
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    label AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
    SELECT t.doc_id, sizes.n AS n_shingles, coalesce(component, t.doc_id) AS component_id,
           t.doc_id = coalesce(component, t.doc_id) AS kept
    FROM sets t JOIN sizes USING (doc_id) LEFT JOIN classes c ON t.s = c.s LEFT JOIN label ON a = c.rep"""

OP6 = rf"""
    WITH cut AS (
        SELECT doc_id, source, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    sized AS (
        SELECT doc_id, source, text, len(w) AS size, len(list_distinct(w)) AS news,
               coalesce(length(text) - length(translate(text, '{mixing.SYMBOLS}', '')), 0) AS symbols,
               coalesce(length(text) - length(translate(text, '{_UP}', '')), 0) AS capitals
        FROM cut),
    keyed AS (
        SELECT doc_id, source, size,
               -ln((CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)
                    AS BIGINT) + 0.5) / 4503599627370496.0)
               / greatest((size + 1) / (size + 1 + symbols) * least(1.0, (news + 1) / (4 * sqrt(size + 1)))
                          * (1 - capitals / (coalesce(length(text), 0) + 1)), {mixing.LEAST_QUALITY}) AS key
        FROM sized),
    sources AS (
        SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM keyed GROUP BY source),
    weighed AS (SELECT *, [3, 1, 2][(r - 1) % 3 + 1] AS w, 2 * s / [3, 1, 2][(r - 1) % 3 + 1] AS ratio FROM sources),
    levels AS (
        SELECT *, (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER before, 0))
                  / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
        FROM weighed WINDOW before AS (ORDER BY ratio, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (
        SELECT source, CAST(s AS BIGINT) AS s,
               CASE WHEN ratio <= level THEN CAST(2 * s AS DOUBLE) ELSE w * max(level) OVER () END AS target
        FROM levels),
    plan AS (
        SELECT *, CAST(round(target) AS BIGINT) AS goal,
               CASE WHEN s > 0 THEN CAST(round(target) AS BIGINT) // s ELSE 0 END AS whole
        FROM targets),
    drawn AS (
        SELECT doc_id, size, s, target, whole, goal - whole * s AS rest,
               CAST(coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
        FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, s AS source_size, target,
           whole * size + greatest(0, least(size, rest - before)) AS taken
    FROM drawn"""


def _op8() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": pii.IBAN, "ssn": pii.SSN,
    }
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum([CASE WHEN i % 2 = 1 THEN CAST(reverse({digits})[i] AS INT)"
        f" WHEN CAST(reverse({digits})[i] AS INT) > 4 THEN 2 * CAST(reverse({digits})[i] AS INT) - 9"
        f" ELSE 2 * CAST(reverse({digits})[i] AS INT) END FOR i IN range(1, length({digits}) + 1)]) % 10 = 0"
    )
    turned = "substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4)"
    # Longer numbers than a decimal holds are taken in two parts.
    whole = f"list_aggregate([CASE WHEN ascii(c) < 58 THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END FOR c IN string_split({turned}, '')], 'string_agg', '')"
    mod97 = (
        f"CAST(CAST(CAST(substr({whole}, 1, 30) AS HUGEINT) % 97 AS VARCHAR) || substr({whole}, 31) AS HUGEINT) % 97 = 1"
    )
    checks = {
        "email": "true",
        "ip": "list_bool_and([length(ltrim(x, '0')) <= 3 AND CAST('0' || right(x, 3) AS INT) <= 255 FOR x IN string_split(v, '.')])",
        "card": f"length({digits}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": mod97,
        "ssn": "regexp_matches(lower(substr(text, greatest(0, pos - {r}) + 1, length(v) + 2 * {r})), '\\b(?:{c})')".format(
            r=pii.REACH, c=pii.CONTEXT["ssn"]),
    }
    hits = " UNION ALL ".join(
        f"""SELECT row, text, {i} AS turn, '{kind}' AS kind, unnest(range(1, len(hits) + 1)) AS i, hits, parts
        FROM (SELECT row, text, regexp_extract_all(text, '{plain[kind]}') AS hits,
                     string_split_regex(text, '{plain[kind]}') AS parts FROM numbered)"""
        for i, kind in enumerate([*pii.BASE, *pii.ADDED])
    )
    passed = " ".join(f"WHEN '{kind}' THEN {check}" for kind, check in checks.items())
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    hits AS ({hits}),
    placed AS (
        SELECT row, text, turn, kind, hits[i] AS v,
               CAST(coalesce(list_sum([length(x) FOR x IN parts[1:i]]), 0)
                    + coalesce(list_sum([length(x) FOR x IN hits[1:i - 1]]), 0) AS BIGINT) AS pos
        FROM hits),
    spans AS (
        SELECT row, turn, kind, pos, concat_ws(':', kind, pos, pos + length(v)) AS span
        FROM placed WHERE CASE kind {passed} END),
    told AS (
        SELECT row, {counts},
               coalesce(string_agg(span, ',' ORDER BY turn, pos) FILTER (kind IN ({base})), '') AS base,
               string_agg(span, ',' ORDER BY turn, pos) AS spans
        FROM spans GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM numbered LEFT JOIN told USING (row)"""


def _op13() -> str:
    terms = f"regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{lexical.TERM}')"
    return f"""
    WITH cut AS (SELECT row_number() OVER () AS place, doc_id, {terms} AS terms FROM documents),
    sizes AS (SELECT place, doc_id, len(terms) AS n FROM cut WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
    asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
    held AS (
        SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM cut)
        WHERE term IN (SELECT term FROM asked) GROUP BY place, term),
    weights AS (
        SELECT term, CAST(floor(1000.0 * ln((2.0 * docs + 2.0) / (2.0 * df + 1.0))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals),
    scored AS (
        SELECT item_id, place, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (place), totals
        GROUP BY item_id, place, doc_id)
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, place)
    QUALIFY row_number() OVER best <= 10"""


ORACLES = {
    "op1_urls": _op1(), "op3_minhash": OP3, "op6_mixing": OP6, "op8_pii": _op8(), "op13_lexical": _op13(),
}
