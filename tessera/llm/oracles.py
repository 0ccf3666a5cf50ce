"""DuckDB SQL of the queries that SQL can express, written from the definitions and not from the methods.

No prefix filters, signatures, tiles or doubling here: pairs are compared in full and windows are lists, so
these are the brute force that the operators are held against.  The other queries have none: their results hang
on hashed draws, merges of a tokenizer, models or per-character scans.
"""

from __future__ import annotations

import math

from tessera.llm import license_scan, line_dedup, near_dups, part_codes, phrases, quality

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x20\x09-\x0D]+'"
_LICENSE_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _licenses() -> str:
    phrases = ", ".join(f"({_list(p.split(' '))}, '{label}')" for p, label in license_scan.PHRASES.items())
    rows = []
    for label, text in license_scan.TEMPLATES:
        own = license_scan.template_words(text)
        need = math.ceil(license_scan.CONTAINMENT * len(own) - 1e-9)
        rows.append(f"('{label}', {_list(own)}, {need}, {license_scan.reach(text)})")
    longest = max(len(p.split(" ")) for p in license_scan.PHRASES)
    ahead = ", ".join(f"lead(x, {k}) OVER o" for k in range(1, longest))
    return f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_LICENSE_WORD}) AS w FROM documents),
    w AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS spot FROM d),
    n AS (SELECT doc_id, spot, [x, {ahead}] AS own FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY spot)),
    base AS (SELECT doc_id, spot, label FROM n, (VALUES {phrases}) p(words, label) WHERE own[1:len(words)] = words),
    t AS (SELECT * FROM (VALUES {", ".join(rows)}) t(label, words, need, reach)),
    held AS (SELECT doc_id, label, need, len(words) AS n_words,
                    list_max([len(list_intersect(list_distinct(w[i:i + reach - 1]), words)) for i in range(1, len(w) + 1) if list_contains(words, w[i])]) AS n
             FROM d, t WHERE len(list_intersect(list_distinct(w), words)) >= need),
    more AS (SELECT doc_id, label, n / n_words AS part FROM held WHERE n >= need),
    b AS (SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list_sort(list_distinct(list(label))) AS labels FROM base GROUP BY doc_id),
    m AS (SELECT doc_id, max(part) AS part, list(label) AS labels FROM more GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
           CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
    FROM d LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)"""


def _top_k() -> str:
    return """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


def _quality() -> str:
    q = quality
    return f"""
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
    w AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
    g AS (SELECT doc_id, i, [x, lead(x) OVER o, lead(x, 2) OVER o] AS g, lead(x, 2) OVER o IS NOT NULL AS whole FROM w
          WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM g WHERE whole),
    rep AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r WHERE times > 1) GROUP BY doc_id),
    line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n, count(*) AS of FROM line WHERE regexp_matches(x, {_WORD}) GROUP BY doc_id),
    c AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(dup.of, 0) AS n_lines
          FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
    f AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {int(100 * q.MAX_REPEATED)} * n_words AS base_failed,
                 n_symbols > {q.MAX_SYMBOLS_PER_WORD}::DOUBLE * n_words OR n_dup_lines > {q.MAX_DUPLICATE_LINES}::DOUBLE * n_lines
                 OR NOT word_chars BETWEEN {q.MEAN_WORD[0]} * n_words AND {q.MEAN_WORD[1]} * n_words AS more FROM c),
    h AS (SELECT source, count(*) AS n, sum(CAST(base_failed OR more AS BIGINT))::DOUBLE AS bad FROM f GROUP BY source),
    p AS (SELECT sum(bad) / sum(n) AS m, var_pop(bad / n) AS v FROM h),
    k AS (SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 1.0::DOUBLE) ELSE {q.EVEN_WEIGHT}::DOUBLE END AS k FROM p),
    s AS (SELECT source, (bad + m * k) / (n + k) AS rate, m + {q.HOST_SPREAD}::DOUBLE * sqrt(m * (1 - m) / (k + 1)) AS far FROM h, k)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (rate >= {q.HOST_RATE}::DOUBLE AND rate >= far) AS kept,
           floor(rate * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS host_rate
    FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source"""


def _near_dups() -> str:
    n = near_dups.SHINGLE
    ahead = ", ".join(f"lead(x, {k}) OVER o" for k in range(1, n))
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
    w AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d WHERE len(w) >= {n}),
    g AS (SELECT doc_id, [x, {ahead}] AS g, lead(x, {n - 1}) OVER o IS NOT NULL AS whole FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    s AS (SELECT DISTINCT doc_id, md5(array_to_string(g, ' ')) AS g FROM g WHERE whole
          UNION ALL SELECT doc_id, md5(array_to_string(w, ' ')) FROM d WHERE len(w) BETWEEN 1 AND {n - 1}),
    c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM shared JOIN c x ON a = x.doc_id JOIN c y ON b = y.doc_id
             WHERE 100 * shared.n >= {near_dups.SIMILARITY} * (x.n + y.n - shared.n)),
    way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, way.b FROM reach JOIN way ON reach.b = way.a),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(c.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM least LEFT JOIN c USING (doc_id)"""


def _line_dedup() -> str:
    n = line_dedup.MIN_WORDS
    sums = ", ".join(
        f"sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND {k} FOLLOWING) AS f{k + 1}, sum(w) OVER (o ROWS BETWEEN {k} PRECEDING AND CURRENT ROW) AS b{k + 1}"
        for k in range(n)
    )
    first = {s: "CASE " + " ".join(f"WHEN {s}{k} >= {n} THEN {k}" for k in range(1, n + 1)) + " END" for s in "fb"}
    return f"""
    WITH line AS (SELECT doc_id, unnest(x) AS x, generate_subscripts(x, 1) AS line
                  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
    full_ AS (SELECT doc_id, line, x, len(regexp_extract_all(x, {_WORD})) AS w, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos
              FROM line WHERE regexp_matches(x, {_WORD})),
    s AS (SELECT doc_id, pos, list(md5(x)) OVER (o ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS ids, {sums} FROM full_
          WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    t AS (SELECT doc_id, pos, {first["f"]} AS ahead, {first["b"]} AS back FROM s),
    win AS (SELECT doc_id, pos, ahead AS n FROM t WHERE ahead IS NOT NULL UNION SELECT doc_id, pos - back + 1, back FROM t WHERE back IS NOT NULL),
    k AS (SELECT win.doc_id, win.pos, n, ids[1:n] AS key FROM win JOIN s ON win.doc_id = s.doc_id AND win.pos = s.pos),
    r AS (SELECT doc_id, pos, n, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS copy FROM k),
    gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM r WHERE copy > 1),
    cut AS (SELECT full_.doc_id, line FROM full_ JOIN gone ON full_.doc_id = gone.doc_id AND full_.pos = gone.pos),
    left_ AS (SELECT line.doc_id, string_agg(x, chr(10) ORDER BY line.line) AS text FROM line ANTI JOIN cut ON line.doc_id = cut.doc_id AND line.line = cut.line
              GROUP BY line.doc_id),
    n AS (SELECT doc_id, count(*) AS n_lines FROM full_ GROUP BY doc_id),
    c AS (SELECT doc_id, count(*) AS n_deleted FROM cut GROUP BY doc_id)
    SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
           sha256(CASE WHEN n_deleted = n_lines THEN '' WHEN n_deleted > 0 THEN left_.text ELSE documents.text END) AS text_sha256
    FROM documents LEFT JOIN n ON documents.doc_id = n.doc_id LEFT JOIN c ON documents.doc_id = c.doc_id LEFT JOIN left_ ON documents.doc_id = left_.doc_id"""


def _part_codes() -> str:
    parts, entries = part_codes.PARTS, part_codes.ENTRIES

    def near(k: int) -> str:
        gap = "list_sum(list_transform(range(1, len(x) + 1), lambda i: CAST(x[i] - c[i] AS HUGEINT) * (x[i] - c[i])))"
        return f"""a{k} AS (SELECT rid, p, any_value(x) AS x, min({{'d': coalesce({gap}, 0), 'e': e}}) AS best FROM part JOIN b{k} USING (p) GROUP BY rid, p)"""

    def means(k: int) -> str:
        return f"""
    s{k} AS (SELECT p, best.e AS e, i, sum(x[i]) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{k}, unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL),
    m{k} AS (SELECT p, e, list((s - (((s % n) + n) % n)) // n ORDER BY i) AS c FROM s{k} GROUP BY p, e),
    b{k + 1} AS (SELECT b{k}.p, b{k}.e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} ON b{k}.p = m{k}.p AND b{k}.e = m{k}.e)"""

    rounds = ",\n    ".join(f"{near(k)},{means(k)}" for k in range(part_codes.ROUNDS))
    last = part_codes.ROUNDS
    return f"""
    WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS HUGEINT)) AS v
                  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    part AS (SELECT rid, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
    first AS (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept QUALIFY e < {entries}),
    b0 AS (SELECT p, e, x AS c FROM part JOIN first USING (rid)),
    {rounds},
    {near(last)},
    book AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
             FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM b{last})),
    code AS (SELECT rid, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{last} GROUP BY rid)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN code USING (rid), book"""


def _phrases() -> str:
    least, longest = phrases.LEAST, phrases.LONGEST
    lengths = ", ".join(str(k) for k in range(1, longest + 1))
    text = _LOWER.format("coalesce(text, '')")
    return f"""
    WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({text}, '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents),
    w AS (SELECT lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w FROM piece),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, unnest(flatten(list_transform([{lengths}], lambda k: list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))))) AS phrase FROM w),
    f AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= {least}),
    c AS (SELECT lang, phrase, f AS a, ws, unnest(range(1, len(ws))) AS k FROM f WHERE len(ws) > 1),
    cut AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n.n, CAST(CAST(1000 AS HUGEINT) * a * n.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
            FROM c JOIN f l ON c.lang = l.lang AND l.phrase = array_to_string(c.ws[1 : k], ' ')
            JOIN f r ON c.lang = r.lang AND r.phrase = array_to_string(c.ws[k + 1 :], ' ') JOIN n ON c.lang = n.lang),
    best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (SELECT lang, f AS longer, unnest(flatten(list_transform(range(2, len(ws)), lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))))) AS phrase FROM f WHERE len(ws) > 2),
    left_ AS (SELECT * FROM best ANTI JOIN inside ON best.lang = inside.lang AND best.phrase = inside.phrase AND 100 * inside.longer >= 100 * best.a)
    SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM left_ WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
    QUALIFY row_number() OVER o <= {phrases.TOP}"""


ORACLES: dict[str, str] = {
    "op1_licenses": _licenses(),
    "op2_top_k": _top_k(),
    "op6_quality": _quality(),
    "op7_near_dups": _near_dups(),
    "op10_line_dedup": _line_dedup(),
    "op12_part_codes": _part_codes(),
    "op13_phrases": _phrases(),
}
