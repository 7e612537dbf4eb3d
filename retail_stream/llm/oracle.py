"""DuckDB SQL for the operators that SQL expresses."""

from __future__ import annotations

from retail_stream.llm import host_rules

WARC = """
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
           CASE WHEN other THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN other THEN last END AS refers_to
    FROM (SELECT *, coalesce(strlen(payload) >= 1000 AND last IS NOT NULL
                             AND page_id IS DISTINCT FROM last, false) AS other
          FROM (SELECT page_id, coalesce(html, '') AS payload,
                       max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages))"""

WORDS = """
    docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
    split AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs)"""

WORD_WINDOWS = f"""
    WITH {WORDS},
    windows AS (
      SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS k
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split WHERE len(w) >= 50)),
    gone AS (
      SELECT DISTINCT r, unnest(range(i, i + 50)) AS p
      FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first FROM windows) WHERE first < doc_id),
    lost AS (SELECT r, count(*) AS n, list(p) AS p FROM gone GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
           sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
                  ELSE coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (
                         SELECT unnest(w) AS x, generate_subscripts(w, 1) AS i)
                       WHERE NOT list_contains(p, i)), '') END) AS kept_sha256
    FROM split LEFT JOIN lost USING (r)"""


# Windows are told apart by a 64-bit hash of their bytes in hexadecimal.
BYTE_WINDOWS = """
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    pieces AS (
      SELECT r, doc_id, b, substr(h, 2 * b + 1, 2 * 1099) AS h
      FROM (SELECT r, doc_id, h, unnest(range(0, strlen(h) // 2, 1000)) AS b FROM docs)),
    windows AS (
      SELECT r, doc_id, b + j AS i, hash(substr(h, 2 * j + 1, 200)) AS k
      FROM (SELECT *, unnest(range(0, strlen(h) // 2 - 99)) AS j FROM pieces WHERE strlen(h) >= 200)),
    firsts AS (SELECT k, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY k),
    gone AS (
      SELECT r, i FROM windows JOIN firsts USING (k) WHERE f.d < doc_id OR (f.d = doc_id AND f.i < i)),
    runs AS (
      SELECT r, i, sum(part) OVER (PARTITION BY r ORDER BY i) AS run
      FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 100 THEN 0 ELSE 1 END AS part FROM gone)),
    spans AS (SELECT r, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY r, run),
    before AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS c FROM spans),
    kept AS (
      SELECT r, sum(b - a) AS n, count(*) AS m, max(b) AS last,
             string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS front
      FROM before JOIN docs USING (r) GROUP BY r)
    SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(m, 0)::BIGINT AS n_spans,
           sha256(unhex(CASE WHEN n IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
    FROM docs LEFT JOIN kept USING (r)"""


def host_rules_sql() -> str:
    """Measures, then counts by host, priors by moments and verdicts, as the operator defines them."""
    fails = {
        "short": "n_words < 10",
        "repetitive": "100 * n_repeat_words > 20 * n_words",
        "symbols": "10 * n_symbols > n_words",
        "lines": "10 * n_dup_lines > 3 * n_words",
        "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
    }
    sums = ", ".join(f"sum(({c})::INTEGER)::DOUBLE AS f_{r}" for r, c in fails.items())
    moments = ", ".join(f"sum(f_{r}) / sum(docs) AS m_{r}, sum(f_{r} * f_{r} / docs) AS q_{r}" for r in fails)
    strength = ", ".join(
        f"""m_{r}, least(greatest(CASE WHEN k > 1 AND n - docs2 / n > 0
              AND (q_{r} - n * m_{r} * m_{r} - (k - 1) * m_{r} * (1 - m_{r})) / (n - docs2 / n) > 0
            THEN m_{r} * (1 - m_{r}) / ((q_{r} - n * m_{r} * m_{r} - (k - 1) * m_{r} * (1 - m_{r}))
              / (n - docs2 / n)) - 1 ELSE 1000 END, 1), 1000) AS s_{r}"""
        for r in fails
    )
    worst = ", ".join(f"(f_{r} + m_{r} * s_{r}) / (docs + s_{r})" for r in fails)
    return f"""
    WITH {WORDS},
    windows AS (
      SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
    repeats AS (
      SELECT r, count(DISTINCT p) AS n FROM (
        SELECT r, unnest(range(i, i + 5)) AS p FROM (
          SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM windows) WHERE c > 1)
      GROUP BY r),
    measured AS (
      SELECT doc_id, source AS host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM (SELECT *, list_filter(string_split(text, chr(10)),
                                  lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM split)
      LEFT JOIN repeats USING (r)),
    counts AS (SELECT host, count(*)::DOUBLE AS docs, {sums} FROM measured GROUP BY host),
    moments AS (SELECT sum(docs) AS n, count(*) AS k, sum(docs * docs) AS docs2, {moments} FROM counts),
    priors AS (SELECT {strength} FROM moments),
    hosts AS (SELECT host, greatest({worst}) <= {host_rules.MAX_HOST_RATE} AS host_kept FROM counts, priors)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND host_kept AS kept
    FROM (SELECT *, ({fails["short"]}) OR ({fails["repetitive"]}) AS base_failed FROM measured) a
    JOIN hosts b ON a.host IS NOT DISTINCT FROM b.host"""


_BENCH_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

DECONTAMINATION = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS w FROM documents),
    items AS (SELECT item_id::VARCHAR AS item_id, {_BENCH_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    places AS (
      SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT r, i, places.n, item_id FROM places JOIN windows USING (n, k)),
    words AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (
                SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    found AS (SELECT r, count(DISTINCT item_id)::BIGINT AS n_items,
                     string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


def vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Lloyd rounds written out; each compares every part with the whole codebook."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    near{r} AS (
      SELECT r, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best
      FROM (SELECT r, p, x, e, list_sum(list_transform(range(1, len(x) + 1),
                                        lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
            FROM cut JOIN book{r} USING (p)) GROUP BY r, p)""")
        if r < rounds:
            steps.append(f"""
    sums{r} AS (
      SELECT p, e, i, sum(v) AS s, count(*) AS n
      FROM (SELECT p, best.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM near{r}) GROUP BY p, e, i),
    mean{r} AS (
      SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM sums{r} GROUP BY p, e),
    book{r + 1} AS (
      SELECT p, e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    return f"""
    WITH kept AS (
      SELECT row_number() OVER () AS r, vec_id, label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    seeds AS (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}),
    cut AS (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
            FROM kept, range({parts}) t(p)),
    book0 AS (SELECT p, e, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS c
              FROM seeds, range({parts}) t(p)),{",".join(steps)},
    coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
              FROM near{rounds} GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
    FROM kept JOIN coded USING (r)"""


def filter_audit_sql() -> str:
    """Masks per document, then every order's steps over their counts."""
    bits = {n: 1 << i for i, n in enumerate("ABCDE")}
    mask = " + ".join(f"{b} * fails_{n.lower()}::INTEGER" for n, b in bits.items())
    bit = "(1 << (ascii(l) - 65))"
    return f"""
    WITH measured AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    judged AS (
      SELECT doc_id, part, len(w) < 200 AS fails_a, 100 * len(list_distinct(w)) < 50 * len(w) AS fails_b,
             100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) AS fails_c,
             regexp_matches(text, '[#$%&*|]') AS fails_d,
             coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS fails_e FROM measured),
    known AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic
              FROM labels GROUP BY doc_id),
    masks AS (
      SELECT part, {mask} AS mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM judged LEFT JOIN known USING (doc_id) GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS o
      FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
      JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
      SELECT o, s, o[s:s] AS l, list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(o[i:i]) - 65))) AS before
      FROM orders, range(1, 6) t(s)),
    counted AS (
      SELECT part, o AS filter_order, s::INTEGER AS step, l,
        sum(CASE WHEN mask & (coalesce(before, 0)::INTEGER | {bit}) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & coalesce(before, 0)::INTEGER = 0 AND mask & {bit} > 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & coalesce(before, 0)::INTEGER > 0 AND mask & {bit} > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = {bit} THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & coalesce(before, 0)::INTEGER = 0 AND mask & {bit} > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & coalesce(before, 0)::INTEGER = 0 AND mask & {bit} > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM masks, steps GROUP BY part, o, s, l)
    SELECT * EXCLUDE (l), (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM counted"""


def all_sql() -> dict[str, str]:
    return {
        "op1_warc": WARC,
        "op3_word_windows": WORD_WINDOWS,
        "op4_host_rules": host_rules_sql(),
        "op8_byte_windows": BYTE_WINDOWS,
        "op9_decontamination": DECONTAMINATION,
        "op11_filter_audit": filter_audit_sql(),
        "op13_vector_codes": vector_codes_sql(),
    }
