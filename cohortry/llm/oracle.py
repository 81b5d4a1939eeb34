"""SQL with the same result, for DuckDB, for the operators that SQL can express."""

from __future__ import annotations

from cohortry.llm.chat_format import CONTROLS, ESCAPE, LEARNED, MARKS, PROBE
from cohortry.llm.mixing import HASH_DIGITS, KEEP_SHARE, LAYOUTS, MARGINS, MAX_COPIES, ROUNDS, TEMPER
from cohortry.llm.near_dedup import PERCENT
from cohortry.llm.resampling import BUCKETS, DRAWN_PERCENT, GAIN_UNITS, LEAST_WORDS, SEED
from cohortry.llm.substring_dedup import WINDOW

SPACE = r"[\x20\x09-\x0D]+"


def _mixing() -> str:
    topics = " ".join(f"WHEN contains(body, '{mark}') THEN '{name}'" for name, mark in LAYOUTS)
    parts = [
        f"""docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS body FROM documents),
        drawn AS (SELECT doc_id, source, lang,
            CASE {topics} WHEN length(body) < 400 THEN 'short' ELSE 'prose' END AS topic,
            CASE WHEN body = '' THEN 0 ELSE length(body) - length(replace(body, ' ', '')) + 1 END AS tokens,
            CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_DIGITS})) AS BIGINT)
                / {float(16**HASH_DIGITS)!r} AS draw FROM docs),
        cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM drawn GROUP BY ALL)"""
    ]
    for m in MARGINS:
        parts.append(
            f"""want_{m} AS (SELECT {m}, t / sum(t) OVER () AS target
            FROM (SELECT {m}, pow(CAST(sum(tokens) AS DOUBLE), {TEMPER}) AS t FROM cells GROUP BY 1))"""
        )
    parts.append("fit_0 AS (SELECT *, CAST(tokens AS DOUBLE) AS weight FROM cells)")
    step = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            parts.append(
                f"""fit_{step + 1} AS MATERIALIZED (SELECT f.source, f.lang, f.topic, f.tokens,
                CASE WHEN s.s > 0 THEN f.weight * (coalesce(w.target, 0) / s.s) ELSE 0 END AS weight
                FROM fit_{step} f JOIN (SELECT {m}, sum(weight) AS s FROM fit_{step} GROUP BY 1) s
                ON f.{m} IS NOT DISTINCT FROM s.{m} LEFT JOIN want_{m} w ON f.{m} IS NOT DISTINCT FROM w.{m})"""
            )
            step += 1
    parts.append(
        f"ratio_0 AS (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM fit_{step})"
    )
    parts.append(
        f"""chance AS MATERIALIZED (SELECT source, lang, topic, least({float(MAX_COPIES)!r}, ratio *
        ({KEEP_SHARE} * (SELECT sum(tokens) FROM cells) / (SELECT sum(weight) FROM ratio_0))) AS expected FROM ratio_0)"""
    )
    return (
        "WITH "
        + ",\n".join(parts)
        + """ SELECT doc_id, source, lang, topic, tokens, round(expected, 6) AS expected, copies FROM (
        SELECT d.doc_id, d.source, d.lang, d.topic, CAST(d.tokens AS BIGINT) AS tokens, r.expected,
        CAST(floor(r.expected) AS BIGINT) + CAST(d.draw < r.expected - floor(r.expected) AS BIGINT) AS copies
        FROM drawn d JOIN chance r ON d.source IS NOT DISTINCT FROM r.source
        AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic IS NOT DISTINCT FROM r.topic) WHERE copies > 0"""
    )


def _near_dedup(words: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), '{upper}', '{lower}'), '{SPACE}'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, len(w) AS n, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words}
            THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {words} + 2),
                lambda i: array_to_string(list_slice(w, i, i + {words} - 1), ' ')) END) AS g FROM w),
    sets AS (SELECT DISTINCT doc_id, least(n, {words}) AS n, g FROM s),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
    met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b
            ON a.g = b.g AND a.n = b.n AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
              WHERE 100 * i >= {PERCENT} * (x.n + y.n - i)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
              UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    comp AS (SELECT a, min(b) AS c FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
    FROM documents d JOIN comp c ON c.a = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id"""


def _substring_dedup(window: int) -> str:
    return rf"""
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w
               FROM documents),
    win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {window} - 1), ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window} + 2)) AS i FROM w)),
    rep AS (SELECT g FROM win GROUP BY 1 HAVING count(*) > 1),
    starts AS (SELECT doc_id, i FROM win SEMI JOIN rep USING (g)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM starts),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words
             ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
    SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(k.t, '')) AS kept_sha256
    FROM w LEFT JOIN kept k USING (doc_id)"""


def _resampling() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    # The polynomial and the mask of crc32.
    return rf"""
    WITH crc AS (SELECT list(list_reduce(range(0, 8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS tab
        FROM (SELECT unnest(range(0, 256)) AS i)),
    w AS (SELECT doc_id, {words} AS f FROM documents),
    dw AS (SELECT doc_id, unnest(f) AS word FROM w),
    bw AS (SELECT unnest({words}) AS word FROM benchmark),
    vocab AS (SELECT word, xor(list_reduce(list_transform(range(0, octet_length(encode(word))),
            lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} AS bucket
        FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc),
    given AS (SELECT bucket, count(*) AS n FROM dw JOIN vocab USING (word) GROUP BY 1),
    wanted AS (SELECT bucket, count(*) AS n FROM bw JOIN vocab USING (word) GROUP BY 1),
    gain AS (SELECT bucket, CAST(floor({GAIN_UNITS} * ln(
            (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM given) + {BUCKETS})::DOUBLE
            / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM wanted) + {BUCKETS})::DOUBLE))) AS BIGINT) AS g
        FROM (SELECT DISTINCT bucket FROM vocab) LEFT JOIN given s USING (bucket) LEFT JOIN wanted t USING (bucket)),
    sums AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM dw JOIN vocab USING (word) JOIN gain USING (bucket) GROUP BY 1),
    weights AS (SELECT w.doc_id, coalesce(n, 0) AS n_features,
            CAST(coalesce(floor(g::DOUBLE / n), 0) AS BIGINT) AS weight FROM w LEFT JOIN sums USING (doc_id)),
    scores AS (SELECT *, weight + CAST(floor(-{GAIN_UNITS} * ln(-ln((CAST('0x' ||
            substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296.0::DOUBLE)))
            AS BIGINT) AS score FROM weights),
    able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scores
        WHERE n_features >= {LEAST_WORDS})
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <=
        (SELECT {DRAWN_PERCENT} * count(*) // 100 FROM able) THEN place END AS rank
    FROM scores LEFT JOIN able USING (doc_id)"""


def _chat_formatting() -> str:
    """Lengths follow from the template: its control strings, and one sign for each one escaped."""
    found = "|".join(f"{c[0]}{ESCAPE}*{c[1:]}".replace("[", r"\[").replace("]", r"\]") for c in CONTROLS)
    marked = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in MARKS.items())
    other = sum(len(c) for c in CONTROLS[-3:])
    grown = lambda column: f"length({column}) + len(regexp_extract_all({column}, '{found}'))"
    return rf"""
    WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
    sized AS (SELECT *, {grown("body")} + CASE role {marked} ELSE {other} + {grown("role")} END AS size FROM rows)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(coalesce(sum(length(body)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(body, '' ORDER BY turn) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
        CAST(sum(size) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id"""


ORACLE: dict[str, str] = {
    "op6_mixing": _mixing(),
    "op7_minhash_near_dedup": _near_dedup(4),
    "op10_substring_dedup": _substring_dedup(WINDOW),
    "op12_importance_resampling": _resampling(),
    "op13_chat_formatting": _chat_formatting(),
}
