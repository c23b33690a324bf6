"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from . import collocations, decontaminate, resample
from .quality_rules import HOST_LIMIT, MAX_REPEAT_PERCENT, MIN_WORDS

#: ASCII capitals to small letters only.
LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontaminate_sql() -> str:
    n = decontaminate.WINDOW
    return f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {WORDS} AS ws FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS ws FROM benchmark),
        i AS (SELECT item, ws, least(len(ws), {n}) AS n, unnest(range(1, len(ws) - least(len(ws), {n}) + 2)) AS pos FROM b WHERE len(ws) > 0),
        w AS MATERIALIZED (SELECT DISTINCT item, n, array_to_string(ws[pos:pos + n - 1], ' ') AS win FROM i),
        p AS (SELECT k, ws, s.n, unnest(range(1, len(ws) - s.n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM w) s WHERE len(ws) >= s.n),
        h AS MATERIALIZED (SELECT k, pos, p.n, item FROM p JOIN w ON w.n = p.n AND w.win = array_to_string(p.ws[p.pos:p.pos + p.n - 1], ' ')),
        c AS (SELECT k, count(DISTINCT pos) AS n_hit FROM (SELECT k, unnest(range(pos, pos + n)) AS pos FROM h) GROUP BY k),
        t AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT k, item FROM h WHERE item IS NOT NULL) GROUP BY k)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (k) LEFT JOIN t USING (k)"""


def resample_sql() -> str:
    """One-word features; the table of CRC-32 comes from its polynomial."""
    r = resample
    return f"""
        WITH RECURSIVE z(i, step, c) AS (
            SELECT range, 0, CAST(range AS BIGINT) FROM range(256)
            UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM z WHERE step < 8),
        crc AS (SELECT list(c ORDER BY i) AS cells FROM z WHERE step = 8),
        d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {WORDS} AS ws FROM documents),
        f AS (SELECT k, unnest(ws) AS word FROM d),
        g AS (SELECT unnest({WORDS}) AS word FROM benchmark),
        v AS (SELECT DISTINCT word FROM (SELECT word FROM f UNION ALL SELECT word FROM g)),
        x AS (SELECT word, hex(encode(word)) AS h FROM v),
        y AS (SELECT word, [CAST(('0x' || h[2 * j + 1:2 * j + 2]) AS BIGINT) FOR j IN range(length(h) // 2)] AS bytes FROM x),
        bucket AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295, bytes),
                lambda a, b: xor(a >> 8, cells[(xor(a, b) & 255) + 1])), 4294967295) % {r.BUCKETS} AS b FROM y, crc),
        s AS (SELECT b, count(*) AS s FROM f JOIN bucket USING (word) GROUP BY b),
        t AS (SELECT b, count(*) AS t FROM g JOIN bucket USING (word) GROUP BY b),
        n AS (SELECT (SELECT count(*) FROM f) AS all_s, (SELECT count(*) FROM g) AS all_t),
        gain AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + {r.BUCKETS} AS DOUBLE))
                 / (CAST(s + 1 AS DOUBLE) * CAST(all_t + {r.BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM n, s LEFT JOIN t USING (b)),
        w AS (SELECT k, sum(gain) AS weight FROM f JOIN bucket USING (word) JOIN gain USING (b) GROUP BY k),
        e AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                     CAST(('0x' || substr(sha256('{r.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h
              FROM d LEFT JOIN w USING (k)),
        o AS (SELECT doc_id, n_features, weight,
                     weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM e),
        q AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {r.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
                     count(*) OVER (PARTITION BY n_features >= {r.MIN_WORDS}) AS n FROM o)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= {r.MIN_WORDS} AND place <= n * {r.PERCENT} // 100 THEN place END AS "rank" FROM q"""


def collocations_sql() -> str:
    c = collocations
    return rf"""
        WITH x AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({LOW}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM x),
        g AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS pos FROM p, (SELECT unnest(range(1, {c.LONGEST + 1})) AS m) WHERE len(ws) >= m),
        f AS MATERIALIZED (SELECT lang, m, array_to_string(ws[pos:pos + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
        t AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
        k AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= {c.SHORTEST} AND f >= {c.MIN_COUNT}),
        u AS (SELECT lang, m, phrase, a, ws, unnest(range(1, m)) AS cut FROM k),
        s AS (SELECT u.lang, u.phrase, u.a, u.m, cut, l.f AS l, r.f AS r,
                     (CAST(1000000 AS HUGEINT) * u.a * u.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
              FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
                     JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(ws[cut + 1:u.m], ' ')),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        i AS (SELECT lang, a, ws, z.size, unnest(range(1, m - z.size + 2)) AS pos
              FROM k, (SELECT unnest(range({c.SHORTEST}, {c.LONGEST})) AS size) z WHERE m > z.size),
        o AS (SELECT lang, array_to_string(ws[pos:pos + size - 1], ' ') AS phrase, max(a) AS cover FROM i GROUP BY ALL),
        q AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < {c.COVER_PERCENT} * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank", phrase, a, l, r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM q JOIN t USING (lang) QUALIFY "rank" <= {c.TOP}"""


def suffix_dedup_sql() -> str:
    """Every 100-byte string by its first place; texts as hexadecimal digits, two a byte."""
    return """
        WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT doc_id, unnest(range(length(h) // 2 - 99)) AS pos, h FROM d WHERE length(h) >= 200),
        s AS MATERIALIZED (SELECT doc_id, pos, md5(h[2 * pos + 1:2 * pos + 200]) AS x FROM w),
        r AS MATERIALIZED (SELECT doc_id, pos FROM s QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, pos) > 1),
        c AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(pos, pos + 100)) AS pos FROM r),
        n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (fresh) AS n_spans
              FROM (SELECT doc_id, pos, coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), 2) > 1 AS fresh FROM c) GROUP BY doc_id),
        b AS (SELECT doc_id, unnest(range(length(h) // 2)) AS pos, h FROM d WHERE doc_id IN (SELECT doc_id FROM r)),
        k AS (SELECT doc_id, string_agg(b.h[2 * b.pos + 1:2 * b.pos + 2], '' ORDER BY b.pos) AS kept
              FROM b ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""


def jaccard_join_sql() -> str:
    return rf"""
        WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        g AS (SELECT doc_id, ws, least(len(ws), 5) AS n, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS pos FROM d WHERE len(ws) > 0),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[pos:pos + n - 1], ' ') AS x FROM g),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS MATERIALIZED (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * inter >= 80 * (p.n + q.n - inter)),
        e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        c(doc_id, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.doc_id WHERE c.root < e.b)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS low FROM c GROUP BY doc_id) USING (doc_id)"""


def exact_dedup_sql() -> str:
    return r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
                   FROM documents),
             g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM n JOIN g USING (h)"""


def quality_rules_sql() -> str:
    return rf"""
        WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, source, t,
                     [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM d),
        p AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
        r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM p) WHERE c > 1),
        c AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words
              FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS k FROM r) GROUP BY doc_id),
        l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines
              FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
              WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        m AS (SELECT doc_id, source, len(ws) AS n_words,
                     length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                     length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
              FROM w LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
        f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
                     n_symbols > greatest(n_words, 1) OR word_chars / greatest(n_words, 1) > 30
                     OR word_chars / greatest(n_words, 1) < 2 OR n_dup_lines > 0.5 * greatest(n_words, 1) AS other_failed
              FROM m),
        h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR other_failed) AS x FROM f GROUP BY source),
        s AS (SELECT sum(x) / sum(n) AS mean, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2
                     - sum(x) / sum(n) * (1 - sum(x) / sum(n)) * count(*) / sum(n) AS spread FROM h),
        b AS (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 2.0), 1e6)
                                ELSE 1e6 END AS k FROM s),
        v AS (SELECT source, (x + mean * k) / (n + k) > {HOST_LIMIT} AS rejected FROM h, b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT rejected AS kept
        FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""


def oracles() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup_sql(), "op4_suffix_dedup": suffix_dedup_sql(),
            "op7_jaccard_join": jaccard_join_sql(), "op8_quality_rules": quality_rules_sql(),
            "op11_decontaminate": decontaminate_sql(), "op12_resample": resample_sql(), "op13_collocations": collocations_sql()}
