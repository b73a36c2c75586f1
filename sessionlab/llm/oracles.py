"""SQL that gives the rows of the longer queries on small tables."""

from __future__ import annotations

SOURCE_DIVERGENCE = r"""WITH docs AS (
          SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
          FROM documents),
        uses AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
        terms AS (SELECT lang, term FROM uses GROUP BY ALL HAVING count(DISTINCT d) >= 3),
        sources AS (SELECT DISTINCT lang, source FROM docs),
        types AS (SELECT lang, count(*) AS v FROM terms GROUP BY lang),
        used AS (SELECT lang, source, term, count(*) AS n FROM uses SEMI JOIN terms USING (lang, term) GROUP BY ALL),
        counts AS (
          SELECT s.lang, s.source, t.term, coalesce(n, 0) AS n
          FROM sources s JOIN terms t USING (lang)
          LEFT JOIN used u ON u.lang = s.lang AND u.source = s.source AND u.term = t.term),
        weights AS (
          SELECT lang, source, term, n,
                 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p
          FROM counts JOIN types USING (lang)),
        whole AS (
          SELECT lang, term,
                 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
          FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN types USING (lang)),
        pairs AS (
          SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
          FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                     FROM weights x JOIN weights y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
                     GROUP BY ALL) f
            ON f.lang = a.lang AND f.source = a.source AND f.other = b.source),
        best AS (
          SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
          FROM weights JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
          SELECT lang, source, 'pair' AS part, item, value,
                 row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
          UNION ALL
          SELECT lang, source, 'term' AS part, item, value,
                 row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM best
          QUALIFY rank <= 200)"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round as two common tables: the nearest entry of every part, and the entries that
    follow. The least of distance * entries + entry is the first of the nearest entries."""
    distance = "list_sum(list_transform(list_zip(v.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""kept AS MATERIALIZED (
              SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            parts AS MATERIALIZED (
              SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS c
              FROM kept, (SELECT unnest(range({parts})) AS part)),
            book_0 AS MATERIALIZED (
              SELECT part, entry, c FROM parts JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
                ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""near_{n} AS MATERIALIZED (
              SELECT vec_id, any_value(label) AS label, v.part, any_value(v.c) AS c,
                     min({distance} * {entries} + b.entry) AS best
              FROM parts v JOIN book_{n} b ON v.part = b.part GROUP BY vec_id, v.part)"""
        )
        if n < rounds:
            steps.append(
                f"""sums_{n + 1} AS (
              SELECT part, entry, list(mean ORDER BY place) AS c FROM (
                SELECT part, entry, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean
                FROM (SELECT part, best % {entries} AS entry, unnest(c) AS x, unnest(range(len(c))) AS place
                      FROM near_{n})
                GROUP BY part, entry, place) GROUP BY part, entry),
            book_{n + 1} AS MATERIALIZED (
              SELECT b.part, b.entry, list_transform(coalesce(s.c, b.c), lambda x: CAST(x AS BIGINT)) AS c
              FROM book_{n} b LEFT JOIN sums_{n + 1} s ON b.part = s.part AND b.entry = s.entry)"""
            )
    return f"""WITH {", ".join(steps)},
        rated AS (
          SELECT vec_id, any_value(label) AS label,
                 string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code,
                 CAST(sum(best // {entries}) AS BIGINT) AS error
          FROM near_{rounds} GROUP BY vec_id)
        SELECT vec_id, label, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book_{rounds})
                 AS codebooks_sha256
        FROM rated"""
