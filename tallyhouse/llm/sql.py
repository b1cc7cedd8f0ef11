"""SQL that a query must agree with, where SQL can express it; the others are held against brute force in tests/llm."""

from tallyhouse.llm.rules import ALPHA, CANDIDATES, LEAST_WORDS, MOST_REPEATED_PERCENT, RISK

_ALL_FINITE = """embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _codes_sql(rounds: int = 2) -> str:
    """Integer k-means of 16 parts, one pair of CTEs for each round."""
    steps = [
        f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE {_ALL_FINITE}
), numbers AS (
    SELECT r, part, list_slice(v, part * len(v) // 16 + 1, (part + 1) * len(v) // 16) AS p
    FROM kept, (SELECT unnest(range(16)) AS part)
), book0 AS (
    SELECT part, r - 1 AS entry, p AS e FROM numbers WHERE r <= 64
)"""
    ]
    for number in range(rounds + 1):
        steps.append(
            f"""nearest{number} AS MATERIALIZED (
    SELECT r, part, any_value(p) AS p, min(d) AS d, arg_min(entry, d * 64 + entry) AS entry
    FROM (
        SELECT r, part, p, entry, list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM numbers JOIN book{number} USING (part)
    ) GROUP BY r, part
)"""
        )
        if number < rounds:
            steps.append(
                f"""book{number + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(fresh, e) AS e
    FROM book{number} LEFT JOIN (
        SELECT part, entry, list(m ORDER BY i) AS fresh
        FROM (
            SELECT part, entry, i, CAST(floor(sum(p[i]) / count(*)) AS BIGINT) AS m
            FROM nearest{number}, (SELECT unnest(range(1, 1 + (SELECT max(len(p)) FROM numbers))) AS i)
            GROUP BY part, entry, i
        ) GROUP BY part, entry
    ) USING (part, entry)
)"""
            )
    steps.append(
        f"""coded AS (
    SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM nearest{rounds} GROUP BY r
), books AS (
    SELECT sha256(string_agg(list_aggregate(e, 'string_agg', ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books"""
    )
    return ", ".join(steps)


_NEGATIVES = f"""
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_ALL_FINITE}
), pairs AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

# Words as one text with a blank on either side of each; windows are looked up among the ten-grams of a text.
_LEAKS = r"""
WITH doc_words AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), found AS MATERIALIZED (
    SELECT r, i, n, item_id
    FROM (
        SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
    ) JOIN windows USING (n, gram)
), hits AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

# The statistic of each rule over the counts of a text.
_STATISTICS = {
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "exclaim_share": "n_exclaim / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}


def risk_rules_sql(risk: float = RISK, alpha: float = ALPHA) -> str:
    """Counts, cutoffs by binomial tails over distinct good texts of each language, and verdicts."""
    share = risk / len(CANDIDATES)
    bounds = ", ".join(f"('{r}', {k}, CAST({c!r} AS DOUBLE))" for r, cs in CANDIDATES.items() for k, c in enumerate(cs))
    values = " UNION ALL ".join(f"SELECT r, '{r}' AS rule, {k} AS place, {v} AS v FROM counted" for k, (r, v) in enumerate(_STATISTICS.items()))
    return rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang AS stratum, text, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), words AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts
), windows AS (
    SELECT r, i
    FROM (SELECT r, i, word AS a, lead(word) OVER same AS b, lead(word, 2) OVER same AS c FROM words WINDOW same AS (PARTITION BY r ORDER BY i))
    WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), repeated AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows) GROUP BY r
), counted AS MATERIALIZED (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
    FROM (
        SELECT r, doc_id, stratum, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
               len(regexp_extract_all(t, '!')) AS n_exclaim
        FROM texts LEFT JOIN repeated USING (r)
    )
), bounds(rule, step, cutoff) AS (
    VALUES {bounds}
), valued AS MATERIALIZED (
    {values}
), held AS (
    SELECT min(r) AS r, stratum FROM counted
    WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)
    GROUP BY stratum, text
), tests AS (
    SELECT stratum, rule, step, cutoff, count(*) AS n, count(*) FILTER (WHERE v > cutoff) AS x
    FROM held JOIN valued USING (r) JOIN bounds USING (rule) GROUP BY ALL
), tails AS (
    SELECT stratum, rule, step, cutoff, x <= n * {share!r} AND list_sum(list_transform(range(0, x + 1), lambda i:
               exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share!r}) + (n - i) * ln(1 - {share!r}))))
           <= {alpha!r} / ({len(CANDIDATES)} * (SELECT count(*) FROM (SELECT DISTINCT stratum FROM tests))) AS safe
    FROM tests
), cutoffs AS (
    SELECT stratum, rule, min(cutoff) AS cutoff
    FROM (SELECT *, bool_and(safe) OVER (PARTITION BY stratum, rule ORDER BY step) AS so_far FROM tails)
    WHERE so_far GROUP BY stratum, rule
), broken AS (
    SELECT r, string_agg(rule, ',' ORDER BY place) AS listed
    FROM valued JOIN counted USING (r) JOIN cutoffs USING (rule)
    WHERE counted.stratum IS NOT DISTINCT FROM cutoffs.stratum AND v > cutoff GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND listed IS NULL AS kept, coalesce(listed, '') AS broken_rules
FROM counted LEFT JOIN broken USING (r)
"""


ORACLE: dict[str, str] = {
    "op9_risk_rules": risk_rules_sql(),
    "op11_hilbert_codes": _codes_sql(),
    "op12_hard_negatives": _NEGATIVES,
    "op13_suffix_arrays": _LEAKS,
}
