"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a document whose statistic exceeds a cutoff. Cutoffs are learned per stratum (language) from
labelled documents of good quality, the holdout: for every candidate cutoff the number x of good documents it
would reject, out of n, gives an exact binomial test. A cutoff is safe if P(Binomial(n, RISK / rules) <= x) is
at most the test's share of ALPHA: then, at confidence 1 - ALPHA over all strata and rules together, no more
than RISK of the good documents of a stratum are rejected. ALPHA is divided by strata x rules (Bonferroni);
along the candidates of one rule, which are fixed beforehand, tests go from the loosest to the strictest and
stop at the first that fails, which needs no further correction. The strictest safe cutoff is taken.

Equal texts of a stratum count once in the holdout, as copies are no independent trials. A stratum or rule without a
safe cutoff rejects nothing by that rule.

Defined cases: a null text and a text without words have zero counts and fail the base rule; a missing
language is a stratum of its own; labels that are null or of unknown documents play no part; a document with
several labels counts as good if one says so; repeated rows get equal verdicts; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import WHITE, cut

# Fixed values of the base rule.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
RISK = 0.05
ALPHA = 0.05
# Candidate cutoffs of every rule, from the loosest to the strictest.
CANDIDATES = {
    "symbol_share": [0.9, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05, 0.03, 0.02, 0.01],
    "repeat_share": [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05],
    "upper_share": [0.95, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1],
    "exclaim_share": [0.9, 0.6, 0.4, 0.25, 0.15, 0.1, 0.05, 0.02],
    "word_length": [60.0, 40.0, 25.0, 18.0, 14.0, 12.0, 10.0, 9.0, 8.0],
}
# The characters of WHITE, for trimming.
BLANKS = " \t\n\x0b\x0c\r"


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, a hash of the text and the counts of every row.

    Repeated 3-word windows are found inside the row: after one sort of the pairs of a window's whole hash and its
    place, equal hashes are neighbours and their places known.
    """
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(stratum).cast("string").alias("stratum"),
        F.col(text).alias("_text"),
        words.alias("_words"),
    ).withColumn("_n", F.size("_words"))
    windows = F.expr(
        "CASE WHEN _n < 4 THEN CAST(array() AS array<struct<h: bigint, p: bigint>>) ELSE sort_array(transform("
        "sequence(0, _n - 3), i -> named_struct('h', xxhash64(_words[i], _words[i + 1], _words[i + 2]), "
        "'p', CAST(i AS bigint)))) END"
    )
    rows = rows.withColumn("_windows", windows)
    same = (
        "filter(_windows, (w, k) -> "
        "(k > 0 AND _windows[greatest(k - 1, 0)].h = w.h) OR "
        "(k < size(_windows) - 1 AND _windows[least(k + 1, size(_windows) - 1)].h = w.h))"
    )
    places = f"sort_array(transform({same}, w -> w.p))"
    rows = rows.withColumn("_places", F.expr(places))
    covered = (
        "aggregate(_places, named_struct('n', 0L, 'next', 0L), (a, p) -> named_struct("
        "'n', a.n + p + 3 - greatest(p, a.next), 'next', p + 3), a -> a.n)"
    )
    lines = F.filter(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = rows.withColumn("_lines", lines)
    return rows.select(
        "doc_id",
        "stratum",
        F.xxhash64("_text").alias("text_hash"),
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.coalesce("_text", F.lit("")), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count(F.coalesce("_text", F.lit("")), F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(F.coalesce("_text", F.lit("")), F.lit("!")).cast("long").alias("n_exclaim"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def statistics() -> dict[str, Column]:
    """The statistic of each rule, in the order of CANDIDATES."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    made = {
        "symbol_share": F.col("n_symbols") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "exclaim_share": F.col("n_exclaim") / words,
        "word_length": F.col("word_chars") / words,
    }
    assert list(made) == list(CANDIDATES)
    return made


def log_binomial_cdf(n: str, x: str, p: float) -> Column:
    """log P(Binomial(n, p) <= x), summed term by term on a log scale; 0 <= x < n."""
    first = f"{n} * ln({1 - p!r}D)"
    term = f"(a.term + ln(({n} - i + 1) / CAST(i AS double) * {p / (1 - p)!r}D))"
    # ln(e^total + e^term) without overflow.
    total = f"(greatest(a.total, {term}) + ln(1 + exp(-abs(a.total - {term}))))"
    return F.expr(
        f"aggregate(sequence(0L, {x}), named_struct('term', {first}, 'total', {first}), "
        f"(a, i) -> CASE WHEN i = 0 THEN a ELSE named_struct('term', {term}, 'total', {total}) END, a -> a.total)"
    )


def exceeded(rule: str, value: Column) -> Column:
    """How many of a rule's candidates a value exceeds; those are the last ones."""
    return F.size(F.filter(F.array(*map(F.lit, CANDIDATES[rule])), lambda c: value > c))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """(stratum, rule, cutoff, n, x): the strictest safe cutoff of every stratum and rule that has one; there, x of
    the n good texts exceed the cutoff."""
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rules = [F.struct(F.lit(r).alias("rule"), exceeded(r, v).alias("over")) for r, v in statistics().items()]
    # Copies of a text are one trial: they all exceed a cutoff or none does.
    texts = measured.filter(~base_failed()).join(good, "doc_id").dropDuplicates(["stratum", "text_hash"])
    held = texts.select("stratum", F.inline(F.array(*rules)))
    wide = max(map(len, CANDIDATES.values()))
    # One row for each stratum and rule: the documents that exceed the strictest candidate, the next, ...
    over = [F.count_if(F.col("over") > k) for k in range(wide)]
    counts = cut(held.groupBy("stratum", "rule").agg(F.count(F.lit(1)).alias("n"), F.array(*over).alias("_over")))
    return safe(counts, risk, alpha)


def safe(counts: DataFrame, risk: float, alpha: float) -> DataFrame:
    """``cutoffs`` from (stratum, rule, n, _over), a handful of rows for each stratum."""
    bounds = F.create_map(*[x for r, c in CANDIDATES.items() for x in (F.lit(r), F.array(*map(F.lit, c)))])
    tests = counts.select(
        "stratum", "rule", "n", "_over", F.size(bounds[F.col("rule")]).alias("_k"),
        F.posexplode(bounds[F.col("rule")]).alias("step", "cutoff"),
    ).withColumn("x", F.expr("_over[_k - 1 - step]"))
    share = risk / len(CANDIDATES)
    strata = counts.select("stratum").distinct().agg(F.count(F.lit(1))).scalar()
    # Where more than the allowed share is exceeded, the probability is far above any level.
    probability = F.when(F.col("x") > F.col("n") * share, F.lit(0.0)).otherwise(log_binomial_cdf("n", "x", share))
    along = Window.partitionBy("stratum", "rule").orderBy("step")
    return (
        tests.withColumn("_safe", probability <= F.log(F.lit(alpha) / (strata * len(CANDIDATES))))
        .withColumn("_so_far", F.min(F.col("_safe").cast("int")).over(along))
        .filter("_so_far = 1")
        .groupBy("stratum", "rule", "n")
        .agg(F.min("cutoff").alias("cutoff"), F.max("x").alias("x"))
    )


def verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, alpha: float = ALPHA) -> DataFrame:
    """Counts, base_failed, kept and the rules that reject, for every row."""
    measured = cut(measures(docs))
    bounds = (
        cutoffs(measured, labels, risk, alpha)
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_bounds"))
        .withColumnRenamed("stratum", "_stratum")
    )
    broken = F.array_compact(
        F.array(*[F.when(value > F.col("_bounds")[rule], F.lit(rule)) for rule, value in statistics().items()])
    )
    # One row for each language; a language without hundreds of labelled good documents has no safe cutoff and no row.
    return (
        measured.join(F.broadcast(bounds), measured["stratum"].eqNullSafe(bounds["_stratum"]), "left")
        .withColumn("_broken", F.coalesce(broken, F.array().cast("array<string>")))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            base_failed().alias("base_failed"),
            (~base_failed() & (F.size("_broken") == 0)).alias("kept"),
            F.array_join("_broken", ",").alias("broken_rules"),
        )
    )
