"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every document gets its measures inside its own row (no shuffle): repeated three-word windows
are found by sorting the windows' hashes with their positions.  Five rules turn the measures
into votes (1 good, -1 bad, 0 abstain).  The corpus is then summed up by vote pattern - at most
3^5 rows whatever the number of documents - and expectation-maximisation over those counts
estimates, for either class, how often each rule says what; abstaining is an outcome too.  The
posterior probability of "good" is a sum of log-likelihood ratios written as a column.

The measures (a few numbers per document) are checkpointed once, as they feed both the pattern
counts and the result; texts are read once.

Defined cases: null or empty text has no words and fails the base rule; repeated rows are scored
alike; with an empty table the result is empty; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, documents, let, text_of, words_of

MIN_WORDS = 50
EM_ROUNDS = 50
MIN_POSTERIOR = 0.5
SYMBOLS = r"[#*$%&|<>]"
#: A whole word of letters with at most one mark after it.
PLAIN = r"(?<![^\x20\x09-\x0D])[\p{L}\p{M}'\u2019-]++[.,;:!?)]?(?![^\x20\x09-\x0D])"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_plain", "n_distinct", "n_stutters"]


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more, the first included."""
    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def twins(s: Column) -> Column:
            m = F.size(s) - 1
            both = F.zip_with(F.slice(s, F.lit(1), m), F.slice(s, F.lit(2), m),
                              lambda a, b: F.when(a.h == b.h, F.array(a.p, b.p)))
            starts = F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull())))
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, twins))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows(words), covered))


def measures(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def of(w: Column) -> Column:
        n = F.size(w)
        stutters = F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda s: F.struct((F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("dup"),
                                          F.size(s).cast("long").alias("all"))).alias("lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count(text, F.lit(PLAIN)).cast("long").alias("n_plain"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            stutters.cast("long").alias("n_stutters"))

    return let(words_of(text), of)


def measured(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", measures(text_of()).alias("m"))
    return rows.select("doc_id", *[F.col({"n_dup_lines": "m.lines.dup", "n_lines": "m.lines.all"}.get(c, f"m.{c}")).alias(c)
                                   for c in MEASURES])


def rules() -> dict[str, tuple[Column, Column]]:
    """Name -> (votes bad, votes good); neither: abstains.  Shares are per word or per character.

    The model takes rules as independent given the class, so measures of one trait (repeated
    windows, stutters, poor vocabulary) make one rule rather than three echoes of it.
    """
    c = {m: F.col(m) for m in MEASURES}
    n, chars = c["n_words"], c["word_chars"]
    return {
        "symbols": (20 * c["n_symbols"] > n, 100 * c["n_symbols"] <= n),
        "plain_words": (10 * c["n_plain"] < 7 * n, 10 * c["n_plain"] >= 9 * n),
        "repetition": ((4 * c["n_repeat_words"] > n) | (4 * c["n_distinct"] < n) | (12 * c["n_stutters"] > n),
                       (10 * c["n_repeat_words"] <= n) & (2 * c["n_distinct"] >= n) & (25 * c["n_stutters"] <= n)),
        "lines": (3 * c["n_dup_lines"] > c["n_lines"], c["n_dup_lines"] == 0),
        "upper": (8 * c["n_upper"] > chars, 20 * c["n_upper"] <= chars),
    }


def votes() -> list[Column]:
    return [F.when(bad, -1).when(good, 1).otherwise(0).cast("int").alias(f"v_{name}") for name, (bad, good) in rules().items()]


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """EM over (votes, count): the log prior odds of good and, per rule, the log ratio of each vote.

    Starts from "a document that any rule calls bad is probably bad"; add-one smoothing keeps
    every outcome possible.  Works on at most 3^rules patterns.
    """
    if not patterns:
        return 0.0, []
    k = len(patterns[0][0])
    post = [0.1 if -1 in v else 0.9 for v, _ in patterns]
    prior, ratio = 0.0, [{-1: 0.0, 0: 0.0, 1: 0.0} for _ in range(k)]
    for _ in range(rounds):
        good = sum(p * n for p, (_, n) in zip(post, patterns))
        bad = sum((1 - p) * n for p, (_, n) in zip(post, patterns))
        prior = math.log((good + 1) / (bad + 1))
        for j in range(k):
            g, b = {-1: 1.0, 0: 1.0, 1: 1.0}, {-1: 1.0, 0: 1.0, 1: 1.0}
            for p, (v, n) in zip(post, patterns):
                g[v[j]] += p * n
                b[v[j]] += (1 - p) * n
            ratio[j] = {x: math.log(g[x] / (good + 3)) - math.log(b[x] / (bad + 3)) for x in g}
        post = [1 / (1 + math.exp(-max(-500.0, min(500.0, prior + sum(ratio[j][x] for j, x in enumerate(v))))))
                for v, _ in patterns]
    return prior, ratio


def judged(docs: DataFrame, rounds: int = EM_ROUNDS, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """doc_id, the measures, the votes, base_failed, posterior and kept."""
    rows = measured(docs).select("*", *votes()).checkpoint(eager=True)
    names = [f"v_{r}" for r in rules()]
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(f"{OWN}n")).orderBy(*names).collect()  # at most 3^5 rows
    prior, ratio = fit([(tuple(r[x] for x in names), r[f"{OWN}n"]) for r in counts], rounds)
    odds = F.lit(prior)
    for name, by_vote in zip(names, ratio):
        odds = odds + F.when(F.col(name) == -1, by_vote[-1]).when(F.col(name) == 1, by_vote[1]).otherwise(by_vote[0])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
