"""Quality by weak supervision: rules vote, expectation-maximisation weighs them.

Every rule votes for keeping, for rejecting, or abstains. The rules know nothing of labels;
how far to trust each of them is estimated from how they agree over all documents, and the
posterior probability of good quality decides. All measures are SQL expressions. The estimate
needs only how often each pattern of votes occurs, a table whose size depends on the number of
rules alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.text import WORD, stored, word_list

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
WINDOW = 3

KEEP, ABSTAIN, REJECT = 1, 0, -1


# Frequent words of running text in English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that was for it with as be by on this are or from at a an "
    "der die das und den von zu mit ist im des auf für sich nicht ein eine dem es auch "
    "le la les de et un une que dans pour du est par sur en au il ne pas qui "
    "el los las y del por con para se su al lo como más pero sus o si"
).split()

# Rule: name -> (rejects, keeps); it abstains where neither holds or a measure is null.
# A defect that is absent says little, so most rules only reject.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("100 * n_symbols > 10 * n_words", "false"),
    "bare_symbols": ("100 * n_bare > 15 * n_words", "false"),
    "capitals": ("100 * n_upper > 40 * word_chars", "false"),
    "shouting": ("100 * n_shouts > 10 * n_words", "false"),
    "repeated_words": ("100 * n_repeat_words > 30 * n_words", "false"),
    "repeated_lines": ("100 * n_dup_lines > 30 * n_lines", "false"),
    # Says nothing where most letters are of a script that none of the four languages is written in.
    "function_words": (
        "100 * n_function < 4 * n_words and 2 * n_other_script <= n_letters",
        "100 * n_function > 10 * n_words",
    ),
    "sentences": ("80 * n_stops < n_words", "40 * n_stops > n_words"),
    "word_length": (
        "word_chars < 2.5 * n_words or word_chars > 14 * n_words",
        "word_chars between 3 * n_words and 10 * n_words",
    ),
}
# Rejections are rare in good texts; the estimate starts from there, and the weight keeps it from
# running off on small tables.
PRIOR_GOOD = 0.85
PRIOR_WEIGHT = 20.0
START = {
    "good": {KEEP: 0.49, ABSTAIN: 0.49, REJECT: 0.02},
    "bad": {KEEP: 0.3, ABSTAIN: 0.4, REJECT: 0.3},
}
MAX_ROUNDS = 200


def with_measures(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``row`` with the given columns (all by default), and a column for each measure."""
    words = word_list(F.col(text))
    lines = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda line: line.rlike(WORD)
    )
    body = F.coalesce(F.col(text), F.lit(""))
    function_words = {*FUNCTION_WORDS, *(w.capitalize() for w in FUNCTION_WORDS)}
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"),
        words.alias("words"),
        lines.alias("lines"),
        body.alias("body"),
    )
    hashed = base.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("lines")).cast("long").alias("n_distinct_lines"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("body", F.lit(r"[.!?](?=\s|$)")).cast("long").alias("n_stops"),
        F.regexp_count("body", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.regexp_count("body", F.lit(r"[\p{L}&&[^\p{IsLatin}]]")).cast("long").alias("n_other_script"),
        F.regexp_count("body", F.lit("!!")).cast("long").alias("n_shouts"),
        F.size(F.filter("words", lambda w: w.isin(*sorted(function_words)))).cast("long").alias("n_function"),
        F.regexp_count("body", F.lit(r"(?<!\S)[^\s\p{L}\p{N}]+(?!\S)")).cast("long").alias("n_bare"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    windows = hashed.withColumn(
        "w",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.slice("h", 1, F.size("h") - (WINDOW - 1)),
                lambda _, i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]),
            ),
        ),
    )
    # Where a window occurs twice: windows with their place, ordered, so that equal ones are
    # neighbours. Most texts repeat none and skip this.
    placed = windows.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("w")) < F.size("w"),
            F.sort_array(F.transform("w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    at = F.sort_array(
        F.transform(
            F.filter(
                "s",
                lambda x, k: (x["h"] == F.get("s", k - 1)["h"])
                | (x["h"] == F.get("s", k + 1)["h"]),
            ),
            lambda x: x["i"],
        )
    )
    # Words covered by repeated windows: each window adds what the one before does not cover.
    covered = F.aggregate(
        at,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_upper", "n_stops", "n_shouts"]
    names += ["n_function", "n_bare", "n_letters", "n_other_script"]
    return placed.select(
        "row",
        *names,
        (F.col("n_lines") - F.col("n_distinct_lines")).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def with_votes(measured: DataFrame, rules: dict[str, tuple[str, str]] = RULES) -> DataFrame:
    """Adds an array ``votes`` in the order of the rules."""
    votes = [
        F.when(F.coalesce(F.expr(bad), F.lit(False)), F.lit(REJECT))
        .when(F.coalesce(F.expr(good), F.lit(False)), F.lit(KEEP))
        .otherwise(F.lit(ABSTAIN))
        for bad, good in rules.values()
    ]
    return measured.withColumn("votes", F.array(*votes))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * 50
    )


@dataclass
class VoteModel:
    """Log-odds of good quality: ``bias`` and, for each rule, what each vote adds."""

    bias: float
    weights: list[dict[int, float]]

    def posterior(self, votes: Column) -> Column:
        score = F.lit(self.bias)
        for k, weight in enumerate(self.weights):
            vote = F.get(votes, F.lit(k))
            score = score + F.when(vote == KEEP, weight[KEEP]).when(
                vote == REJECT, weight[REJECT]
            ).otherwise(weight[ABSTAIN])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def estimate(patterns: list[tuple[list[int], int]], n_rules: int) -> VoteModel:
    """Expectation-maximisation over (votes, count): how each class votes, and its share.

    Given the class, rules vote independently. ``START`` and ``PRIOR_GOOD`` also count as
    ``PRIOR_WEIGHT`` documents of each class, so that a table without bad documents keeps sane
    weights and the classes cannot swap.
    """
    good, bad = ([dict(START[c]) for _ in range(n_rules)] for c in ("good", "bad"))
    share = PRIOR_GOOD
    for _ in range(MAX_ROUNDS):
        sums = {c: [dict.fromkeys((KEEP, ABSTAIN, REJECT), 0.0) for _ in range(n_rules)] for c in (0, 1)}
        mass = [0.0, 0.0]
        for votes, count in patterns:
            logs = [math.log(1 - share), math.log(share)]
            for k, vote in enumerate(votes):
                logs[0] += math.log(bad[k][vote])
                logs[1] += math.log(good[k][vote])
            p = 1.0 / (1.0 + math.exp(min(700.0, logs[0] - logs[1])))
            for c, weight in ((0, (1 - p) * count), (1, p * count)):
                mass[c] += weight
                for k, vote in enumerate(votes):
                    sums[c][k][vote] += weight
        moved = 0.0
        for c, table, start in ((0, bad, START["bad"]), (1, good, START["good"])):
            for k in range(n_rules):
                for vote in (KEEP, ABSTAIN, REJECT):
                    new = (sums[c][k][vote] + PRIOR_WEIGHT * start[vote]) / (mass[c] + PRIOR_WEIGHT)
                    moved = max(moved, abs(new - table[k][vote]))
                    table[k][vote] = new
        total = mass[0] + mass[1]
        new_share = (mass[1] + PRIOR_WEIGHT * PRIOR_GOOD) / (total + PRIOR_WEIGHT)
        moved, share = max(moved, abs(new_share - share)), new_share
        if moved < 1e-7:
            break
    return VoteModel(
        math.log(share / (1 - share)),
        [
            {v: math.log(good[k][v] / bad[k][v]) for v in (KEEP, ABSTAIN, REJECT)}
            for k in range(n_rules)
        ],
    )


def fit(voted: DataFrame, n_rules: int = len(RULES)) -> VoteModel:
    """Estimate from all rows that pass the base rules.

    What comes to the driver is at most ``2 * 3 ** n_rules`` rows, whatever the size of the table.
    """
    failed = base_failed().alias("failed")
    counts = voted.select("votes", failed).groupBy("votes", "failed").count().collect()
    patterns = sorted((list(r["votes"]), r["count"]) for r in counts if not r["failed"])
    return estimate(patterns, n_rules)


def judged(
    docs: DataFrame,
    text: str = "text",
    rules: dict[str, tuple[str, str]] = RULES,
    columns: list[str] | None = None,
) -> DataFrame:
    """(row, measures, votes, base_failed, quality, kept) for every row.

    Null text counts as empty: no words, all measures 0, not kept. A text under ``MIN_WORDS``
    words, or in which repeated windows of three words cover more than half of the words, fails
    without a vote; any other is kept where its probability of good quality is at least 0.5.
    Repeated rows are judged alike, each counts in the estimate; an empty table gives no rows.
    Any other columns pass through in ``row`` untouched, whatever their names; ``columns`` names
    those that ``row`` shall hold. The votes are written once: the estimate and the verdict read
    them, and the measures are not taken twice.
    """
    voted = stored(with_votes(with_measures(docs, text, columns), rules), "quality-votes")
    model = fit(voted, len(rules))
    quality = model.posterior(F.col("votes"))
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )


def kept_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns, as ``judged`` decides.

    The measures are taken once for the estimate and again for the verdict: that writes no copy of
    the texts.
    """
    model = fit(with_votes(with_measures(docs, text)))
    voted = with_votes(with_measures(docs, text))
    kept = ~base_failed() & (model.posterior(F.col("votes")) >= 0.5)
    # A generator instead of a filter, which Spark would push down with all measures copied into it.
    once = F.when(kept, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return voted.select("row", F.explode(once)).select("row.*")
