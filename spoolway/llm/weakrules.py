"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import stored
from spoolway.llm.textstats import ratios, with_stats

#: Each rule: the ratio it reads, the range that speaks for a text (or none), and bounds
#: beyond which it speaks against it. Otherwise it abstains.
RULES: dict[str, tuple[str, tuple[float, float] | None, tuple[float, float]]] = {
    "symbols": ("symbols", None, (-1.0, 0.1)),
    "shouts": ("shouts", None, (-1.0, 0.3)),
    "upper": ("upper", None, (-1.0, 0.3)),
    "repeats": ("repeats", None, (-1.0, 0.2)),
    "dup_lines": ("dup_lines", None, (-1.0, 0.5)),
    "digits": ("digits", None, (-1.0, 0.6)),
    "word_length": ("word_length", (3.5, 9.0), (2.0, 20.0)),
    "distinct": ("distinct", (0.3, 1.0), (0.05, 2.0)),
    "stops": ("stops", (0.01, 0.4), (-1.0, 0.9)),
}
#: Where the estimates start: shares of good and of bad texts that get a vote for them, and how
#: often a vote against a text is right. A rule speaks against a text for a gross fault only, so
#: such votes are trusted; that a text looks usual is weak evidence. Faults hardly ever come
#: together, so the start weighs in on the estimates, in proportion to the rows: as much as
#: ``FOR_WEIGHT`` times all texts, and as ``AGAINST_WEIGHT`` times the votes that were cast. No
#: estimate is held within a range, so texts that look good otherwise can outvote a rule.
START_FOR, START_AGAINST = (0.85, 0.5), 0.98
FOR_WEIGHT, AGAINST_WEIGHT = 0.1, 2.0
START_PRIOR, PRIOR = 0.8, (0.5, 0.99)
ROUNDS = 200


def votes() -> Column:
    """The votes as one string, a character for each rule: 1 for, 0 against, - abstaining.

    A text without words gets no vote at all.
    """
    ratio = ratios()
    cast = []
    for name, usual, (under, over) in RULES.values():
        x = ratio[name]
        vote = F.when(F.col("stats.n_words") == 0, "-").when((x < under) | (x > over), "0")
        if usual:
            vote = vote.when((x >= usual[0]) & (x <= usual[1]), "1")
        cast.append(vote.otherwise("-"))
    return F.concat(*cast)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


@dataclass(frozen=True)
class Model:
    """Share of good texts; of each rule the shares of good and of bad texts that it speaks for, and how
    often it is right when it speaks against a text."""

    prior: float
    speaks_for: tuple[tuple[float, float], ...]
    against: tuple[float, ...]

    def weights(self, j: int) -> tuple[float, float]:
        """What a vote of rule ``j`` for a text, and one against it, adds to the log-odds."""
        good, bad = self.speaks_for[j]
        # the prior is part of how often a vote against is right, and counts once
        return math.log(good / bad), -_logit(self.against[j]) - _logit(self.prior)

    def log_odds(self, pattern: str) -> float:
        odds = _logit(self.prior)
        for j, vote in enumerate(pattern):
            a, b = self.weights(j)
            odds += a if vote == "1" else b if vote == "0" else 0.0
        return odds

    def posterior(self, pattern: Column) -> Column:
        """The same as a Spark column over a column of vote strings."""
        odds = F.lit(_logit(self.prior))
        for j in range(len(self.against)):
            vote, (a, b) = F.substring(pattern, j + 1, 1), self.weights(j)
            odds += F.when(vote == "1", a).when(vote == "0", b).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(patterns: dict[str, int]) -> Model:
    """Expectation-maximisation over the counts of vote strings, of which there are 3^rules at most.

    Without rows it returns the starting values; so it does for the accuracy of a rule that never
    speaks against a text.
    """
    rules, total = len(RULES), sum(patterns.values())
    model = Model(START_PRIOR, (START_FOR,) * rules, (START_AGAINST,) * rules)
    known = FOR_WEIGHT * total

    def spoke_for(j: int, good: dict[str, float]) -> tuple[float, float]:
        cast = [(good[p], n) for p, n in patterns.items() if p[j] == "1"]
        all_good = sum(good[p] * n for p, n in patterns.items())
        return (
            (known * START_FOR[0] + sum(w * n for w, n in cast)) / (known + all_good),
            (known * START_FOR[1] + sum((1 - w) * n for w, n in cast)) / (known + total - all_good),
        )

    def right_against(j: int, good: dict[str, float]) -> float:
        cast = [(good[p], n) for p, n in patterns.items() if p[j] == "0"]
        votes = sum(n for _, n in cast)
        trusted = 1 + AGAINST_WEIGHT * votes
        return (trusted * START_AGAINST + sum((1 - w) * n for w, n in cast)) / (trusted + votes)

    for _ in range(ROUNDS if total else 0):
        good = {p: 1 / (1 + math.exp(-model.log_odds(p))) for p in patterns}
        share = (known * START_PRIOR + sum(good[p] * n for p, n in patterns.items())) / (known + total)
        after = Model(
            min(max(share, PRIOR[0]), PRIOR[1]),
            tuple(spoke_for(j, good) for j in range(rules)),
            tuple(right_against(j, good) for j in range(rules)),
        )
        moved = max(
            abs(a - b)
            for a, b in zip(
                (model.prior, *sum(model.speaks_for, ()), *model.against), (after.prior, *sum(after.speaks_for, ()), *after.against)
            )
        )
        model = after
        if moved < 1e-7:
            break
    return model


def base_failed() -> Column:
    n = F.col("stats.n_words")
    return (n < 10) | (100 * F.col("stats.n_repeat_words") > 20 * n)


def scored(docs: DataFrame, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``stats``, ``votes``, ``quality`` (posterior of a good text) and ``kept`` to each row.

    ``kept`` asks for no base failure and a posterior of 0.5 or more. The estimates come
    from all rows of ``docs``: vote strings are counted in Spark and the counts, bounded
    by the number of rules, are fitted. Rows with equal texts get equal results. Null,
    empty and white-space texts have no words, no votes, and are not kept.

    Rows and votes are stored in between, without the columns ``drop``: so the costly
    statistics are computed once and never copied into a later filter. The four names must be new ones.
    """
    if taken := {"stats", "votes", "quality", "kept"} & set(docs.columns):
        raise ValueError(f"columns {sorted(taken)} are there already")
    voted = stored(with_stats(docs, text).withColumn("votes", votes()).drop(*drop), "votes")
    counts = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # 3^9 rows at most
    model = fit({r["votes"]: r["n"] for r in counts})
    voted = voted.withColumn("quality", model.posterior(F.col("votes")))
    return voted.withColumn("kept", ~base_failed() & (F.col("quality") >= 0.5))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``scored`` keeps, with the columns of ``docs``.

    Rows are stored with their votes and counts in between, so the costly statistics are computed once.
    """
    voted = with_stats(docs.select(F.struct("*").alias("row")), f"row.{text}").withColumn("votes", votes())
    voted = stored(voted, "votes")
    counts = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # 3^9 rows at most
    model = fit({r["votes"]: r["n"] for r in counts})
    return voted.where(~base_failed() & (model.posterior(F.col("votes")) >= 0.5)).select("row.*")
