"""Quality of texts by weak supervision.

Each rule looks at one property of a text and votes good (1), bad (0) or abstains (-1). No rule
decides alone: expectation-maximisation estimates how often each rule votes for good and for bad
texts from the agreement of the rules over all documents, and the posterior probability of "good"
replaces the conjunction of all filters. Only SQL expressions touch the rows. The model is fitted
on the counts of vote patterns, of which there are at most 3 ** len(RULES), however many documents
there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, staged, text_or_empty, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the four languages. Fixed values.
STOP_WORDS = (
    "the of and to a in is that it for was on as with be by this are at from or an "
    "der die und den das von zu mit ist ein eine sich des auf für im dem nicht auch "
    "de la le les des et un une que qui en dans est pour pas sur par au du avec "
    "el los las y del se por con para su al lo como una es"
).split()


@dataclass(frozen=True)
class Rule:
    """Votes good or bad by one measure, and abstains between the two limits or where a limit is None."""

    name: str
    measure: str
    good: float | None
    bad: float | None
    more_is_better: bool = False

    def vote(self) -> Column:
        m = F.col(self.measure)
        reaches = (lambda x: m >= x, lambda x: m <= x) if self.more_is_better else (lambda x: m <= x, lambda x: m >= x)
        out = F.lit(None).cast("int")
        if self.good is not None:
            out = F.when(reaches[0](self.good), 1)
        if self.bad is not None:
            out = F.when(reaches[1](self.bad), 0).otherwise(out)
        return F.coalesce(out, F.lit(-1)).cast("int")


RULES = (
    Rule("symbols", "symbol_ratio", None, 0.25),
    Rule("repeats", "repeat_ratio", None, 0.30),
    Rule("lines", "dup_line_ratio", None, 0.50),
    Rule("runs", "run_ratio", None, 0.25),
    Rule("capitals", "capital_ratio", None, 0.50),
    Rule("shouting", "shout_ratio", None, 0.40),
    Rule("variety", "variety", 0.60, 0.30, True),
    # a text of another language has none of these words, so few of them say nothing
    Rule("function_words", "function_word_level", 0.30, None, True),
    Rule("word_length", "mean_length_gap", 1.5, 4.0),
)
OUTCOMES = (-1, 0, 1)


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the counts of the contract, and the measures the rules look at.

    A null or blank text has no words; all its counts are 0. Rows are never merged, so repeated
    rows and null ids come back as they are. Other columns of `docs` are left behind.
    """
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_words", words(text)).withColumn("n_words", F.size("_words").cast("long"))
    rows = rows.withColumn(
        "_lines",
        F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACE)) != ""),
    )
    keys = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get("_words", i + k) for k in range(1, WINDOW))),
    )
    rows = rows.withColumn("_keys", keys)
    # keys that occur twice, found by sorting the keys of such texts only; then the words they cover
    copied = F.size(F.array_distinct("_keys")) < F.size("_keys")
    tagged = F.transform("_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    rows = rows.withColumn("_sorted", F.when(copied, F.array_sort(tagged)))

    def repeated(x: Column, j: Column) -> Column:
        same = [F.coalesce(F.get("_sorted", j + d)["k"] == x["k"], F.lit(False)) for d in (-1, 1)]
        return F.when(same[0] | same[1], x["i"])

    starts = F.array_sort(F.filter(F.transform("_sorted", repeated), lambda i: i.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    squeezed = F.translate(text, SPACE, "")
    n = F.greatest(F.col("n_words"), F.lit(1))
    rows = rows.select(
        "*",
        F.length(squeezed).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        (F.length(squeezed) - F.length(F.translate(squeezed, "!?", ""))).alias("_shouts"),
        (F.length(squeezed) - F.length(F.regexp_replace(squeezed, r"\p{Lu}+", ""))).alias("_capitals"),
        F.size(F.array_intersect("_words", F.array(*map(F.lit, STOP_WORDS)))).alias("_stops"),
        F.size(F.filter("_words", lambda w, i: F.coalesce(w == F.get("_words", i + 1), F.lit(False)))).alias("_runs"),
    )
    return rows.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("n_repeat_words") / n).alias("repeat_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.size("_lines"), F.lit(1))).alias("dup_line_ratio"),
        (F.col("_runs") / n).alias("run_ratio"),
        # long texts reuse words: what counts is variety against the square root of the length
        F.least(F.lit(1.0), F.col("_distinct") / F.least(n, 40 * F.sqrt(n / 40.0))).alias("variety"),
        (F.col("_capitals") / F.greatest(F.col("word_chars"), F.lit(1))).alias("capital_ratio"),
        (F.col("_shouts") / n).alias("shout_ratio"),
        # there are only so many function words, so beyond 400 different words more are not expected
        (F.col("_stops") / F.sqrt(F.least(F.greatest(F.col("_distinct"), F.lit(1)), F.lit(400)))).alias("function_word_level"),
        F.abs(F.col("word_chars") / n - 5.5).alias("mean_length_gap"),
    )


def evidence(good: dict[int, float], bad: dict[int, float], vote: int) -> float:
    """What a vote adds to the log odds of a good text. To abstain tells the classes apart when the model is
    fitted, but never counts against a text: a rule that cannot judge a kind of text, such as another
    language, leaves it to the others."""
    weight = math.log(good[vote] / bad[vote])
    return max(0.0, weight) if vote == -1 else weight


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and per rule how often good and bad texts get each outcome."""

    prior: float
    good: tuple[dict[int, float], ...]
    bad: tuple[dict[int, float], ...]

    def accuracies(self) -> dict[str, float]:
        """Of the texts on which a rule votes, the share on which it is right."""
        out = {}
        for rule, g, b in zip(RULES, self.good, self.bad):
            right = self.prior * g[1] + (1 - self.prior) * b[0]
            out[rule.name] = right / (right + self.prior * g[0] + (1 - self.prior) * b[1])
        return out

    def posterior(self) -> Column:
        """Probability that a row with these vote columns is good."""
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, g, b in zip(RULES, self.good, self.bad):
            vote = F.col(f"vote_{rule.name}")
            weight = {v: evidence(g, b, v) for v in OUTCOMES}
            logit = logit + F.when(vote == 1, weight[1]).when(vote == 0, weight[0]).otherwise(weight[-1])
        return 1.0 / (1.0 + F.exp(-logit))


def with_votes(measures: DataFrame) -> DataFrame:
    return measures.select("*", *(r.vote().alias(f"vote_{r.name}") for r in RULES))


def fit_label_model(
    votes: DataFrame, rounds: int = 100, floor: float = 0.003, most_errors: float = 0.01
) -> LabelModel:
    """Expectation-maximisation on the counts of vote patterns.

    Good and bad texts differ in how often a rule votes good, bad, or abstains. The start takes a
    pattern for good unless bad votes outweigh it, which also fixes which class is called good.
    `floor` is the least share of each outcome: a rule that has never erred may still err. The limits for
    bad votes are wide, so no rule is believed to vote bad on more than `most_errors` of the good texts, else a frequent kind of junk
    could pass for a kind of good text. Texts without words are left out. With no rows the model is
    the starting one.
    """
    names = [f"vote_{r.name}" for r in RULES]
    counted = votes.where("n_words > 0").groupBy(*names).agg(F.count("*").alias("n")).collect()  # <= 3 ** rules rows
    patterns = sorted((tuple(r[n] for n in names), r["n"]) for r in counted)
    total = sum(n for _, n in patterns)
    chance = [1 / (1 + math.exp(2.0 * p.count(0) - 0.5 * p.count(1) - 1.0)) for p, _ in patterns]

    def shares(i: int, weights: list[float], lean: int) -> dict[int, float]:
        count = {v: 1.0 + (v == lean) for v in OUTCOMES}
        for w, (p, _) in zip(weights, patterns):
            count[p[i]] += w
        whole = sum(count.values())
        share = {v: floor + (1 - 3 * floor) * count[v] / whole for v in OUTCOMES}
        if lean == 1 and share[0] > most_errors:
            rest = (1 - most_errors) / (1 - share[0])
            share = {v: most_errors if v == 0 else share[v] * rest for v in OUTCOMES}
        return share

    for _ in range(rounds):
        ups = [c * n for c, (_, n) in zip(chance, patterns)]
        downs = [(1 - c) * n for c, (_, n) in zip(chance, patterns)]
        prior = (sum(ups) + 9) / (total + 10)
        good = tuple(shares(i, ups, 1) for i in range(len(RULES)))
        bad = tuple(shares(i, downs, 0) for i in range(len(RULES)))
        was, chance = chance, []
        for p, _ in patterns:
            logit = math.log(prior / (1 - prior)) + sum(math.log(good[i][v] / bad[i][v]) for i, v in enumerate(p))
            chance.append(1 / (1 + math.exp(-logit)))
        if all(abs(a - b) < 1e-9 for a, b in zip(was, chance)):
            break
    return LabelModel(prior, good, bad)


def base_failed() -> Column:
    """The two rules that no vote can outweigh: too short, or mostly repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.9
) -> DataFrame:
    """Measures, votes, `posterior` and `kept` of every row of `docs`.

    `kept` is false where `base_failed`, else whether the posterior reaches `threshold`. An empty
    table gives an empty result. Equal texts get equal verdicts.
    """
    votes = staged(with_votes(text_measures(docs, id_col, text_col)), "votes")
    model = fit_label_model(votes)
    failed = base_failed()
    return votes.select(
        "*",
        model.posterior().alias("posterior"),
        failed.alias("base_failed"),
        (~failed & (model.posterior() >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is kept.

    The rows are written down with their votes before the model is fitted, so that the verdict is a
    look at the votes; no join is needed, and repeated rows or null ids are no matter.
    """
    names = docs.columns
    whole = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("text"))
    votes = with_votes(text_measures(whole, "row", "text"))
    votes = staged(votes.select("row", "n_words", "n_repeat_words", *(f"vote_{r.name}" for r in RULES)), "votes")
    model = fit_label_model(votes)
    kept = votes.where(~base_failed() & (model.posterior() >= threshold))
    return kept.select(*(F.col("row")[c].alias(c) for c in names))
