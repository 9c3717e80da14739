"""Quality rules as weak supervision: rules vote or abstain, and expectation maximisation weighs them.

Every rule looks at a text's counts and votes `good` or `bad`, or abstains.  How often a rule votes what on good and on
bad documents is not known; it is estimated without labels by expectation maximisation over the counts of vote
patterns.  The posterior probability of `good` then decides, in place of a demand that every rule pass.

Only Spark's own functions touch rows.  A text is read once: its counts are stored as a slim table, from which the
patterns are counted (three votes per rule, so at most 3^9 patterns, whatever the input) and the rows are scored.
The estimate starts from the rules' own word, one bad vote being some evidence and two strong evidence, and a prior of
a twentieth of the rows keeps a rule that never decides anything from taking over a class.

Windows of words are compared by 64-bit hashes.  Defined cases: a null text has no words and is the empty one; texts
under ten words fail the base rule.  Every row is judged, repeated ones each by itself; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.registry import query

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
ABSTAIN, GOOD, BAD = 0, 1, 2


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains.  Both are SQL over the counts."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        bad, good = F.expr(self.bad), F.expr(self.good)
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN).cast("int")


RULES = (
    Rule("length", "n_words < 10", "n_words >= 40"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines > 2"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 2 * n_words AND n_words >= 40"),
    Rule("capitals", "10 * n_capitals > 5 * n_letters", "10 * n_capitals < 2 * n_letters AND n_letters > 0"),
    Rule("letters", "10 * n_letters < 8 * word_chars", "10 * n_letters >= 9 * word_chars"),
    Rule("bare_marks", "10 * n_bare > 2 * n_words", "20 * n_bare < n_words"),
    Rule("shouting", "10 * n_marks > 3 * n_words", "10 * n_marks < n_words"),
)


def text_counts(text: Column) -> dict[str, Column]:
    """Counts that need no word list."""

    def without(marks: str) -> Column:
        return F.length(F.translate(text, marks, ""))

    return {
        "word_chars": without(SPACES).cast("long"),
        "n_symbols": (F.length(text) - without(SYMBOLS)).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
        "n_marks": (F.length(text) - without("!?")).cast("long"),
    }


def repeat_words(words: Column, hashes: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window whose hash occurs twice or more in `hashes`.

    Equal hashes are put side by side by sorting (hash, place); a place whose neighbour has its hash counts the words up
    to the next such place, at most a window.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(sorted_pairs: Column) -> Column:
        n = F.size(sorted_pairs)
        kept = F.filter(
            sorted_pairs,
            lambda x, j: ((j > 0) & (F.get(sorted_pairs, j - 1)["h"] == x["h"])) | ((j < n - 1) & (F.get(sorted_pairs, j + 1)["h"] == x["h"])),
        )
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last"))
        step = lambda s, p: F.struct((s["n"] + F.least(F.lit(window), p - s["last"])).alias("n"), p.alias("last"))
        return F.aggregate(places, state, step, lambda s: s["n"])

    once = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  evaluates `value` once
    counted = once(once(pairs, twice), covered)
    return F.when(F.size(hashes) > F.size(F.array_distinct(hashes)), counted).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the counts of each text, one row per row."""
    slim = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    worded = slim.withColumn("_w", F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_w") - WINDOW),
        lambda i: F.xxhash64(*(F.get(F.col("_w"), i + k) for k in range(WINDOW))),
    )
    hashed = worded.withColumns(
        {
            "_h": F.when(F.size("_w") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")),
            "_l": F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    return hashed.select(
        key,
        F.size("_w").cast("long").alias("n_words"),
        *(c.alias(name) for name, c in text_counts(F.col("_t")).items()),
        F.size(F.filter("_w", lambda w: ~w.rlike(r"\p{L}"))).cast("long").alias("n_bare"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w"), F.col("_h")).alias("n_repeat_words"),
    )


def estimate(patterns: dict[tuple[int, ...], int], width: int, rounds: int = 60, prior: float = 0.05, least: float = 8.0) -> tuple[float, list[list[list[float]]]]:
    """(P(good), for each rule its vote probabilities on bad and on good documents), from counts of patterns of `width` votes.

    `prior` rows, as a share of all, say what is expected beforehand: on a good document a rule hardly ever votes bad, a
    bad document fails one rule in five and passes others.  A rule is taken to be better than chance, so its bad vote
    stays at least `least` times as likely on a bad document as on a good one.
    """
    total = sum(patterns.values())
    belief = {p: (0.97, 0.2, 0.05)[min(2, p.count(BAD))] for p in patterns}
    good, votes = 0.5, [[[1 / 3] * 3] * 2 for _ in range(width)]
    shares = {0: (0.4, 0.4, 0.2), 1: (0.3, 0.68, 0.02)}  # abstain, good, bad; of bad and of good documents
    for _ in range(rounds if total else 0):
        weight = prior * total
        mass = {c: [[weight * s for s in shares[c]] for _ in range(width)] for c in (0, 1)}
        for p, n in patterns.items():
            for j, v in enumerate(p):
                mass[1][j][v] += n * belief[p]
                mass[0][j][v] += n * (1 - belief[p])
        votes = [[[x / sum(mass[c][j]) for x in mass[c][j]] for c in (0, 1)] for j in range(width)]
        for of_bad, of_good in votes:
            excess = of_good[BAD] - of_bad[BAD] / least
            if excess > 0:
                rest = of_good[ABSTAIN] + of_good[GOOD]
                of_good[:] = [x + excess * x / rest for x in of_good[:BAD]] + [of_good[BAD] - excess]
        good = (sum(n * belief[p] for p, n in patterns.items()) + weight) / (total + 2 * weight)
        belief = {p: _posterior(good, votes, p) for p in patterns}
    return good, votes


def _posterior(good: float, votes: list, pattern: Sequence[int]) -> float:
    odds = math.log(good / (1 - good)) + sum(math.log(votes[j][1][v] / votes[j][0][v]) for j, v in enumerate(pattern))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def judge_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, needed: float = 0.5) -> DataFrame:
    """The counts, base_failed, a vote per rule, quality (P(good)) and kept."""
    voted = measured(docs, key, text).withColumns({f"vote_{r.name}": r.vote() for r in rules})
    table = common.stored(voted, "quality-votes")
    names = [f"vote_{r.name}" for r in rules]
    patterns = {tuple(r)[:-1]: r["n"] for r in table.groupBy(*names).agg(F.count("*").alias("n")).collect()}  # <= 3^rules rows
    good, votes = estimate(patterns, len(rules))
    odds = F.lit(math.log(good / (1 - good)))
    for name, (bad_share, good_share) in zip(names, votes, strict=True):
        ratio = [math.log(g / b) for b, g in zip(bad_share, good_share, strict=True)]
        odds = odds + F.when(F.col(name) == GOOD, ratio[GOOD]).when(F.col(name) == BAD, ratio[BAD]).otherwise(ratio[ABSTAIN])
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = table.withColumns({"base_failed": base, "quality": 1 / (1 + F.exp(-odds))})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= needed))


@query("op7_quality_rules")
def op7_quality_rules(spark, folder):
    judged = judge_quality(common.read(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality")
    )
