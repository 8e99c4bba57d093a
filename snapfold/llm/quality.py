"""Document quality by weak supervision.

Rules look at statistics of a text and each votes good, votes bad or abstains.  No rule
has to pass.  Expectation-maximisation over the votes of all documents estimates the share
of good documents and, per rule, how often it votes right on good documents and on those of each
bad kind; the posterior probability of being good, given a document's votes, is the verdict.

All statistics are DataFrame expressions over whole texts.  EM needs only how often each
combination of votes occurs: three outcomes per rule, so at most 3 ** len(RULES) rows come to
the driver, whatever the size of the table.  The verdict is again an expression.

Null text has no words.  Texts without words fail the base test.  Repeated rows count and are
judged each.  Columns other than doc_id and text are ignored.  An empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.staging import staged
from snapfold.llm.textcols import WHITE, n_words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GOOD, BAD, ABSTAIN = 1, -1, 0


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often and wherever `then` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _covered(places: Column) -> Column:
    """Number of words in windows that start at the given places, in ascending order."""
    start = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW).alias("last"))
    total = F.aggregate(
        places,
        start,
        lambda so, at: F.struct(
            (so["words"] + F.least(F.lit(WINDOW), at - so["last"])).alias("words"), at.alias("last")
        ),
    )
    return total["words"]


def _repeated(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def places(dealt: Column) -> Column:
        def equal(k: Column, other: Column) -> Column:
            return F.get(dealt, k)["hash"] == F.get(dealt, other)["hash"]

        twins = F.filter(
            F.sequence(F.lit(0), F.size(dealt) - 1),
            lambda k: F.coalesce(equal(k, k - 1), F.lit(False)) | F.coalesce(equal(k, k + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(twins, lambda k: F.get(dealt, k)["at"]))

    dealt = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _covered(let(dealt, places))
    )


def repeat_words(text: Column) -> Column:
    """Words in 8-word windows found twice or more in the text, the first one included."""
    hashes = F.transform(F.split(F.btrim(text, F.lit(WHITE)), r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    windows = let(
        hashes,
        lambda h: F.when(
            F.size(h) >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return let(windows, _repeated)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics that rules vote on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    worded = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "doc_id",
        n_words(F.col("text")).alias("n_words"),
        F.char_length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(worded).cast("long").alias("n_lines"),
        repeat_words(F.col("text")).cast("long").alias("n_repeat_words"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(r"[.!?](?=\s|$)")).cast("long").alias("n_sentence_ends"),
    )


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column
    good: Column


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> list[Rule]:
    """The voters.  A rule abstains where it is neither sure of good nor of bad."""
    word_length = _share("word_chars", "n_words")
    symbols = _share("n_symbols", "word_chars")
    duplicates = _share("n_dup_lines", "n_lines")
    repeats = _share("n_repeat_words", "n_words")
    capitals = _share("n_capitals", "word_chars")
    ends = _share("n_sentence_ends", "n_words")
    return [
        Rule("length", F.col("n_words") < MIN_WORDS, F.col("n_words") >= 50),
        Rule("word_length", (word_length < 3) | (word_length > 8), word_length.between(4, 6.5)),
        Rule("symbols", symbols > 0.02, symbols < 0.005),
        Rule("duplicate_lines", duplicates > 0.5, (duplicates < 0.1) & (F.col("n_lines") > 1)),
        Rule("repeats", repeats > 0.3, repeats < 0.05),
        Rule("capitals", capitals > 0.2, capitals < 0.08),
        Rule("sentences", (ends > 0.4) | ((F.col("n_sentence_ends") == 0) & (F.col("n_words") >= 50)), ends.between(0.02, 0.25)),
    ]


def vote(rule: Rule) -> Column:
    return F.when(rule.bad, BAD).when(rule.good, GOOD).otherwise(ABSTAIN).cast("byte")


@dataclass(frozen=True)
class LabelModel:
    """Kind 0 is good; kind j + 1 is bad in the way that rule j is there to notice.

    shares[kind]; says_bad[kind][rule] is the probability that the rule, where it votes on a
    document of that kind, votes bad.  So a rule's accuracy is 1 - says_bad on good documents, and
    says_bad on the bad kinds.
    """

    shares: tuple[float, ...]
    says_bad: tuple[tuple[float, ...], ...]

    def beliefs(self, votes) -> list[float]:
        """Probability of every kind, given a document's votes."""
        logs = [
            math.log(share) + sum(math.log(p if v == BAD else 1 - p) for p, v in zip(own, votes, strict=True) if v)
            for share, own in zip(self.shares, self.says_bad, strict=True)
        ]
        top = max(logs)
        weights = [math.exp(x - top) for x in logs]
        return [w / sum(weights) for w in weights]

    def posterior(self, votes) -> float:
        return self.beliefs(votes)[0]


def fit(patterns: dict[tuple[int, ...], int], width: int, rounds: int = 100, strength: float = 1.0) -> LabelModel:
    """EM from counts of vote combinations of `width` rules.

    Bad documents are of several kinds, each of which only a rule or two notices.  With a single
    bad kind EM takes the largest for the only one and calls the others good, so there
    is one for each rule.  It starts from the presumption that documents without a bad vote are
    good and others are of the kinds of the rules that object; from then on votes of all
    rules decide together.  `strength` documents' worth of evidence that rules are mostly right keep
    rules that hardly vote, and an empty table, from having no value.
    """
    kinds = range(width + 1)
    expected = [[0.9 if kind == j + 1 else 0.02 if kind == 0 else 0.2 for j in range(width)] for kind in kinds]
    combinations = sorted(patterns.items())
    beliefs = []
    for votes, _ in combinations:
        objecting = [j + 1 for j, v in enumerate(votes) if v == BAD]
        beliefs.append([1 / len(objecting) if k in objecting else 0.0 for k in kinds] if objecting else [1.0] + [0.0] * width)
    clip = lambda x: min(1 - 1e-6, max(1e-6, x))
    model = LabelModel((), ())
    for _ in range(rounds):
        sizes = [strength] * (width + 1)
        bad = [[strength * x for x in own] for own in expected]
        cast = [[strength] * width for _ in kinds]
        for (votes, count), belief in zip(combinations, beliefs, strict=True):
            for kind, share in enumerate(belief):
                sizes[kind] += share * count
                for j, v in enumerate(votes):
                    if v != ABSTAIN:
                        bad[kind][j] += share * count * (v == BAD)
                        cast[kind][j] += share * count
        model = LabelModel(
            tuple(x / sum(sizes) for x in sizes),
            tuple(tuple(clip(x / n) for x, n in zip(*own, strict=True)) for own in zip(bad, cast, strict=True)),
        )
        beliefs = [model.beliefs(votes) for votes, _ in combinations]
    return model


def posterior(model: LabelModel, votes: list[str]) -> Column:
    """The model's probability that a document is good, as an expression on vote columns."""

    def log_weight(kind: int) -> Column:
        total = F.lit(math.log(model.shares[kind]))
        for name, p in zip(votes, model.says_bad[kind], strict=True):
            total = total + F.when(F.col(name) == BAD, math.log(p)).when(F.col(name) == GOOD, math.log(1 - p)).otherwise(0.0)
        return total

    good = log_weight(0)
    others = [F.exp(log_weight(kind) - good) for kind in range(1, len(model.shares))]
    return 1 / sum(others, F.lit(1.0))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the statistics, votes, quality (posterior probability), base_failed, kept."""
    voters = rules()
    names = [f"vote_{r.name}" for r in voters]
    # Written once: counting votes and judging both read it, texts are scanned once.
    voted = staged(
        statistics(docs).select("*", *[vote(r).alias(n) for r, n in zip(voters, names, strict=True)]), "votes"
    )
    counted = voted.groupBy(*names).count().collect()
    model = fit({tuple(row)[:-1]: row["count"] for row in counted}, len(names))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    quality = posterior(model, names)
    return voted.select(
        "*", quality.alias("quality"), failed.alias("base_failed"), (~failed & (quality >= threshold)).alias("kept")
    )
