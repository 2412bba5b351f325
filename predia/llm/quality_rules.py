"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every rule has a measure in whole thousandths, greater is worse, and a unit, the measure at which a text counts as bad by
that rule. The severity of a text is its greatest measure in hundredths of the rule's unit. A cutoff on the severity is
chosen per stratum (language) on labelled texts that pass the base rules, so that with probability ``1 - delta``, over all
strata at once, all rules together reject at most ``risk`` of the good texts of that stratum:

* What a cutoff rejects grows from lenient to strict, whatever the rule, so the cutoffs are one sequence that is fixed
  before any label is seen. They are tried in that order and the first that fails ends the search, which needs no
  correction within a stratum, and the whole risk goes where texts are worst.
* A cutoff passes if a binomial variable with that risk is at most as large as the number of good texts it rejects with
  probability ``delta / k`` at most: the exact (Clopper-Pearson) bound. ``k`` corrects for the strata: it is the least
  number such that at most ``k`` strata have good texts enough to pass at ``delta / k`` at all (Tarone). How many texts
  a stratum has says nothing about what is rejected.
* Of the passing cutoffs the one that rejects most texts of label 0 is used, the most lenient of equals; one that
  rejects none is not used.
* Texts that are equal but for white space are one trial, with the greatest severity among them.

Words are runs of characters other than ASCII white space. Words in repeated windows are found by 64-bit hashes of the
three words.

Defined results: a null text has no words; a null language is a stratum of its own; a stratum without enough labelled
texts gets no cutoffs and only the base rules hold; labels other than 0 and 1 are ignored, and an id that is labelled
twice with different labels counts with both. Rows that are there twice are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from predia.llm.common import WHITE_SPACE, new_name, settle

SPACES = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Settings:
    risk: float = 0.02
    delta: float = 0.05
    least_words: int = 50
    most_repeated: int = 50


# Name of a rule, what is counted against which whole, and the unit; the measure is the share in thousandths.
RULES = {
    "symbols": ("n_symbols", "word_chars", 100),
    "repeated_words": ("n_repeat_words", "n_words", 400),
    "repeated_lines": ("n_dup_lines", "n_lines", 500),
    "capitals": ("n_capitals", "word_chars", 300),
    "exclamations": ("n_exclamations", "word_chars", 50),
}


def removed(text, characters: str) -> F.Column:
    """How many of the given characters a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def measures(docs: DataFrame, column: str = "measures") -> DataFrame:
    """All columns and a struct of counts of each row's ``text``, in one pass without a shuffle."""
    names = [new_name(docs, f"{column}_{part}") for part in ("words", "windows", "order", "places")]
    words, windows, order, places = (F.col(n) for n in names)
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, WHITE_SPACE, "")) > 0)
    n = F.size(words)
    df = docs.withColumn(names[0], F.array_remove(F.split(text, SPACES, -1), ""))
    df = df.withColumn(names[1], F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    # Only a text in which a window comes back is sorted: equal windows then stand side by side.
    df = df.withColumn(names[2], F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(names[3], F.sort_array(F.transform(F.filter(
        order, lambda x, i: F.get(order, i - 1)["h"].eqNullSafe(x["h"]) | F.get(order, i + 1)["h"].eqNullSafe(x["h"])),
        lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, step: total + step)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, WHITE_SPACE, "")).cast("long").alias("word_chars"),
        removed(text, "#*$%&|<>").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        removed(text, CAPITALS).alias("n_capitals"),
        removed(text, "!").alias("n_exclamations"),
        F.unhex(F.md5(F.translate(text, WHITE_SPACE, ""))).alias("same"))
    return df.withColumn(column, counts).drop(*names)


def base_failed(m, settings: Settings) -> F.Column:
    return (m["n_words"] < settings.least_words) | (
        100 * m["n_repeat_words"] > settings.most_repeated * m["n_words"])


def measure(m, rule: str) -> F.Column:
    part, whole, _ = RULES[rule]
    return F.floor(1000 * m[part] / F.greatest(m[whole], F.lit(1))).cast("int")


def severity(m, rule: str) -> F.Column:
    """The measure in hundredths of the rule's unit."""
    return F.floor(100 * measure(m, rule) / RULES[rule][2]).cast("int")


def allowed_rejections(good, risk: float, level) -> F.Column:
    """The most of ``good`` texts a cutoff may reject: the largest k with P(Binomial(good, risk) <= k) <= level.

    -1 if not even k = 0 passes. Terms are summed as logarithms, so large counts do not underflow.
    """
    n = good.cast("double")
    log_odds = F.lit(risk / (1 - risk))
    start = F.struct((n * F.log1p(F.lit(-risk))).alias("term"), F.lit(float("-inf")).alias("total"),
                     F.lit(-1).cast("long").alias("most"))

    def step(state, i):
        high, low = F.greatest(state["total"], state["term"]), F.least(state["total"], state["term"])
        total = high + F.log1p(F.exp(low - high))
        return F.struct(
            (state["term"] + F.log((n - i + F.lit(1e-300)) / (i + 1)) + F.log(log_odds)).alias("term"),
            total.alias("total"), F.when(total <= F.log(level), i).otherwise(state["most"]).alias("most"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * risk).cast("long")), start, step,
                       lambda state: state["most"])


def strata_to_correct_for(good: DataFrame, settings: Settings) -> DataFrame:
    """The least k such that at most k strata could pass at ``delta / k``, of the counts ``good`` of all strata.

    A stratum of n good texts could pass up to the k with (1 - risk) ** n <= delta / k. In falling order of these, the
    last place that its stratum's own k reaches is k, or one less where others reach that k too.
    """
    could = F.floor(F.exp(F.log(F.lit(settings.delta)) - F.col("good") * F.log1p(F.lit(-settings.risk))))
    row = good.select(F.least(could, F.lit(1 << 40)).cast("long").alias("c")).agg(
        F.reverse(F.array_sort(F.collect_list("c"))).alias("c"))
    place = F.size(F.filter("c", lambda c, i: c >= i + 1))
    row = row.select("c", place.alias("place"))
    place, reach = F.col("place"), F.size(F.filter("c", lambda c: c >= F.col("place")))
    return row.select(F.greatest(F.lit(1), F.when(reach > place, place + 1).otherwise(place)).alias("k"))


def cutoffs(rows: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per stratum that has a cutoff: stratum, cutoff (the greatest severity that stays).

    ``rows`` has doc_id, stratum and measures. Of a stratum there are as many counts as there are severities.
    """
    usable = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label")).distinct()
    m = F.col("measures")
    trials = rows.where(~base_failed(m, settings)).join(usable, "doc_id").groupBy("stratum", "label", m["same"]).agg(
        F.max(F.greatest(*[severity(m, rule) for rule in RULES])).alias("severity"))
    counts = settle(trials.groupBy("stratum", "severity").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")), "quality-counts")
    totals = counts.groupBy("stratum").agg(F.sum("good").alias("good"))
    level = settings.delta / strata_to_correct_for(totals, settings).first()["k"]
    allowed = totals.select("stratum", allowed_rejections(F.col("good"), settings.risk, F.lit(level)).alias("most"))
    # Rejected by the cutoff severity - 1: everything from this severity up.
    up = Window.partitionBy("stratum").orderBy(F.desc("severity"))
    reached = (counts.withColumn("rejected_good", F.sum("good").over(up))
               .join(allowed, "stratum").where("rejected_good <= most and bad > 0"))
    return reached.groupBy("stratum").agg((F.min("severity") - 1).alias("cutoff"))


def judged(rows: DataFrame, chosen: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns and base_failed, rejected_by (names of the rules that reject, sorted)."""
    m = F.col("measures")
    failed = F.array_compact(F.array(*[
        F.when(severity(m, rule) > F.col("cutoff"), F.lit(rule)) for rule in sorted(RULES)]))
    return rows.join(chosen, "stratum", "left").select(
        *rows.columns, base_failed(m, settings).alias("base_failed"),
        F.coalesce(F.array_join(failed, ","), F.lit("")).alias("rejected_by"))


def quality_rules(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, rejected_by."""
    rows = settle(measures(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "text"))
                  .drop("text"), "quality-measures")
    chosen = settle(cutoffs(rows, labels, settings), "quality-cutoffs")
    return judged(rows, chosen, settings).select(
        "doc_id", *[F.col(f"measures.{c}").alias(c)
                    for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")


def only_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that neither the base nor the chosen cutoffs reject, with their own columns.

    The documents are written once with their counts, which the choice of the cutoffs and the decision both read.
    """
    kept = [F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(docs.columns)]
    own = docs.select(*kept, "doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), "text")
    rows = settle(measures(own).drop("text"), "quality-documents")
    chosen = settle(cutoffs(rows.select("doc_id", "stratum", "measures"), labels, settings), "quality-cutoffs")
    good = judged(rows, chosen, settings).where("not base_failed and rejected_by = ''")
    return good.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])
