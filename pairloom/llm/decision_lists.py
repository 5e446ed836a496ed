"""Quality rules: a decision list learnt by sequential covering, applied as SQL conditions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.words import text_of, words_of, wrapped
from pairloom.runtime import materialize

WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate", "line_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    op: str
    value: float

    def column(self) -> Column:
        return F.col(self.feature) >= self.value if self.op == ">=" else F.col(self.feature) < self.value


Rule = tuple[Condition, ...]


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, where the optimiser would inline it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(words: Column) -> Column:
    """Words inside a window of five that comes twice or more.

    Windows are sorted with their places; those with an equal neighbour repeat, and the
    gaps between their places add up to the words they cover.
    """
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    windows = F.transform(
        places, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i"))
    )
    size = F.lit(WINDOW)

    def repeated(s: Column) -> Column:
        def equal(x, j):
            return (F.get(s, j)["w"] == x["w"]) & (j >= 0)

        return F.filter(
            s, lambda x, j: F.coalesce(equal(x, j - 1), F.lit(False)) | F.coalesce(equal(x, j + 1), F.lit(False))
        )

    def total(at: Column) -> Column:
        gaps = F.transform(at, lambda x, j: F.least(F.coalesce(F.get(at, j + 1) - x, size), size))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    return _let(F.sort_array(windows), lambda s: _let(F.sort_array(F.transform(repeated(s), lambda x: x["i"])), total))


def _repeat_words(words: Column) -> Column:
    """``_covered``, where a look at the windows' hashes does not already rule repeats out."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]),
    )
    distinct = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(F.size(words) <= WINDOW, 0).when(distinct, 0).otherwise(_covered(words)).cast("bigint")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the statistics the rules look at; a null text has none of anything.

    ``docs`` has doc_id, text and nothing that clashes with a statistic.
    """
    whole = text_of(text)
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Each generator yields one row. It keeps the optimiser from copying the work below it
    # into every later use, a filter's condition included.
    by_word = F.inline(
        F.array(
            _let(
                words_of(text),
                lambda w: F.struct(
                    F.size(w).cast("bigint").alias("n_words"),
                    F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                    _repeat_words(w).alias("n_repeat_words"),
                ),
            )
        )
    )
    by_line = F.inline(
        F.array(
            _let(
                lines,
                lambda x: F.struct(
                    F.size(x).cast("bigint").alias("n_lines"),
                    (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
                ),
            )
        )
    )
    count = lambda pattern: F.regexp_count(whole, F.lit(pattern)).cast("bigint")
    return (
        docs.select("*", by_word)
        .select("*", by_line)
        .withColumn("n_symbols", count(r"[#*$%&|<>]"))
        .withColumn("n_upper", count("[A-Z]"))
        .withColumn("n_marks", count("[!?]"))
        .withColumn("mean_word", _rate("word_chars", "n_words"))
        .withColumn("symbol_rate", _rate("n_symbols", "n_words"))
        .withColumn("dup_line_rate", _rate("n_dup_lines", "n_lines"))
        .withColumn("repeat_rate", _rate("n_repeat_words", "n_words"))
        .withColumn("upper_rate", _rate("n_upper", "word_chars"))
        .withColumn("mark_rate", _rate("n_marks", "n_words"))
        .withColumn("line_words", _rate("n_words", "n_lines"))
    )


def _rate(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def base_failed() -> Column:
    """Under ten words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where: Column | None = None) -> DataFrame:
    """(doc_id, text, _label) of at most ``rows`` labelled ids, chosen by a hash of the id.

    An id labelled twice takes the smaller label. The ids are broadcast: ``rows`` bounds them.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known if where is None else known.where(where)
    chosen = (
        known.groupBy("doc_id").agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def learn_rules(
    stats: DataFrame, *, bad: str = "_bad", bins: int = 32, max_rules: int = 8, max_conditions: int = 3,
    precision: float = 0.95, support: int = 5,
) -> list[Rule]:
    """Grow, prune and collect rules that reject, from rows with features and a 0/1 column ``bad``.

    Two thirds of the rows grow a rule condition by condition, by information gain over at
    most twice ``bins`` quantile thresholds a feature; the other third drops final conditions that
    do not help. A rule is kept if, on those rows, it covers ``support`` bad rows at least and
    its precision, less one standard error, is not below ``precision``; the list ends with the
    first that fails. Only counts per feature and bin come to the driver.
    """
    shares = [i / bins for i in range(1, bins)]
    some = {"all": F.lit(True), "bad": F.col(bad) == 1}
    row = stats.agg(
        *[
            F.percentile_approx(F.when(which, F.col(f).cast("double")), shares, 10_000).alias(f"{f}_{name}")
            for f in FEATURES for name, which in some.items()
        ]
    ).first()
    # Quantiles of the bad rows besides those of all: few rows may have all that tells them apart.
    cuts = {f: sorted({c for name in some for c in row[f"{f}_{name}"] or []}) for f in FEATURES}
    names = [f for f in FEATURES if cuts[f]]
    if not names:
        return []

    def binned(f: str) -> Column:
        edges = F.array(*[F.lit(float(c)) for c in cuts[f]])
        value = F.col(f).cast("double")
        return F.size(F.filter(edges, lambda edge: edge <= value))

    table = materialize(
        stats.select(
            F.col(bad).cast("bigint").alias("_y"),
            (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("grow")), F.lit(3)) > 0).alias("_grow"),
            F.array(*[binned(f) for f in names]).alias("_bins"), *FEATURES,
        ),
        "labelled",
    )
    rules: list[Rule] = []
    left = table
    for _ in range(max_rules):
        rule: Rule = ()
        for _ in range(max_conditions):
            step = _best_condition(_where(left.where("_grow"), rule), names, cuts)
            if step is None:
                break
            rule += (step,)
        rule = _prune(left.where(~F.col("_grow")), rule, precision, support)
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_all(rule))
    return rules


def _all(rule: Rule) -> Column:
    whole = F.lit(True)
    for condition in rule:
        whole = whole & condition.column()
    return whole


def _where(rows: DataFrame, rule: Rule) -> DataFrame:
    return rows.where(_all(rule)) if rule else rows


def _best_condition(rows: DataFrame, names: list[str], cuts: dict[str, list[float]]) -> Condition | None:
    """The threshold with the largest gain, None if none helps."""
    each = rows.select("_y", F.posexplode("_bins").alias("_f", "_b"))
    counts = each.groupBy("_f", "_b").agg(F.sum("_y").alias("p"), F.count("*").alias("n")).collect()
    best, found = 0.0, None
    for f, name in enumerate(names):
        own = {r["_b"]: (r["p"], r["n"] - r["p"]) for r in counts if r["_f"] == f}
        all_p, all_n = (sum(v[i] for v in own.values()) for i in (0, 1))
        if not all_p or not all_n:
            return None
        prior = math.log2(all_p / (all_p + all_n))
        below_p = below_n = 0
        for b, cut in enumerate(cuts[name], start=1):
            p, n = own.get(b - 1, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for op, p, n in (("<", below_p, below_n), (">=", all_p - below_p, all_n - below_n)):
                gain = p * (math.log2(p / (p + n)) - prior) if p else 0.0
                if gain > best + 1e-9:
                    best, found = gain, Condition(name, op, float(cut))
    return found


def _prune(rows: DataFrame, rule: Rule, precision: float, support: int) -> Rule:
    """The beginning of the rule that does best on rows it was not grown on, if it does well."""
    if not rule:
        return ()
    starts = [rule[:i] for i in range(1, len(rule) + 1)]
    counts = rows.agg(
        *[F.coalesce(F.sum(F.when(_all(s), F.col("_y"))), F.lit(0)).alias(f"p{i}") for i, s in enumerate(starts)],
        *[F.count(F.when(_all(s), 1)).alias(f"n{i}") for i, s in enumerate(starts)],
    ).first()
    value = lambda i: (2 * counts[f"p{i}"] - counts[f"n{i}"]) / max(1, counts[f"n{i}"])
    i = max(range(len(starts)), key=lambda i: (round(value(i), 9), -i))
    p, n = counts[f"p{i}"], counts[f"n{i}"]
    rate = (p + 1) / (n + 2)
    good = p >= support and rate - math.sqrt(rate * (1 - rate) / (n + 2)) >= precision - 0.05 and p / n >= precision
    return starts[i] if good else ()


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """``kept`` and the number of the rule that rejects (0: base rule, null: none), in order."""
    which = F.when(base_failed(), F.lit(0))
    for i, rule in enumerate(rules, start=1):
        which = which.when(_all(rule), F.lit(i))
    return which.isNull(), which


def judge_quality(
    docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, rules: list[Rule] | None = None, **options
) -> DataFrame:
    """doc_id, statistics, ``base_failed``, ``kept`` and ``rejected_by`` of every document, and its row
    as ``_doc``.

    The list is learnt from ``labels.quality`` (0 is bad) of at most ``fit_rows`` documents
    and then applied to all of them as one ordered condition. A null or empty text fails the
    base rule; null ids are judged like others but teach nothing; repeated rows are judged
    alike; without labels only the base rule rejects.
    """
    if rules is None:
        sample = labelled_sample(docs, labels, "quality", fit_rows)
        seen = text_statistics(sample).withColumn("_bad", (F.col("_label") == 0).cast("bigint"))
        rules = learn_rules(materialize(seen.where(~base_failed()).drop("text"), "statistics"), **options)
    kept, which = verdict(rules)
    return (
        text_statistics(wrapped(docs, "doc_id", "text"))
        .drop("text")
        .withColumn("base_failed", base_failed()).withColumn("kept", kept).withColumn("rejected_by", which)
    )
