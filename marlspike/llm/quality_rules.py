"""Quality rules: text statistics, and decision lists learned from labelled statistics.

Everything runs in DataFrame functions. ``statistics`` measures whole texts inside
the row. ``learn`` grows ordered rules by sequential covering: a rule is a
conjunction of thresholds, grown one condition at a time by information gain on the
growing part of the labelled rows, then cut back on the pruning part. Each step is
one aggregate over the labelled rows; the driver sees only histograms of
``len(FEATURES) x BINS`` cells. ``verdict`` turns the list into one ordered Spark
conditional expression.

A null text has no words, lines or symbols. A text without words has ratios 0.
Documents without a label, or labelled null, teach nothing. If a document is
labelled twice, each label counts. Without labelled rows of both kinds the list is
empty and every document passes it. Of equally good conditions the one first in
``FEATURES`` order, then with the smallest bin, is taken.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marlspike.llm.scratch import stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Ratios and sizes the rules may test, in order.
FEATURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "mean_word_chars", "n_words")
#: Candidate thresholds per feature: midway between quantiles of the bad and the good rows, so many of each.
BINS = 24
MAX_RULES, MAX_CONDITIONS = 8, 3
#: Rules that may fail; the covering then starts from the next best condition.
MAX_FAILED = 8
#: A rule must reject at least this share of bad rows in both parts, and cover so many growing rows.
LEAST_PRECISION, LEAST_COVER = 0.95, 5
#: Base limits.
LEAST_WORDS, MOST_REPEATED = 10, 20


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as struct ``row`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A repeated word is one inside a window of five words that stands twice or more in
    its text. Windows are compared by 64-bit hashes, sorted with their places.
    """
    df = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    trimmed = F.trim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    df = df.withColumn("trimmed", trimmed)
    df = df.withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", SPACE)))
    n = F.size("words")
    df = df.withColumn("grams", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "row", "grams", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    df = df.withColumn("n_lines", F.size("lines").cast("long")).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # sort (hash, place) only where some hash stands twice
    df = df.withColumn("placed", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")))
    same = lambda p, j: F.coalesce(F.get("placed", j)["g"] == p["g"], F.lit(False))
    repeated = F.filter("placed", lambda p, k: same(p, k + 1) | F.when(k > 0, same(p, k - 1)).otherwise(F.lit(False)))
    df = df.withColumn("places", F.sort_array(F.transform(repeated, lambda p: p["i"])))
    covered = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return df.select("row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def features() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words,
        "mean_word_chars": F.col("word_chars") / words,
        "n_words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def column(self, by: dict[str, Column]) -> Column:
        return by[self.feature] > self.limit if self.above else by[self.feature] <= self.limit


Rule = tuple[Condition, ...]


def _matches(rule: Rule, by: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(by)
    return out


def verdict(rules: list[Rule]) -> Column:
    """False for rows that a rule rejects: one CASE WHEN, in the order of the rules."""
    by, case = features(), None
    for rule in rules:
        hit = _matches(rule, by)
        case = F.when(hit, False) if case is None else case.when(hit, False)
    return F.lit(True) if case is None else case.otherwise(True)


def learn(labelled: DataFrame, bad: Column) -> list[Rule]:
    """Ordered rules that describe the rows where ``bad`` holds.

    ``labelled`` has the statistics and ``doc_id``; a third of the ids (by hash) prunes, the rest grows.
    """
    by = features()
    rows = stored(labelled.filter(bad.isNotNull()).select(
        bad.cast("int").alias("bad"), (F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)).cast("long")), F.lit(3)) == 0).alias("prune"),
        *[c.alias(f) for f, c in by.items()]), "labelled")
    own = {f: F.col(f) for f in FEATURES}
    levels = [i / BINS for i in range(BINS + 1)]
    limits = rows.groupBy("bad").agg(*[F.percentile_approx(f, levels, 2000).alias(f) for f in FEATURES]).collect()
    values = {f: sorted({x for r in limits for x in r[f] or ()}) for f in FEATURES}
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}
    if not any(cuts.values()):
        return []

    def tally(where: Column) -> dict[str, list[tuple[int, int]]]:
        """For each feature and bin (values above as many limits): rows and bad rows."""
        cells = []
        for f in FEATURES:
            place = sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0))
            cells.append(F.struct(F.lit(f).alias("f"), place.alias("b")))
        got = (rows.filter(where).select("bad", F.explode(F.array(*cells)).alias("c"))
               .groupBy("c.f", "c.b").agg(F.count("*").alias("n"), F.sum("bad").alias("p")).collect())
        out = {f: [(0, 0)] * (len(cuts[f]) + 1) for f in FEATURES}
        for r in got:
            out[r["f"]][r["b"]] = (r["n"], r["p"])
        return out

    def gain(p: int, n: int, of: float) -> float:
        return p * (math.log2(p / n) - of) if p else 0.0

    left, rules = ~F.col("prune"), []
    unpruned, failed = F.col("prune"), set()
    while len(rules) < MAX_RULES and len(failed) <= MAX_FAILED:
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            cells = tally(left & _matches(rule, own))
            total, hits = (sum(x[k] for x in cells[FEATURES[0]]) for k in (0, 1))
            if not hits or hits == total:
                break
            of, best = math.log2(hits / total), None
            for f in FEATURES:
                below = below_bad = 0
                for b, c in enumerate(cuts[f]):
                    below, below_bad = below + cells[f][b][0], below_bad + cells[f][b][1]
                    for above, n, p in ((True, total - below, hits - below_bad), (False, below, below_bad)):
                        more = Condition(f, above, float(c))
                        if n >= LEAST_COVER and n < total and (rule or more not in failed) and (g := gain(p, n, of)) > (best[0] if best else 1e-9):
                            best = (g, more)
            if best is None:
                break
            rule += (best[1],)
        if not rule:
            break
        # drop final conditions while that does no harm on the pruning part
        aggs = [F.count(F.when(_matches(rule[:k], own), 1)).alias(f"n{k}") for k in range(1, len(rule) + 1)]
        aggs += [F.sum(F.when(_matches(rule[:k], own), F.col("bad"))).alias(f"p{k}") for k in range(1, len(rule) + 1)]
        held, grown = rows.filter(unpruned).agg(*aggs).first(), rows.filter(left).agg(*aggs).first()
        worth = [((held[f"p{k}"] or 0) - (held[f"n{k}"] - (held[f"p{k}"] or 0))) / max(1, held[f"n{k}"]) for k in range(1, len(rule) + 1)]
        k = 1 + max(range(len(rule)), key=lambda i: (worth[i], -i))
        n, p = grown[f"n{k}"], grown[f"p{k}"] or 0
        if n < LEAST_COVER or p < LEAST_PRECISION * n or held[f"n{k}"] and (held[f"p{k}"] or 0) < LEAST_PRECISION * held[f"n{k}"]:
            failed.add(rule[0])
            continue
        rules.append(rule[:k])
        left, unpruned = left & ~_matches(rule[:k], own), unpruned & ~_matches(rule[:k], own)
    return rules


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every document with ``base_failed`` and ``kept``.

    Rules are learned from ``labels`` (doc_id, quality 0/1) of the documents that pass the base limits.
    """
    stats = stored(statistics(docs), "statistics")
    known = labels.select(F.col("doc_id").alias("of"), F.col("quality").alias("quality"))
    flat = stats.select(F.col("row.doc_id").alias("doc_id"), *[c for c in stats.columns if c != "row"])
    labelled = flat.join(known, F.col("doc_id") == F.col("of"))
    rules = learn(labelled.filter(~base_failed()), F.col("quality") == 0)  # the base limits need no rule
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base limits and the learned rules."""
    return judged(docs, labels).filter("kept").select("row.*")
