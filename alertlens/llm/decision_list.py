"""Quality rules as a learned decision list, in DataFrame functions only.

Sequential covering: a rule is a conjunction of thresholds on statistics of
the text.  It is grown on two thirds of the labelled rows by information gain,
pruned on the rest, kept if it is precise there, and the rows it covers leave
before the next one is grown.  The list becomes one conditional expression.

Every step of the learner is one aggregation over the labelled rows; only
counts per threshold reach the driver.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import GAP, hex_bucket, id_hash, materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: bound of the labelled rows that a list is fitted on (those first in md5 order of the id)
SAMPLE_ROWS = 20_000
CUTS = 24
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
MIN_COVER = 5


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add s_* columns with the statistics of every whole text (null: no text).

    No words: all counts are 0 and so are the shares.
    """
    t = F.col("s_text")
    n_gap = F.size("s_words") - 2
    get = lambda i: F.get(F.col("s_words"), i)
    length_without = lambda rx: F.length(F.regexp_replace(t, rx, "")).cast("long")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    trimmed = F.regexp_replace(t, rf"^{GAP}|{GAP}$", "")
    windows = F.when(n_gap > 0, F.slice(F.transform("s_words", lambda w, i: F.xxhash64(w, get(i + 1), get(i + 2))), 1, F.greatest(n_gap, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    repeats = F.size("s_windows") > F.size(F.array_distinct("s_windows"))
    near = F.flatten(F.zip_with(
        F.slice("s_sorted", 1, F.size("s_sorted") - 1), F.slice("s_sorted", 2, F.size("s_sorted") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    covered = F.size(F.array_distinct(F.flatten(F.transform("s_twice", lambda p: F.array(p, p + 1, p + 2)))))
    return (
        docs.withColumn("s_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("s_words", F.when(F.length(trimmed) > 0, F.split(trimmed, GAP)).otherwise(F.array().cast("array<string>")))
        .withColumn("s_windows", windows)
        .withColumn("s_sorted", F.when(repeats, F.sort_array(F.transform("s_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("s_twice", F.when(F.col("s_sorted").isNotNull(), near))
        .withColumn("s_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]")))
        .withColumn("s_n_words", F.size("s_words").cast("long"))
        .withColumn("s_word_chars", length_without(GAP))
        .withColumn("s_n_symbols", length_without(rf"[^{SYMBOLS}]+"))
        .withColumn("s_n_dup_lines", (F.size("s_lines") - F.size(F.array_distinct("s_lines"))).cast("long"))
        .withColumn("s_n_repeat_words", F.when(F.col("s_twice").isNotNull(), covered).otherwise(0).cast("long"))
        .withColumn("s_n_lines", F.size("s_lines").cast("long"))
        .withColumn("s_n_upper", length_without(r"\P{Lu}+"))
        .withColumn("s_n_marks", length_without(r"[\p{L}\p{N} \x09-\x0D]+"))
        .drop("s_text", "s_words", "s_windows", "s_sorted", "s_twice", "s_lines")
        .withColumn("s_symbol_share", share("s_n_symbols", "s_word_chars"))
        .withColumn("s_repeat_share", share("s_n_repeat_words", "s_n_words"))
        .withColumn("s_dup_line_share", share("s_n_dup_lines", "s_n_lines"))
        .withColumn("s_upper_share", share("s_n_upper", "s_word_chars"))
        .withColumn("s_mark_share", share("s_n_marks", "s_word_chars"))
        .withColumn("s_word_length", share("s_word_chars", "s_n_words"))
        .withColumn("s_words_a_line", share("s_n_words", "s_n_lines"))
    )


FEATURES = ("s_symbol_share", "s_repeat_share", "s_dup_line_share", "s_upper_share", "s_mark_share",
            "s_word_length", "s_words_a_line", "s_n_words")
STATISTICS = (*FEATURES, "s_word_chars", "s_n_symbols", "s_n_dup_lines", "s_n_repeat_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) >= F.lit(self.cut) if self.above else F.col(self.feature) < F.lit(self.cut)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(f"{c.feature[2:]} {'>=' if c.above else '<'} {c.cut:.6g}" for c in self.conditions)


def covered_by(rules: list[Rule]) -> Column:
    """The ordered conditional expression of a list: true where a rule rejects."""
    answer = F.lit(False)
    for rule in reversed(rules):
        answer = F.when(rule.column(), F.lit(True)).otherwise(answer)
    return answer


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("s_n_words") < MIN_WORDS) | (100 * F.col("s_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("s_n_words"))


def labelled_sample(labels: DataFrame, label: str, bad: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(l_id, l_bad) of at most `rows` labelled ids; a repeated id is bad if any of its labels is."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = known.groupBy(F.col("doc_id").alias("l_id")).agg(F.max((F.col(label) == bad).cast("int")).alias("l_bad"))
    return one.orderBy(id_hash(F.col("l_id")), "l_id").limit(rows)


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Condition, tuple[int, int]]:
    """(bad, good) covered by every candidate condition, from one aggregation by feature and interval."""
    names = list(cuts)
    place = [F.struct(F.lit(i).alias("f"), sum((F.col(n) >= c).cast("int") for c in cuts[n]).alias("b")) for i, n in enumerate(names)]
    got = (rows.select("l_bad", F.explode(F.array(*place)).alias("at"))
           .groupBy("at.f", "at.b").agg(F.sum("l_bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect())
    found = {}
    for i, n in enumerate(names):
        own = [(r["b"], r["bad"], r["n"] - r["bad"]) for r in got if r["f"] == i]
        for k, cut in enumerate(cuts[n]):
            found[Condition(n, True, cut)] = (sum(p for b, p, _ in own if b > k), sum(q for b, _, q in own if b > k))
            found[Condition(n, False, cut)] = (sum(p for b, p, _ in own if b <= k), sum(q for b, _, q in own if b <= k))
    return found


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    taken: list[Condition] = []
    while len(taken) < MAX_CONDITIONS:
        seen = rows.filter(reduce(lambda a, b: a & b, [c.column() for c in taken], F.lit(True)))
        counts = _counts(seen, cuts)
        if not counts:
            break
        one = next(iter(counts))
        bad, good = (a + b for a, b in zip(counts[one], counts[Condition(one.feature, not one.above, one.cut)]))
        if bad < MIN_COVER or good == 0:
            break
        base = math.log2(bad / (bad + good))
        gain = lambda c: counts[c][0] * (math.log2(counts[c][0] / sum(counts[c])) - base) if counts[c][0] >= MIN_COVER else 0.0  # noqa: E731, B023
        best = max(counts, key=lambda c: (gain(c), -FEATURES.index(c.feature), c.above, -c.cut))  # ties: the feature listed first
        if gain(best) <= 1e-9:
            break
        taken.append(best)
    return taken


def _prune(rows: DataFrame, conditions: list[Condition]) -> tuple[list[Condition], float, int]:
    """The prefix of the conditions that is worth most on the held-out rows, its precision and cover there."""
    if not conditions:
        return [], 0.0, 0
    hits = [reduce(lambda a, b: a & b, [c.column() for c in conditions[:k]]) for k in range(1, len(conditions) + 1)]
    got = rows.agg(*[F.sum((h & (F.col("l_bad") == v)).cast("int")).alias(f"c{k}_{v}") for k, h in enumerate(hits) for v in (0, 1)]).first()
    worth = []
    for k in range(len(hits)):
        p, n = got[f"c{k}_1"] or 0, got[f"c{k}_0"] or 0
        worth.append(((p - n) / (p + n) if p + n else -1.0, -k, p / (p + n) if p + n else 0.0, p))
    _, k, precision, cover = max(worth)
    return conditions[: 1 - k], precision, cover


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bad: int = 0, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list of rejecting rules from the labelled documents that pass the base; no labels, no rules."""
    sample = labelled_sample(labels, label, bad, rows)
    known = docs.select(F.col("doc_id").alias("d_id"), "text").join(F.broadcast(sample), F.col("d_id") == F.col("l_id"))
    known = materialize(text_statistics(known).select("l_bad", base_failed().alias("out"), *FEATURES, (hex_bucket(id_hash(F.col("l_id")), 4) % 3 == 0).alias("held")))
    known = known.filter("NOT out")
    points = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    at = known.agg(*[F.percentile_approx(f, points, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(at[f])) for f in FEATURES if at[f] is not None}
    rules: list[Rule] = []
    while cuts and len(rules) < MAX_RULES:
        left = known.filter(~covered_by(rules))
        pruned, precision, cover = _prune(left.filter("held"), _grow(left.filter("NOT held"), cuts))
        if not pruned or precision < MIN_PRECISION or cover < MIN_COVER:
            break
        rules.append(Rule(tuple(pruned)))
    return rules


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every input row with its s_* statistics, s_base_failed and s_kept.

    The base fails with fewer than 50 words or with more than half of the
    words in repeated windows; otherwise the list decides.  Null or empty
    text: no words, so the base fails.  Repeated rows are judged alike.  Empty
    input: no rows.  Long texts are used whole.  Input columns pass through;
    names beginning with s_ are reserved.
    """
    found = (text_statistics(docs).withColumn("s_base_failed", base_failed())
             .withColumn("s_kept", ~F.col("s_base_failed") & ~covered_by(rules)))
    names = [c for c in found.columns if c.startswith("s_")]
    # one generated row: a filter on the verdict must not be pushed into, and repeat, the statistics
    return found.select(*docs.columns, F.explode(F.array(F.struct(*names))).alias("s_all")).select(*docs.columns, "s_all.*")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept of every row of documents."""
    out = judged(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", *[F.col(f"s_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that the rules keep, unchanged."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("text").alias("text"))
    return judged(inner, fit(docs, labels)).filter("s_kept").select(*[F.col(n).alias(c) for c, n in names.items()])
