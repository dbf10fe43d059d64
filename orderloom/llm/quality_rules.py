"""Quality rules as a short-circuit cascade."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Expected rows of the sample on which rules are timed.
SAMPLE_ROWS = 400

# White space but the blank, as the contract lists it (fixed values).
WHITE_SPACE = "\t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
#: Word numbers fit below a fingerprint in one long; longer texts sort whole windows.
PLACE_BITS = 24


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` holds; never null."""

    name: str
    rejects: Column


def base_measures(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """The contract's measures with doc_id and text; a null text has no words.

    ``carry`` names a struct column that holds the whole row of ``docs``.
    """
    row = [] if carry is None else [F.struct(*[docs[c] for c in docs.columns]).alias(carry)]
    names = [] if carry is None else [carry]
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = reduce(lambda x, c: F.replace(x, F.lit(c), F.lit(" ")), WHITE_SPACE, text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(
        *row,
        "doc_id",
        text.alias("text"),
        F.array_remove(F.split(blank, " "), "").alias("words"),
        lines.alias("lines"),
    )
    counted = first.select(
        *names,
        "doc_id",
        "text",
        "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("marks"),
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    placed = counted.withColumn("places", _window_places(F.col("marks"), F.col("n_words")))
    met = placed.withColumns(
        {"later": _neighbours(F.col("places"), -1), "sooner": _neighbours(F.col("places"), 1)}
    )
    whole = met.withColumn("windows", F.when(_packing_fails(), _sorted_windows(F.col("words"))))
    repeated = whole.withColumn(
        "starts",
        F.when(F.col("windows").isNotNull(), _repeated_windows(F.col("windows"))).otherwise(
            F.sort_array(F.transform(F.array_union("sooner", "later"), _number))
        ),
    )
    measures = repeated.select(
        *names,
        "doc_id",
        "text",
        F.struct(
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
            _covered(F.col("starts")).alias("n_repeat_words"),
        ).alias("measures"),
    )
    # Through a generator: a filter on measures would else be pushed below the
    # projections, which would compute them again inside each other.
    return measures.select(*names, "doc_id", "text", F.inline(F.array("measures")))


def _window_places(marks: Column, n_words: Column) -> Column:
    """Sorted longs of 3-word windows: fingerprint above, first word's number below."""

    def mark(i: Column) -> Column:
        return F.coalesce(F.get(marks, i), F.lit(0).cast("long"))

    packed = F.transform(
        marks,
        lambda m, i: F.shiftleft(
            m.bitwiseXOR(F.shiftleft(mark(i + 1), 13)).bitwiseXOR(F.shiftrightunsigned(mark(i + 2), 7)),
            PLACE_BITS,
        ).bitwiseOR(i.cast("long")),
    )
    fits = (n_words >= 3) & (n_words < 1 << PLACE_BITS)
    count = F.when(fits, n_words - 2).otherwise(F.lit(0)).cast("int")
    # The elements can't be null, so the longs are sorted as primitives.
    return F.sort_array(F.slice(packed, F.lit(1), count))


def _neighbours(places: Column, step: int) -> Column:
    """Places whose neighbour, one before or one behind, has the same fingerprint."""
    return F.filter(
        places,
        lambda v, j: F.shiftrightunsigned(v.bitwiseXOR(F.get(places, j + step)), PLACE_BITS) == 0,
    )


def _number(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _packing_fails() -> Column:
    """Whether different windows share a fingerprint, or the text is too long.

    The k-th of ``sooner`` and of ``later`` are neighbours with one
    fingerprint; they are compared word by word.
    """
    words = F.col("words")

    def differ(a: Column, b: Column) -> Column:
        a, b = _number(a).cast("int"), _number(b).cast("int")
        return reduce(
            lambda x, y: x | y, [F.get(words, a + k) != F.get(words, b + k) for k in range(3)]
        )

    clash = F.exists(F.zip_with("sooner", "later", differ), lambda x: x)
    return (F.col("n_words") >= 1 << PLACE_BITS) | clash


def _sorted_windows(words: Column) -> Column:
    """The 3-word windows themselves in order, with their first word's number."""
    return F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(
                F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"),
                F.get(words, i + 2).alias("c"), i.cast("long").alias("i"),
            ),
        )
    )


def _repeated_windows(windows: Column) -> Column:
    """First word numbers, ascending, of sorted windows equal to a neighbour."""

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    found = F.filter(
        windows, lambda x, j: equal(x, F.get(windows, j - 1)) | equal(x, F.get(windows, j + 1))
    )
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words in the union of the 3-word windows at ascending starts."""
    return F.aggregate(
        starts,
        F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("total")),
        lambda acc, p: F.struct(
            p.alias("last"),
            (acc["total"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def base_failed() -> Column:
    """Too short, or mostly repeated; the contract's base."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules on the measures and on the text; ratios are compared in integers."""
    text, n = F.col("text"), F.col("n_words")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return [
        Rule("symbols", 100 * F.col("n_symbols") > 10 * n),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 30 * n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n)),
        Rule("shouting", 100 * count(r"\p{Lu}") > 30 * F.col("word_chars")),
        Rule("exclamations", 100 * (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))) > 10 * n),
    ]


def order_rules(
    docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 17
) -> list[Rule]:
    """Rules by falling rejection per cost, both estimated on a sample.

    A sampled share of the documents, about ``sample_rows`` of them whatever
    the input's size, is measured once. One aggregate counts what each rule
    rejects, and each rule is timed alone against an empty pass. The order
    changes how much is evaluated, never a verdict.
    """
    total = docs.select("doc_id").count()
    if total == 0:
        return list(rules)
    fraction = min(1.0, sample_rows / total)
    sample = base_measures(docs.sample(fraction=fraction, seed=seed)).persist()
    try:
        counts = sample.agg(
            F.count("*").alias("n"),
            *[F.count_if(~base_failed() & rule.rejects).alias(f"r{i}") for i, rule in enumerate(rules)],
        ).first()

        def seconds(condition: Column) -> float:
            start = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()
            return time.perf_counter() - start

        empty = seconds(F.lit(False))
        merit = []
        for i, rule in enumerate(rules):
            cost = max(seconds(rule.rejects) - empty, 1e-3)
            merit.append((-(counts[f"r{i}"] + 0.5) / (counts["n"] + 1) / cost, i))
    finally:
        sample.unpersist()
    return [rules[i] for _, i in sorted(merit)]


def cascade(rules: Sequence[Rule]) -> Column:
    """The first rule in order that rejects, or null: later rules stay unread."""
    verdict = None
    for rule in rules:
        verdict = (
            F.when(rule.rejects, F.lit(rule.name))
            if verdict is None
            else verdict.when(rule.rejects, F.lit(rule.name))
        )
    return verdict if verdict is not None else F.lit(None).cast("string")


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    carry: str | None = None,
) -> DataFrame:
    """Measure every document and judge it by a cascade of rules.

    Rules are ordered by rejection per cost on a sample, then evaluated one
    after another until one rejects. Returns doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, one row per
    row of ``docs``. A null or empty text has no words and fails the base.
    Repeated rows are judged alike; a null doc_id is returned as it is; other
    columns are not read, unless ``carry`` names a struct column for the whole
    row. An empty table gives an empty result.
    """
    measured = base_measures(docs, carry)
    ordered = order_rules(docs, rules if rules is not None else default_rules(), sample_rows)
    rejected = cascade(ordered)
    return measured.select(
        *([] if carry is None else [carry]),
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(rejected.isNull()).alias("kept"),
    )
