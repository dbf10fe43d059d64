"""Mixing documents to target domain weights by soft membership."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch
from orderloom.llm.words import Words, chunks

#: Expected labelled rows the classifier is fitted on, and its hashed words.
TRAIN_ROWS, BUCKETS = 5_000, 1 << 14
#: Expected rows of each domain at least, as far as it has them.
DOMAIN_ROWS = 50
#: Words' worth of evidence that a long text's posterior rests on.
EVIDENCE = 3.0
#: Without targets, domain shares are raised to this power.
TEMPER = 0.7
STEPS, TOLERANCE = 30, 1e-3
#: Without targets, how much all rates grow at most so that none is below 1.
MOST_LIFT = 2.0


def _bucket_counts(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(texts, lower=True)
    return words, (words.hashes() % np.uint64(BUCKETS)).astype(np.int64)


def fit_domains(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Domains, sorted, and the log probability of each hashed word in each.

    ``labelled`` has doc_id, text, domain. Every domain with a text with words
    counts. About ``train_rows`` rows are used, equally many of each domain,
    but ``DOMAIN_ROWS`` or all it has where that is more than its part. They
    are picked by a hash of doc_id and text; one count per domain and one per
    domain and bucket reach the driver.
    """
    known = labelled.filter(F.col("domain").isNotNull() & F.col("text").rlike(r"\S")).select(
        "doc_id", "text", F.col("domain").cast("string").alias("domain")
    )
    held = {row["domain"]: row["rows"] for row in known.groupBy("domain").agg(F.count("*").alias("rows")).collect()}
    if not held:
        return [], np.empty((0, BUCKETS))
    part = max(DOMAIN_ROWS, -(-train_rows // len(held)))
    cuts = labelled.sparkSession.createDataFrame(
        [(name, min(1 << 40, (part << 40) // rows)) for name, rows in held.items()], "domain string, cut long"
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    picked = known.join(F.broadcast(cuts), "domain").filter(place < F.col("cut"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            words, buckets = _bucket_counts(batch.column("text"))
            names, domain = np.unique(np.array(batch.column("domain").to_pylist(), dtype=object), return_inverse=True)
            cell, counts = np.unique(
                np.repeat(domain, words.counts) * BUCKETS + buckets, return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[cell // BUCKETS].tolist(), pa.string()),
                    pa.array((cell % BUCKETS).astype(np.int32)),
                    pa.array(counts.astype(np.int64)),
                ],
                ["domain", "bucket", "n"],
            )

    rows = (
        picked.select("doc_id", "text", "domain")
        .mapInArrow(count, "domain string, bucket int, n long")
        .groupBy("domain", "bucket").agg(F.sum("n").alias("n")).collect()
    )
    domains = sorted(held)
    counts = np.full((len(domains), BUCKETS), 0.5)
    for row in rows:
        counts[domains.index(row["domain"]), row["bucket"]] += row["n"]
    return domains, np.log(counts / counts.sum(axis=1, keepdims=True))


def with_posteriors(docs: DataFrame, log_words: np.ndarray, into: str) -> DataFrame:
    """``docs`` with one more column, a struct of tokens (words) and posteriors.

    Naive Bayes on the words of the whole text; long texts count as
    ``EVIDENCE`` words, so that memberships stay soft. A text without words
    belongs to all domains alike.
    """
    k = len(log_words)
    schema = docs.schema.simpleString()
    names = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, "text")):
            words, buckets = _bucket_counts(batch.column("text"))
            of = np.repeat(np.arange(len(words.counts)), words.counts)
            scores = np.stack(
                [np.bincount(of, weights=row[buckets], minlength=len(words.counts)) for row in log_words], axis=1
            )
            n = np.maximum(1, words.counts)[:, None]
            scores *= np.minimum(n, EVIDENCE) / n
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            scores /= scores.sum(axis=1, keepdims=True)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1, dtype=np.int32) * k), pa.array(scores.ravel())
            )
            held = pa.StructArray.from_arrays(
                [pa.array(words.counts.astype(np.int64)), lists], ["tokens", "p"]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, held], [*names, into])

    return docs.mapInArrow(
        judge, f"{schema.removeprefix('struct<').removesuffix('>')},{into}:struct<tokens:bigint,p:array<double>>"
    )


class Rates(NamedTuple):
    """Projected steps from 1 with the least rate they stop at, and what the result is multiplied by.

    ``totals`` and ``target`` are the domain totals it comes to and was to come to.
    """

    steps: list[np.ndarray]
    floor: float = 0.0
    lift: float = 1.0
    totals: np.ndarray = np.empty(0)
    target: np.ndarray = np.empty(0)
    met: bool = True


def _rate(p: Column, fit: Rates) -> Column:
    """The rate after projected steps from 1: each takes off p . step, not below the floor."""
    rate = F.lit(1.0)
    for step in fit.steps:
        move = F.lit(0.0)
        for k, value in enumerate(step):
            move = move + F.get(p, F.lit(k)) * F.lit(float(value))
        rate = F.greatest(F.lit(fit.floor), rate - move)
    return rate * F.lit(fit.lift)


def fit_rates(
    members: DataFrame, weights: np.ndarray | None = None, steps: int = STEPS, tolerance: float = TOLERANCE
) -> Rates:
    """Rates that make the expected domain totals match the targets.

    ``members`` has tokens and p. Minimizes the squared differences between
    the domain totals sum(rate * tokens * p) and the targets, each divided by
    the domain's own total, over rates of 0 or more. A step is the projected
    gradient in the metric of the tokens; with these weights a step length of
    one never overshoots. Targets have the given weights, and a sum at which
    no domain shrinks. Each domain is fitted to ``tolerance`` of its own
    target, in at most ``steps`` steps; ``met`` says whether. Each step is one aggregate over narrow rows; a
    document's rate follows from its posteriors and the fit alone.

    Without ``weights`` no member's rate is below 1: all rates are multiplied
    by what brings the smallest to 1, which leaves the shares of the domains
    as they are. Beyond ``MOST_LIFT`` the fit is made again over rates that
    stay above that part of 1, so shares then come only as near as they can.
    """
    first = members.agg(F.max(F.size("p")).alias("k")).first()["k"]
    if not first:
        return Rates([])

    def totals(rate: Column) -> np.ndarray:
        found = members.agg(
            *[F.sum(rate * F.col("tokens") * F.get("p", F.lit(k))).alias(f"t{k}") for k in range(first)]
        ).first()
        return np.array([found[f"t{k}"] or 0.0 for k in range(first)])

    own = totals(F.lit(1.0))
    keep_all = weights is None
    if not own.sum() > 0:
        return Rates([])
    scale = np.maximum(own, own.sum() * 1e-9)
    if weights is None:
        weights = (scale / scale.sum()) ** TEMPER
    weights = np.asarray(weights, dtype=float) / np.sum(weights)
    used = weights > 0
    target = weights * (own[used] / weights[used]).max()

    # A domain without a target is to shrink to nothing of its own.
    allowed = tolerance * np.where(target > 0, target, scale)

    def fitted(floor: float) -> Rates:
        fit, now = Rates([], floor), own
        while (far := bool((np.abs(now - target) > allowed).any())) and len(fit.steps) < steps:
            fit.steps.append((now - target) / scale)
            now = totals(_rate(F.col("p"), fit))
        return fit._replace(totals=now, target=target, met=not far)

    def lifted(fit: Rates, by: float) -> Rates:
        return fit._replace(lift=by, totals=fit.totals * by, target=fit.target * by)

    fit = fitted(0.0)
    if not keep_all:
        return fit
    least = members.agg(F.min(_rate(F.col("p"), fit)).alias("least")).first()["least"]
    if least >= 1:
        return fit
    if least * MOST_LIFT < 1:
        return lifted(fitted(1 / MOST_LIFT), MOST_LIFT)
    # A hair more, so that rounding takes no rate below 1.
    return lifted(fit, (1 + 1e-12) / least)


def mix_sources(
    docs: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float] | None = None,
    train_rows: int = TRAIN_ROWS,
    into: str = "mix",
) -> DataFrame:
    """``docs`` with a struct column of tokens, posteriors p and rate.

    A classifier fitted on ``labelled`` (doc_id, text, domain) predicts each
    document's domain posteriors, and nonnegative rates are fitted so that
    expected domain totals have the target ``weights`` (by domain; domains
    without one get 0; one whose domain has no labelled words is an error);
    targets that are not met are reported by a warning. Without weights no rate is below 1. Every row keeps its columns; ``into`` must be a new
    name. A text without words has no tokens and moves no total. Without
    labelled rows every rate is 1. Repeated rows have equal rates.
    """
    if into in docs.columns:
        raise ValueError(f"docs already has a column {into}")
    scratch = Scratch(docs.sparkSession, "mixing")
    domains, log_words = fit_domains(labelled, train_rows)
    unknown = sorted(d for d, weight in (weights or {}).items() if weight and d not in domains)
    if unknown and domains:
        raise ValueError(f"weights of domains without labelled words: {', '.join(unknown)}")
    if not domains:
        return docs.withColumn(
            into,
            F.struct(
                F.lit(0).cast("long").alias("tokens"), F.array().cast("array<double>").alias("p"),
                F.lit(1.0).alias("rate"),
            ),
        )
    members = scratch.store(
        "members", with_posteriors(docs.select("text"), log_words, into).select(f"{into}.*")
    )
    target = None if weights is None else np.array([weights.get(d, 0.0) for d in domains])
    fit = fit_rates(members, target)
    scratch.drop("members")
    if not fit.met:
        missed = (f"{d}: {t:.6g} of {w:.6g}" for d, t, w in zip(domains, fit.totals, fit.target))
        warnings.warn(f"mixing misses its targets after {len(fit.steps)} steps; {'; '.join(missed)}", stacklevel=2)
    judged = with_posteriors(docs, log_words, into)
    return judged.withColumn(
        into,
        F.struct(f"{into}.tokens", f"{into}.p", _rate(F.col(f"{into}.p"), fit).alias("rate")),
    )


def draw_copies(mixed: DataFrame, mix: str = "mix", seed: int = 29) -> DataFrame:
    """Each row as often as its rate says: the whole part, one more by chance.

    Chance is a hash of the row's doc_id and text, so a repeated job draws the same.
    """
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    columns = [c for c in mixed.columns if c != mix]
    copies = F.floor(F.col(f"{mix}.rate") + chance).cast("int")
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(1), copies)).alias(mix)).drop(mix)
