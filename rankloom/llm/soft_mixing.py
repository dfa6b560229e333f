"""Document rates that bring expected domain token totals to given targets.

A classifier trained on a labelled table gives every document a posterior over domains. The rates
``r`` (how often to use a document) solve a least-squares problem over all documents,

    min over r >= 0:  1/2 sum_k (S_k(r) - T_k)^2 / N_k  +  ridge/2 sum_d t_d (r_d - 1)^2,
    S_k(r) = sum_d r_d t_d p_dk,  N_k = S_k(1),

with tokens t, posteriors p and targets T, by projected gradient steps. Scaled by 1/t_d, a step moves
documents of equal posterior alike, so a document's rate is a function of its posterior and of the
totals of the steps so far. Posteriors are whole 64ths; documents are summed by posterior once, and
each step is a small aggregate over these sums.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm import labelled
from rankloom.plans import scratch

FEATURES = 1 << 14
# Bounds of the training sample.
TRAIN_ROWS = 3000
TRAIN_BYTES = 16 << 20
UNITS = 64
RIDGE = 0.01
STEPS = 60


class Domains(NamedTuple):
    """All names; which of them have labels, in the order of the classifier's classes; and the classifier.

    ``factors`` say how many labelled documents a document of the sample stands for, by class.
    """

    names: tuple[str, ...]
    seen: tuple[int, ...]
    factors: tuple[float, ...]
    model: PipelineModel | None


class Plan(NamedTuple):
    """What the steps found: pulls of each step by domain, from which any posterior's rate follows."""

    names: tuple[str, ...]
    pulls: tuple[tuple[float, ...], ...]
    highest: float
    expected: tuple[float, ...]
    targets: tuple[float, ...]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def fit_domains(docs: DataFrame, labels: DataFrame, names: tuple[str, ...]) -> Domains:
    """Train on a bounded sample of ``labels(doc_id, domain)`` that holds every labelled domain.

    Domains are sampled in turn, so a rare one is not lost among many labels. Without labelled
    documents every posterior is uniform; with one domain only, it is certain. A name without any
    label has posterior 0 beside others.
    """
    number = F.array_position(F.array(*map(F.lit, names)), F.col("domain")).cast("int") - 1
    known, counts = labelled.sample_by_label(docs, labels, number, len(names), TRAIN_ROWS, TRAIN_BYTES)
    rows = scratch.materialise(known.select(words(F.col("text")).alias("_words"), F.col("label").cast("double").alias("_label")), "mixing-sample")
    sampled = {int(r["_label"]): r["count"] for r in rows.groupBy("_label").count().collect()}
    seen = sorted(sampled)
    factors = tuple(counts[i] / sampled[i] for i in seen)
    if len(seen) < 2:
        return Domains(names, tuple(seen), factors, None)
    # Classes without a label get no column of their own.
    dense = rows.withColumn("_label", F.array_position(F.array(*map(F.lit, seen)), F.col("_label").cast("int")).cast("double") - 1)
    stages = [
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=FEATURES),
        Normalizer(inputCol="_counts", outputCol="_features", p=2.0),
        LogisticRegression(featuresCol="_features", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class", family="multinomial", regParam=1e-4, maxIter=40, standardization=False),
    ]
    return Domains(names, tuple(seen), factors, Pipeline(stages=stages).fit(dense))


def posteriors(docs: DataFrame, domains: Domains) -> DataFrame:
    """``docs`` with ``_tokens``, the words of the text, and ``_shares``, 64ths by domain.

    The classifier saw domains as often as the sample has them. Its probabilities times ``factors``
    are those of the whole label table: taking documents by class moves its intercepts only.
    """
    counted = docs.withColumn("_words", words(F.col("text"))).withColumn("_tokens", F.size("_words").cast("long"))
    if domains.model is None:
        sure = domains.seen or tuple(range(len(domains.names)))
        even = F.array(*[F.lit(round(UNITS / len(sure)) if i in sure else 0) for i in range(len(domains.names))])
        return counted.drop("_words").withColumn("_shares", even)
    scored = domains.model.transform(counted)

    def whole_units(weighed: Column) -> Column:
        total = F.aggregate(weighed, F.lit(0.0), lambda a, x: a + x)
        units = [F.round(F.get(weighed, F.lit(j)) / total * UNITS).cast("int") for j in range(len(domains.seen))]
        return F.array(*[units[domains.seen.index(i)] if i in domains.seen else F.lit(0) for i in range(len(domains.names))])

    weighed = F.zip_with(vector_to_array("_probability"), F.array(*map(F.lit, domains.factors)), lambda p, f: p * f)
    # Bound once, as in ``rate``.
    shares = F.get(F.transform(F.array(weighed), whole_units), F.lit(0))
    return scored.withColumn("_shares", shares).select(*docs.columns, "_tokens", "_shares")


def step(rate: Column, pull: Column, highest: float) -> Column:
    """One projected step; the step width 1 / (1 + RIDGE) is the inverse of the largest curvature."""
    moved = rate - (pull + RIDGE * (rate - 1)) / (1 + RIDGE)
    return F.least(F.greatest(moved, F.lit(0.0)), F.lit(highest))


def dot(shares: Column, pulls: Column) -> Column:
    products = F.zip_with(shares, pulls, lambda p, e: p * e / UNITS)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)


def rate(shares: Column, plan: Plan) -> Column:
    """The rate of a posterior: all steps from 1 on."""
    if not plan.pulls:
        return F.lit(1.0)
    steps = ";".join(",".join(repr(x) for x in pull) for pull in plan.pulls)
    each = F.transform(F.split(F.lit(steps), ";"), lambda s: F.split(s, ",").cast("array<double>"))

    def replayed(known: Column) -> Column:
        return F.aggregate(each, F.lit(1.0), lambda r, e: step(r, dot(known, e), plan.highest))

    # The posterior is bound once; inside the steps it would be made anew for each.
    return F.round(F.get(F.transform(F.array(shares), replayed), F.lit(0)), 6)


def solve(scored: DataFrame, names: tuple[str, ...], weights: dict[str, float], total: float | None = None, highest: float | None = None) -> Plan:
    """Projected gradient over the output of ``posteriors``.

    Targets are ``weights``, scaled to a sum of 1, times ``total`` tokens (default: as many as there
    are). ``highest`` bounds the rates from above, too. Domains without tokens keep their target, which
    no rate can reach, and have no influence.
    """
    k = range(len(names))
    top = float("1e18") if highest is None else float(highest)
    sums = scratch.materialise(
        scored.groupBy(F.col("_shares").alias("shares")).agg(F.sum("_tokens").cast("double").alias("tokens"))
        .withColumn("rate", F.lit(1.0)), "mixing-sums"
    )

    def totals(df: DataFrame) -> list[float]:
        columns = [F.sum(F.col("tokens") * F.col("rate") * F.get("shares", F.lit(i)) / UNITS) for i in k]
        return [x or 0.0 for x in df.agg(*columns).first()]

    mass = totals(sums)
    whole = sum(weights.get(n, 0.0) for n in names) or 1.0
    amount = sum(mass) if total is None else total
    targets = [weights.get(n, 0.0) / whole * amount for n in names]
    pulls: list[tuple[float, ...]] = []
    now, state = mass, sums
    for i in range(STEPS):
        pull = tuple(round((now[j] - targets[j]) / mass[j], 9) if mass[j] else 0.0 for j in k)
        if max(map(abs, pull), default=0.0) < 1e-6:
            break
        pulls.append(pull)
        state = state.withColumn("rate", step(F.col("rate"), dot(F.col("shares"), F.array(*map(F.lit, pull))), top))
        if i % 8 == 7:
            state = scratch.materialise(state, "mixing-rates")
        before, now = now, totals(state)
        if all(abs(a - b) <= 1e-7 * (m or 1.0) for a, b, m in zip(before, now, mass)):
            break
    return Plan(names, tuple(pulls), top, tuple(now), tuple(targets))


def copies(rate: Column, doc_id: Column) -> Column:
    """Whole uses of a document: the rate, rounded up with its fraction as probability by a hash."""
    place = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(rate + place).cast("int")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``(doc_id, n_tokens, p_<domain> ..., rate, copies)`` for every row of ``docs(doc_id, text)``.

    ``labels(doc_id, domain)`` is the labelled table, ``weights`` the wanted token shares. A null or
    empty text has no tokens and gets a rate, too; repeated rows count once each. Every name in
    ``weights`` has its column and its target; without labels for it, ``p`` is 0.
    """
    domains = fit_domains(docs, labels, tuple(sorted(weights)))
    scored = scratch.materialise(posteriors(docs.select("doc_id", "text"), domains).select("doc_id", "_tokens", "_shares"), "mixing-posteriors")
    plan = solve(scored, domains.names, weights)
    return scored.withColumn("rate", rate(F.col("_shares"), plan)).select(
        "doc_id",
        F.col("_tokens").alias("n_tokens"),
        *[(F.coalesce(F.get("_shares", F.lit(i)), F.lit(0)) / UNITS).alias(f"p_{n}") for i, n in enumerate(domains.names)],
        "rate",
        copies(F.col("rate"), F.col("doc_id")).alias("copies"),
    )


def resample(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str, surplus: float = 1.05) -> DataFrame:
    """``docs`` with the same columns, thinned so that the token shares come near ``weights``.

    No document is used more than once. The amount is set by domain ``anchor``: its target lies
    ``surplus`` times above what it has, so its documents reach rate 1 and stay. Without labels or
    tokens for ``anchor`` there is no amount, and all documents stay.
    """
    domains = fit_domains(docs, labels, tuple(sorted(weights)))
    scored = posteriors(docs.select(F.struct(*docs.columns).alias("row"), "text"), domains)
    held = scratch.materialise(scored.select("_tokens", "_shares"), "mixing-posteriors")
    if anchor not in domains.names:
        return docs
    at = domains.names.index(anchor)
    own = held.agg(F.sum(F.col("_tokens") * F.get("_shares", F.lit(at)) / UNITS)).first()[0] or 0.0
    if not own:
        return docs
    share = weights[anchor] / (sum(weights.get(n, 0.0) for n in domains.names) or 1.0)
    plan = solve(held, domains.names, weights, surplus * own / share if share else None, 1.0)
    used = copies(rate(F.col("_shares"), plan), F.coalesce(F.col("row")["doc_id"].cast("string"), F.lit("")))
    return scored.where(used >= 1).select("row.*")
