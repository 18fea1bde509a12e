"""Mixing documents to target weights of domains they belong to in part.

A table of labelled documents teaches a classifier, which gives every document a posterior
over the domains. With t tokens, posteriors p and a rate r for every document, domain k is
expected to get sum(t * p_k * r) tokens. The rates are fitted by projected gradient descent:
from r = 1 they follow the gradient of the weighted squared distance between expected and
wanted totals and are cut off at zero. The gradient is preconditioned by the inverse of the
domains' moments over the documents that are free to move, those not held at zero; where that
leads no further, as targets are out of reach, steps with momentum go on until nothing changes. A
document's rate depends on its posteriors alone, so a rate is a formula over them, one term for
each step taken; a step is an aggregation or two over tokens and posteriors, from which a number
for each two domains comes to the driver.

Everything is done with DataFrame functions. The classifier is a Bernoulli naive Bayes model
over the pieces of text (words, and the marks after them) that tell domains apart best. It is
small, and is looked up in constant arrays by the hash of a piece, row by row, without a join.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import fresh, hash_share, text_of
from starload.session import stored

_SLOTS = 4096  # places of the arrays that the model is looked up in
_STEPS_AT_ONCE = 10  # after so many steps the rates are written
_LENGTHS = [1.0, 0.5, 0.25, 2.0**-4, 2.0**-6, 2.0**-10]  # of a step that is tried
_SETTLING = 25  # steps over which totals have to stay
_HELD = 1e-3  # a rate up to this counts as zero if the gradient pushes it down
_BETWEEN = "\u0001"  # stands between the pieces in the model's text and in none of them


logger = logging.getLogger(__name__)


class Model(NamedTuple):
    """Domains, the log of their share among the labelled, and for each piece and domain the
    log probability that a document has it and that it does not."""

    domains: list[str]
    prior: list[float]
    pieces: list[str]
    present: list[list[float]]
    absent: list[list[float]]


def pieces_of(text_col: str) -> Column:
    """Lower-case text cut at white space and where marks follow a letter."""
    return F.split(F.lower(text_of(text_col)), r"\s+|(?<=\p{L})(?=[^\p{L}\s])")


# -- the classifier


def learn(
    docs: DataFrame,
    labels: DataFrame,
    domains: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = 2000,
    features: int = 512,
    least_chi2: float = 25.0,
    least_lift: float = 3.0,
) -> Model:
    """From `labels` (the id and `domain`) about `sample_docs` documents of each domain, which
    their ids' hashes choose, teach the model; the domains' shares come from all labels.

    Labels of other domains, null ids and labels without a document are left out. A label that
    repeats teaches once, an id with labels of several domains teaches each of them. A domain
    without a labelled document has probability zero everywhere; if none has one, all are
    equally likely for all documents. The `features` pieces with the highest chi-squared become the model, of those
    that are `least_lift` times likelier in one domain than in any other: pieces that merely
    come with long texts would make domains of the lengths.
    """
    named = labels.select(F.col(id_col).alias("id"), "domain").filter(
        F.col("id").isNotNull() & F.col("domain").isin(*domains)
    )
    counted = {r["domain"]: r["n"] for r in named.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    nothing = Model(list(domains), [0.0] * len(domains), [], [], [])
    if not counted:
        return nothing
    wanted = F.element_at(F.create_map(*[F.lit(x) for d, n in counted.items() for x in (d, float(n))]), F.col("domain"))
    # Of bounded size, whatever the number of labels: about half as many again as wanted, and of
    # each id a row for each domain at most.
    sample = named.filter(hash_share("id") * wanted < 1.5 * sample_docs).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    taught = texts.join(F.broadcast(sample), "id").select(
        "domain", F.array_distinct(pieces_of("text")).alias("pieces")
    )
    taught = stored(taught, "taught")
    sizes = {r["domain"]: r["n"] for r in taught.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return nothing
    found = [d for d in domains if d in sizes]
    total = sum(sizes.values())
    having = (
        taught.select("domain", F.explode("pieces").alias("piece"))
        .groupBy("piece")
        .agg(*[F.sum((F.col("domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(found)])
    )
    having = having.filter(F.length("piece").between(1, 64) & ~F.contains("piece", F.lit(_BETWEEN)))
    share = reduce(lambda a, b: a + b, [F.col(f"n{k}") for k in range(len(found))]) / F.lit(total)
    chi2 = reduce(
        lambda a, b: a + b,
        [
            (F.col(f"n{k}") - share * sizes[d]) ** 2 / (share * sizes[d] * (1 - share))
            for k, d in enumerate(found)
        ],
    )
    chances = F.sort_array(
        F.array(*[(F.col(f"n{k}") + 0.5) / (sizes[d] + 1) for k, d in enumerate(found)]), asc=False
    )
    telling = chances[0] >= least_lift * chances[1] if len(found) > 1 else F.lit(False)
    best = (
        having.filter((share < 1) & telling)
        .withColumn("chi2", chi2).filter(F.col("chi2") >= least_chi2)
        .withColumn("slot", _slot(F.col("piece")))
        .orderBy(F.desc("chi2"), "piece").limit(features).collect()
    )
    taken: set[int] = set()
    pieces, present, absent = [], [], []
    for row in best:
        if row["slot"] not in taken:  # two pieces in one place: the better one stays
            taken.add(row["slot"])
            chance = [(row[f"n{k}"] + 0.5) / (sizes[d] + 1) for k, d in enumerate(found)]
            pieces.append(row["piece"])
            present.append([math.log(c) for c in chance])
            absent.append([math.log(1 - c) for c in chance])
    all_labels = sum(counted[d] for d in found)
    return Model(found, [math.log(counted[d] / all_labels) for d in found], pieces, present, absent)


def _slot(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(_SLOTS)).cast("int")


def _adding(table: Column):
    return lambda total, place: total + F.get(table, place)


def _constant(values: Sequence[str]) -> Column:
    """A constant array of strings, written as one literal."""
    return F.split(F.lit(_BETWEEN.join(values)), _BETWEEN)


def posteriors(
    docs: DataFrame, model: Model, domains: Sequence[str], text_col: str = "text"
) -> DataFrame:
    """`docs` with a column `p_<domain>` for each domain, in place of columns of that name.

    They add up to one. A null or empty text has none of the model's pieces.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in {f"p_{d}" for d in domains}]
    places = {
        r["piece"]: r["slot"]
        for r in spark.createDataFrame([(p,) for p in model.pieces], "piece STRING")
        .select("piece", _slot(F.col("piece")).alias("slot")).collect()
    }
    names = [""] * _SLOTS
    for piece, place in places.items():
        names[place] = piece
    lookup = _constant(names)
    known = F.filter(pieces_of(text_col), lambda x: (x != "") & (F.get(lookup, _slot(x)) == x))
    found, *scores = fresh(docs, "found", *[f"score{k}" for k in range(len(model.prior))])
    scored = docs.select(*kept, F.transform(F.array_distinct(known), _slot).alias(found))
    for k, prior in enumerate(model.prior):
        start = prior + sum(a[k] for a in model.absent)
        weights = ["0"] * _SLOTS
        for piece, has, lacks in zip(model.pieces, model.present, model.absent, strict=True):
            weights[places[piece]] = repr(float(has[k] - lacks[k]))
        table = _constant(weights).cast("array<double>")
        scored = scored.withColumn(scores[k], F.aggregate(found, F.lit(start), _adding(table)))
    columns = [F.col(score) for score in scores]
    top = F.greatest(*columns) if len(columns) > 1 else columns[0]
    whole = reduce(lambda a, b: a + b, [F.exp(c - top) for c in columns])
    own = {d: F.exp(c - top) / whole for d, c in zip(model.domains, columns, strict=True)}
    return scored.select(*kept, *[own.get(d, F.lit(0.0)).alias(f"p_{d}") for d in domains])


# -- the rates


class Step(NamedTuple):
    """How far the last move is carried on, what is then taken off for each posterior, and the
    gradient for each posterior by which rates at zero are held there."""

    onward: float
    taken: list[float]
    held: list[float]


class Rates(NamedTuple):
    """Rates as a formula: the steps taken, the expected token totals they end in, what was
    wanted, how far each total may be off to count as met, and whether the totals have stopped
    changing."""

    steps: list[Step]
    totals: dict[str, float]
    wanted: dict[str, float]
    allowed: dict[str, float]
    settled: bool

    def column(self) -> Column:
        return _after(self.steps, list(self.wanted), F.lit(1.0), F.lit(1.0))["now"]

    def missed(self) -> dict[str, float]:
        """The domains whose targets are not met, and by how many tokens."""
        off = {d: self.totals[d] - self.wanted[d] for d in self.wanted}
        return {d: x for d, x in off.items() if abs(x) > self.allowed[d]}


def _along(weights: Sequence[Column | float], domains: Sequence[str]) -> Column:
    """The posteriors' weighted sum."""
    return reduce(lambda a, b: a + b, [w * F.col(f"p_{d}") for w, d in zip(weights, domains, strict=True)])


def _moved(now: Column, last: Column, onward, taken, held, domains: Sequence[str]) -> Column:
    """The rate after one step."""
    stays = (now <= _HELD) & (_along(held, domains) > 0)
    ahead = now + onward * (now - last) - _along(taken, domains)
    return F.when(stays, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), ahead))


def _after(steps: Sequence[Step], domains: Sequence[str], now: Column, last: Column) -> Column:
    """A struct of the rate `now` after the steps, and the `last` one before.

    The steps are constant arrays: whatever is in them, Spark compiles the same code.
    """
    start = F.struct(now.alias("now"), last.alias("last"))
    if not steps:
        return start
    columns = [
        [s.onward for s in steps], *zip(*[s.taken for s in steps], strict=True),
        *zip(*[s.held for s in steps], strict=True),
    ]
    onward, *others = [
        _constant([repr(float(x)) for x in column]).cast("array<double>") for column in columns
    ]
    taken, held = others[: len(domains)], others[len(domains) :]

    def move(rates: Column, step: Column) -> Column:
        at = [[F.get(c, step) for c in columns] for columns in (taken, held)]
        after = _moved(rates["now"], rates["last"], F.get(onward, step), *at, domains)
        return F.struct(after.alias("now"), rates["now"].alias("last"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), start, move)


class _Fit:
    """Rates on their way: the steps so far, and members with the rates after most of them."""

    def __init__(self, members: DataFrame, domains: Sequence[str], tokens_col: str):
        self.domains = list(domains)
        self.tokens = F.col(tokens_col).cast("double")
        self.own = [F.col(f"p_{d}") for d in domains]
        ones = F.lit(1.0).alias("now"), F.lit(1.0).alias("last")
        self.members = members.select(tokens_col, *[f"p_{d}" for d in domains], *ones)
        self.steps: list[Step] = []
        self.recent: list[Step] = []

    def take(self, step: Step) -> None:
        self.steps.append(step)
        self.recent.append(step)
        if len(self.recent) == _STEPS_AT_ONCE:
            self.members = stored(after_steps(self.members, self.recent, self.domains), "rates")
            self.recent = []

    def _ahead(self) -> DataFrame:
        return after_steps(self.members, self.recent, self.domains)

    def totals(self, onward: float = 0.0) -> tuple[list[float], list[float]]:
        """Expected tokens of each domain now, and where the last move carried on would lead."""
        now, last = F.col("now"), F.col("last")
        size = range(len(self.own))
        sums = self._ahead().agg(
            *[F.sum(self.tokens * p * now).alias(f"a{i}") for i, p in enumerate(self.own)],
            *[F.sum(self.tokens * p * (now + onward * (now - last))).alias(f"b{i}") for i, p in enumerate(self.own)],
        ).first()
        return [sums[f"a{i}"] or 0.0 for i in size], [sums[f"b{i}"] or 0.0 for i in size]

    def free_moments(self, held: Sequence[float]) -> np.ndarray:
        """The domains' moments over documents that the gradient does not hold at zero."""
        free = self._ahead().filter(~((F.col("now") <= _HELD) & (_along(held, self.domains) > 0)))
        size = range(len(self.own))
        pairs = [(i, j) for i in size for j in size if i <= j]
        sums = free.agg(*[F.sum(self.tokens * self.own[i] * self.own[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
        return np.array([[sums[f"{min(i, j)}_{max(i, j)}"] or 0.0 for j in size] for i in size])

    def tried(self, taken: Sequence[float], held: Sequence[float]) -> list[list[float]]:
        """The totals that a step would lead to, for each length of it."""
        now, size = F.col("now"), range(len(self.own))
        sums = self._ahead().agg(
            *[
                F.sum(self.tokens * p * _moved(now, now, 0.0, [x * length for x in taken], held, self.domains)).alias(f"{n}_{i}")
                for n, length in enumerate(_LENGTHS) for i, p in enumerate(self.own)
            ]
        ).first()
        return [[sums[f"{n}_{i}"] or 0.0 for i in size] for n in range(len(_LENGTHS))]


def fit_rates(
    members: DataFrame,
    targets: dict[str, float],
    budget: float,
    tokens_col: str = "n_tokens",
    max_steps: int = 500,
    tolerance: float = 1e-3,
) -> Rates:
    """Rates for `members` (tokens and posteriors) that bring every domain's expected tokens
    to its share of `budget`.

    A target is met within `tolerance` of itself or, if it is zero, of the tokens that the domain
    has at rates of one. Each domain's distance is weighted by its own mass. A step goes where
    the moments of the free documents say the targets are, as far as that lessens the distance
    most. Once such steps lessen it by less than a hundredth, steps along the plain gradient, each
    carrying on the one before, follow until the totals settle, which is when 25 steps have moved
    none of them by more than `tolerance` of the budget: a domain that nobody belongs to, or that
    only comes along with others, can keep a target out of reach, and what remains is then about
    as small as non-negative rates allow. Targets that are not met are logged as a
    warning and told by `missed`; so are totals that still change after `max_steps`, which is only
    a guard against running for ever.
    """
    domains, size = list(targets), range(len(targets))
    fit = _Fit(members, domains, tokens_col)
    wanted = np.array([budget * targets[d] for d in domains])
    moments = fit.free_moments([0.0] * len(domains))
    mass = moments.diagonal()
    some = [i for i in size if mass[i] > 0]
    weight = np.array([1 / m if m > 0 else 0.0 for m in mass])
    totals = np.array(fit.totals()[0])
    allowed = tolerance * np.where(wanted > 0, wanted, totals)

    def ended(settled: bool) -> Rates:
        named = [dict(zip(domains, map(float, x), strict=True)) for x in (totals, wanted, allowed)]
        found = Rates(fit.steps, *named, settled)
        if found.missed() or not settled:
            logger.warning(
                "rates %s; off target by %s tokens", "settled" if settled else "still change", found.missed()
            )
        return found

    def met() -> bool:
        return budget <= 0 or bool((abs(totals - wanted) <= allowed).all())

    def distance(at: np.ndarray) -> float:
        return float(((at - wanted) ** 2 * weight).sum())

    while not met() and len(fit.steps) < max_steps:
        held = list((totals - wanted) * weight)
        free = fit.free_moments(held)
        taken = list(np.linalg.lstsq(free, totals - wanted, rcond=1e-12)[0])
        tried = [np.array(t) for t in fit.tried(taken, held)]
        best = min(range(len(tried)), key=lambda n: distance(tried[n]))
        if not distance(tried[best]) < 0.99 * distance(totals):
            break
        fit.take(Step(0.0, [x * _LENGTHS[best] for x in taken], held))
        totals = tried[best]
    if met():
        return ended(True)

    # No overlap of domains makes a step of this length too long.
    reach = max(
        (sum(moments[i][j] / math.sqrt(mass[i] * mass[j]) for j in some) for i in some), default=1.0
    )
    pace, nearest, nothing = 1.0, math.inf, [0.0] * len(domains)
    seen: list[np.ndarray] = []
    while len(fit.steps) < max_steps:
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        onward = (pace - 1) / faster
        at, ahead = fit.totals(onward)
        totals = np.array(at)
        seen.append(totals)
        settled = len(seen) > _SETTLING and abs(totals - seen[-1 - _SETTLING]).max() <= tolerance * budget
        if met() or settled:
            return ended(True)
        if distance(totals) > nearest:
            onward, faster = 0.0, 1.0
        nearest, pace = distance(totals), faster
        off = (totals if onward == 0 else np.array(ahead)) - wanted
        fit.take(Step(onward, list(off * weight / reach), nothing))
    totals = np.array(fit.totals()[0])
    return ended(met())


def after_steps(held: DataFrame, steps: Sequence[Step], domains: Sequence[str]) -> DataFrame:
    """`held` with its rates `now` and `last` moved on."""
    rates = _after(steps, domains, F.col("now"), F.col("last"))
    moved = held.withColumn("rates", rates)
    return moved.select(
        *[c for c in held.columns if c not in ("now", "last")],
        F.col("rates.now").alias("now"), F.col("rates.last").alias("last"),
    )


def _judged(
    docs: DataFrame, model: Model, domains: Sequence[str], text_col: str, least_membership: float
) -> DataFrame:
    """`docs` with tokens (words) and posteriors, in place of columns of those names. Posteriors
    below `least_membership` become zero, and the others add up to one again."""
    words = F.size(F.filter(F.split(text_of(text_col), r"\s+"), lambda w: w != ""))
    found = posteriors(docs.withColumn("n_tokens", words), model, domains, text_col)
    names = [f"p_{d}" for d in domains]
    least = F.least(F.lit(least_membership), F.greatest(*names) if len(names) > 1 else F.col(names[0]))
    kept = {n: F.when(F.col(n) >= least, F.col(n)).otherwise(F.lit(0.0)) for n in names}
    whole = reduce(lambda a, b: a + b, kept.values())
    return found.withColumns({n: c / whole for n, c in kept.items()})


def _copies(rate: Column, draw: Column) -> Column:
    """The rate rounded down, or up if a number from 0 to 1 is below what that leaves."""
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def _checked(targets: dict[str, float]) -> list[str]:
    if abs(sum(targets.values()) - 1) > 1e-9 or min(targets.values()) < 0:
        raise ValueError("targets must be shares that add up to one")
    return list(targets)


def _fitted(members: DataFrame, targets: dict[str, float], budget_ratio: float) -> Rates:
    return fit_rates(members, targets, budget_ratio * (members.agg(F.sum("n_tokens")).first()[0] or 0))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget_ratio: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_membership: float = 0.05,
) -> DataFrame:
    """One row per document: id, `n_tokens`, a posterior `p_<domain>` for each target, `rate`
    and `copies`.

    `labels` gives ids and their `domain`; targets are shares that add up to one, of
    `budget_ratio` times all tokens (words) of `docs`. `copies` is the rate rounded up or
    down, as the hash of id and text decides, so that its expectation is the rate. Repeated
    rows agree. A null text has no tokens and the rate of an empty one. An empty table gives
    an empty result. Other columns are ignored.

    A posterior below `least_membership` counts as none: the classifier leaves a trace of each
    domain in every document, and with it a target of zero would be out of reach of any rates.
    How far targets are met, and when fitting ends, is said at `fit_rates`.
    """
    domains = _checked(targets)
    model = learn(docs, labels, domains, id_col, text_col)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    source = source.withColumn("draw", hash_share("id", "text"))
    judged = _judged(source, model, domains, "text", least_membership)
    members = stored(judged.drop("text"), "members")
    rated = members.withColumn("rate", _fitted(members, targets, budget_ratio).column())
    return rated.select(
        F.col("id").alias(id_col), "n_tokens", *[f"p_{d}" for d in targets], "rate",
        _copies(F.col("rate"), F.col("draw")).alias("copies"),
    )


def mixture(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget_ratio: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_membership: float = 0.05,
) -> DataFrame:
    """The mixture itself: every row of `docs`, with its own columns, as often as `mix` says.

    Texts are judged once, and written with what was found.
    """
    domains = _checked(targets)
    model = learn(docs, labels, domains, id_col, text_col)
    # Under other names, so that no column of `docs` is taken for one of the model's.
    own = {c: f"own{place}" for place, c in enumerate(docs.columns)}
    draw = hash_share(own[id_col], own[text_col])
    source = docs.withColumnsRenamed(own).withColumn("draw", draw)
    members = stored(_judged(source, model, domains, own[text_col], least_membership), "members")
    rates = _fitted(members, targets, budget_ratio)
    often = members.withColumn("rate", rates.column()).select(
        *own.values(), F.explode(F.array_repeat(F.lit(1), _copies(F.col("rate"), F.col("draw"))))
    )
    return often.select(*[F.col(new).alias(c) for c, new in own.items()])
