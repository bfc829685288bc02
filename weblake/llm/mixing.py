"""Mixing to target weights with soft domain membership (operator 7); DataFrame functions only.

1. *Posteriors.* A labelled table gives some documents a domain. A naive Bayes classifier
   over binned features of the text (length, distinct words, capitals, symbols, word
   length) turns these labels into a posterior over the domains for every document.
2. *Rates.* Nonnegative document rates r are fitted so that the expected tokens of every
   domain, ``sum r_i n_i p_ik``, match the targets ``T_k``: least squares with a small pull
   of each rate towards 1, by accelerated projected gradient. A step needs only the K
   domain residuals; a rate is a function of the document's posterior and of the residuals
   so far, so an iteration is one aggregation and no rate table is kept between steps.
   Documents of equal feature bins have equal posteriors and so equal rates: the iterations
   run over one row per bin profile (at most ``BINS ** features`` rows, whatever the corpus).
3. *Copies.* A document is taken ``floor(r)`` times, and once more if its id's hash falls
   below the fraction, so the expected count is the rate and reruns agree.

``budget`` is the tokens aimed at; by default the smallest total at which no domain's
target lies below its present tokens. This keeps the domains' totals, not every document:
what repeated documents add to an abundant domain, its own documents lose. With ``least=1``
no rate is below 1, so that every document is kept, and without a ``budget`` the total is
raised to what its most abundant domain then needs, until the domains meet their weights
(not for weights that no repetition meets, as without labels). The fit ends when residuals settle, or after
``max_steps``; a domain that is then farther from its target than ``MISSED`` of all tokens is
reported by a warning with its distance.

Null and empty texts have no tokens, the lowest bins and a rate like others. Labels of no
document, null labels and domains outside the given list are ignored, repeated labels of
one document count once (the smallest domain name); without any labels posteriors are
uniform. An empty table gives an empty result; repeated rows get the same rate; rows with
a null id are hashed as such; extra columns pass through.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

BINS = 8
FEATURES = ("length", "distinct", "capitals", "symbols", "word_length")
PULL = 1e-3           # weight of the pull towards rate 1
TOLERANCE = 1e-5      # of the largest change of a residual, as a share of all tokens
SETTLED = 1e-4        # change of a residual below which a raised total is tried
RAISE = 1e-3          # least raise of the total, as a share of it
MAX_STEPS = 80        # of the fit, by default
MISSED = 5e-3         # distance from a target, as a share of all tokens, that is reported


def _bin(value: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(F.coalesce(value, F.lit(0.0))).cast("int")))


def with_profile(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__n`` (tokens: words of the text) and ``__profile`` (its feature bins as a number)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.withColumn("__words", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    parts = parts.withColumns({"__n": F.size("__words").cast("long"), "__d": F.size(F.array_distinct("__words")), "__size": F.length(text),
                               "__caps": F.length(F.regexp_replace(text, "[^A-Z]+", "")), "__marks": F.length(F.regexp_replace(text, "[^#*$%&|<>!]+", ""))})
    n, size = F.greatest(F.col("__n"), F.lit(1)), F.greatest(F.col("__size"), F.lit(1))
    bins = [_bin(F.log2(n) / 2), _bin(F.col("__d") / n * (BINS - 0.001)), _bin(F.col("__caps") / size * 20), _bin(F.col("__marks") / size * 50), _bin(size / n / 2)]
    code = F.lit(0)
    for b in bins:
        code = code * BINS + b
    return parts.withColumn("__profile", code).drop("__words", "__d", "__size", "__caps", "__marks")


def _feature(j: int) -> Column:
    return F.pmod(F.floor(F.col("__profile") / F.lit(BINS ** (len(FEATURES) - 1 - j))).cast("int"), F.lit(BINS))


def fit_posteriors(profiled: DataFrame, labels: DataFrame, domains: list[str], id_col: str, label_col: str) -> list[list]:
    """Log-probabilities [domain][prior, then feature x bin], from at most domains * features * bins counts."""
    known = labels.where(F.col(label_col).isin(domains)).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__domain"))
    seen = profiled.select(F.col(id_col).alias("__id"), "__profile").join(known, "__id").groupBy("__domain", "__profile").count()
    bins = F.explode(F.array(*[F.struct(F.lit(j).alias("feature"), _feature(j).alias("bin")) for j in range(len(FEATURES))]))
    counts = {(r[0], r[1], r[2]): r[3] for r in
              seen.select("__domain", bins.alias("x"), "count").groupBy("__domain", "x.feature", "x.bin").agg(F.sum("count")).collect()}
    total = {d: sum(c for (k, j, _), c in counts.items() if k == d and j == 0) for d in domains}
    everything = sum(total.values())
    return [[math.log((total[d] + 1) / (everything + len(domains)))]
            + [[math.log((counts.get((d, j, b), 0) + 1) / (total[d] + BINS)) for b in range(BINS)] for j in range(len(FEATURES))] for d in domains]


def with_posteriors(rows: DataFrame, logs: list[list]) -> DataFrame:
    """Add ``__p``, the array of domain posteriors of ``__profile``."""
    scores = []
    for prior, *tables in logs:
        score = F.lit(prior)
        for j, values in enumerate(tables):
            score = score + F.element_at(F.array(*[F.lit(v) for v in values]), _feature(j) + 1)
        scores.append(score)
    scored = rows.withColumn("__s", F.array(*scores)).withColumn("__top", F.array_max("__s"))
    scored = scored.withColumn("__e", F.transform("__s", lambda s: F.exp(s - F.col("__top"))))
    whole = F.aggregate("__e", F.lit(0.0), lambda a, x: a + x)
    return scored.withColumn("__w", whole).withColumn("__p", F.transform("__e", lambda e: e / F.col("__w"))).drop("__s", "__top", "__e", "__w")


def _state(history: list[tuple[list[float], float]], least: float = 0.0) -> Column:
    """struct(r, y): the rate after the steps so far and the point where the next gradient is
    taken, from the posterior and the (residuals, momentum) of every step."""
    start = F.struct(F.lit(max(1.0, least)).alias("r"), F.lit(max(1.0, least)).alias("y"))
    if not history:
        return start
    rate = 1 / (1 + PULL)
    steps = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in rho]).alias("rho"), F.lit(float(beta)).alias("beta")) for rho, beta in history])

    def move(state, step):
        slope = F.aggregate(F.zip_with("__p", step["rho"], lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
        new = F.greatest(F.lit(float(least)), state["y"] - F.lit(rate) * (slope + F.lit(PULL) * (state["y"] - 1)))
        return F.struct(new.alias("r"), (new + step["beta"] * (new - state["r"])).alias("y"))

    return F.aggregate(steps, start, move)


def fit_rates(profiles: DataFrame, weights: list[float], budget: float | None, least: float = 0.0,
              max_steps: int = MAX_STEPS) -> tuple[DataFrame, list[float]]:
    """(profile, __p, __rate) for every profile, and the domains' target tokens."""
    size = len(weights)

    def totals(at: Column | None) -> list[float]:
        row = (profiles.withColumn("__at", at) if at is not None else profiles.withColumn("__at", F.lit(1.0))).agg(
            *[F.sum(F.col("__tokens") * F.col("__at") * F.col("__p")[k]) for k in range(size)]).first()
        return [float(x or 0.0) for x in row]

    present = totals(None)
    everything = sum(present)
    share = [w / sum(weights) for w in weights]
    total = budget if budget is not None else max([p / s for p, s in zip(present, share) if s > 0], default=0.0)
    targets, history, momentum, before = [total * s for s in share], [], 1.0, None
    excess = 0.0          # by which a domain was above the total's share at the last raise: raises go on while it shrinks
    if budget is None and least > 0 and everything > 0:
        peaks = profiles.agg(*[F.max(F.col("__p")[k]) for k in range(size)]).first()
        excess = math.inf if all(p > s for p, s in zip(peaks, share)) else 0.0
    for _ in range(max_steps if everything > 0 else 0):
        now = present if not history and least <= 1 else totals(_state(history, least)["y"])
        rho = [round((a - t) / everything, 12) for a, t in zip(now, targets)]
        change = max(abs(a - b) for a, b in zip(rho, before)) if before is not None else math.inf
        needed = max([a / s for a, s in zip(now, share) if s > 0], default=0.0)
        if change < SETTLED and RAISE < needed / total - 1 < excess:   # rates at ``least`` hold a domain above its target: raise all targets
            total, excess, momentum = needed, needed / total - 1, 1.0
            targets = [total * s for s in share]
            rho = [round((a - t) / everything, 12) for a, t in zip(now, targets)]
        elif change < TOLERANCE:
            break
        elif before is not None and sum(a * a for a in rho) > sum(b * b for b in before):
            momentum = 1.0   # the momentum overshot: start it anew
        following = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        history.append((rho, (momentum - 1) / following))
        momentum, before = following, rho
    if everything > 0:
        missed = [a - t for a, t in zip(totals(_state(history, least)["r"]), targets)]
        if max(map(abs, missed)) > MISSED * everything:
            warnings.warn(f"the target weights are not met after {len(history)} steps: expected tokens minus targets by domain are "
                          f"{[round(x) for x in missed]} of {round(everything)} present tokens", stacklevel=2)
    return profiles.select("__profile", "__p", _state(history, least)["r"].alias("__rate")), targets


def fit(docs: DataFrame, labels: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "domain", budget: float | None = None, least: float = 0.0, max_steps: int = MAX_STEPS) -> DataFrame:
    """The staged table (__profile, __p, __rate) fitted to all of ``docs``; no rate is below ``least``."""
    domains = sorted(weights)
    slim = stage(with_profile(docs.select(id_col, text_col), text_col).select(id_col, "__profile", "__n"), "profiles")
    logs = fit_posteriors(slim, labels, domains, id_col, label_col)
    profiles = stage(with_posteriors(slim.groupBy("__profile").agg(F.sum("__n").alias("__tokens")), logs), "posteriors")
    rates, _ = fit_rates(profiles, [weights[d] for d in domains], budget, least, max_steps)
    return stage(rates, "rates")


def _copies(id_col: str, seed: int) -> Column:
    luck = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    whole = F.floor("__rate")
    return (whole + F.when(luck < F.col("__rate") - whole, 1).otherwise(0)).cast("int")


def rated(docs: DataFrame, rates: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """One row per document: id, n_tokens, a posterior per domain (``p_<domain>``), rate, copies."""
    domains = sorted(weights)
    joined = with_profile(docs.select(id_col, text_col), text_col).join(F.broadcast(rates), "__profile")
    return joined.select(id_col, F.col("__n").alias("n_tokens"), *[F.col("__p")[k].alias(f"p_{d}") for k, d in enumerate(domains)],
                         F.col("__rate").alias("rate"), _copies(id_col, seed).alias("copies"))


def mixed(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with their columns."""
    joined = with_profile(docs, text_col).join(F.broadcast(rates), "__profile")
    taken = joined.withColumn("__copies", _copies(id_col, seed)).where(F.col("__copies") > 0)
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
