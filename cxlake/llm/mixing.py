"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are counted in cells (source, language, topic) by their tokens
(words, an estimate that needs no vocabulary). Raking scales the cell weights
to each target marginal in turn until all three hold; a cell's weight over its
tokens is the calibrated rate of its documents. Documents are then sampled: a
document stays when a hash of its id and text is below its probability.

Targets are shares of tokens per level. By default they are flattened shares
of the data (``share ** temperature``, normalised): large sources, languages
and topics give way to small ones. Every level is raked, however many there are.
Up to ``DRIVER_CELLS`` cells (combinations that occur) are raked in numpy on the
driver; more are raked by Spark steps of the same arithmetic: per marginal a
sum by level and a join of the levels' factors to the cells, written to the
shared folder each round, and the rates meet the documents without a broadcast.
Only on request (``max_levels``) do the smaller sources and languages share one
level, ``(other)``.

``keep`` of all tokens are kept, every document at most once: no level can get
more than its own tokens over those kept. Wanted shares above that are set to it,
and the other levels share the rest in their wanted proportions (``reachable``).
Cells are raked under the same bound (weight <= tokens over tokens kept), so the
probabilities follow from the weights without a further cap and the kept tokens
meet the targets. Where the bounds of the cells allow no such table, the targets
move towards the data's shares, by the least of 64 even steps that does.

Defined results: null sources, languages and texts are levels of their own
(``(null)``; a null or empty text has no tokens and the topic ``empty``);
documents of cells without tokens are kept with probability ``keep``; rows that
repeat id and text share one fate; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cxlake.llm.shared import keep_on_disk

DIMENSIONS = ("source", "lang", "topic")
OTHER, NULL = "(other)", "(null)"
TEMPERATURE, KEEP, SEED = 0.5, 0.8, 17
DRIVER_CELLS = 100_000


def token_count(text: Column) -> Column:
    """Words of a text: runs without ASCII white space (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """Topic by form: empty, list, record (numbers and addresses), note (short), article, or longread."""
    return (
        F.when(tokens == 0, "empty")
        .when(F.coalesce(F.regexp_count(text, F.lit(r"\|")), F.lit(0)) * 4 > tokens, "list")
        .when(F.coalesce(text.rlike(r"[0-9]{12,}|@[a-z0-9-]+\."), F.lit(False)), "record")
        .when(tokens < 100, "note")
        .when(tokens < 1500, "article")
        .otherwise("longread")
    )


def with_cells(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``tokens`` and the levels ``_source``, ``_lang`` and ``_topic``.

    (A struct, so that no column of ``docs`` can clash with a computed one.)"""
    tokens = token_count(docs["text"])
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), tokens.alias("tokens"))
    return marked.select(
        "row",
        "tokens",
        F.coalesce(F.col("row")["source"].cast("string"), F.lit(NULL)).alias("_source"),
        F.coalesce(F.col("row")["lang"].cast("string"), F.lit(NULL)).alias("_lang"),
        topic_of(F.col("row")["text"], F.col("tokens")).alias("_topic"),
    )


def _large_levels(cells: DataFrame, dimension: str, most: int) -> list[str]:
    sums = cells.groupBy(f"_{dimension}").agg(F.sum("tokens").alias("tokens"))
    return [r[0] for r in sums.orderBy(F.desc("tokens"), f"_{dimension}").limit(most).collect()]


def _folded(column: Column, levels: Sequence[str]) -> Column:
    return F.when(column.isin(list(levels)), column).otherwise(OTHER)


def flattened(tokens: Mapping[str, float], temperature: float) -> dict[str, float]:
    """Target shares: the data's shares to the power of ``temperature``, normalised."""
    powered = {k: v**temperature for k, v in tokens.items() if v > 0}
    total = sum(powered.values())
    return {k: v / total for k, v in powered.items()}


def rake(cells: Sequence[Sequence[str]], tokens: np.ndarray, targets: Sequence[Mapping[str, float]], rounds: int = 500, close: float = 1e-9) -> np.ndarray:
    """Token weights of the cells whose marginal shares meet ``targets`` (one mapping per dimension).

    Levels without a target or without tokens are left out of a marginal and
    its shares are renormalised; weights sum to 1."""
    weight = tokens / max(tokens.sum(), 1e-300)
    steps = []
    for d, target in enumerate(targets):
        names = sorted({c[d] for c in cells})
        at = {n: i for i, n in enumerate(names)}
        level = np.array([at[c[d]] for c in cells], dtype=np.int64)
        present = np.bincount(level, weights=tokens, minlength=len(names)) > 0
        share = np.array([target.get(n, 0.0) for n in names]) * present
        steps.append((level, share / max(share.sum(), 1e-300), len(names)))
    for _ in range(rounds):
        off = 0.0
        for level, share, n in steps:
            now = np.bincount(level, weights=weight, minlength=n)
            factor = np.divide(share, now, out=np.zeros(n), where=now > 0)
            off = max(off, float(np.abs(now - share).max(initial=0.0)))
            weight = weight * factor[level]
        if off < close:
            break
    return weight / max(weight.sum(), 1e-300)


def reachable(wanted: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Shares in proportion to ``wanted``, none above ``most`` (which sums to 1 or more)."""
    full = np.zeros(len(wanted), dtype=bool)
    while not full.all():
        scale = (1 - most[full].sum()) / max(wanted[~full].sum(), 1e-300)
        over = ~full & (wanted * scale > most)
        if not over.any():
            return np.where(full, most, wanted * scale)
        full |= over
    return most


def _capped_rake(bound: np.ndarray, levels: Sequence[np.ndarray], targets: Sequence[np.ndarray], rounds: int, close: float) -> np.ndarray | None:
    """Weights min(bound, bound * product of the levels' factors) that meet ``targets``, or None.

    A level's factor takes the Newton step of its share where that has a
    solution, else the proportional one; neither oversteps, so the rounds converge
    whenever some table within the bounds meets the targets."""
    factors = [np.full(len(t), 1.0) for t in targets]
    for _ in range(rounds):
        off = 0.0
        for d, (level, target) in enumerate(zip(levels, targets, strict=True)):
            rate = np.prod([f[at] for f, at in zip(factors, levels, strict=True)], axis=0)
            now = np.bincount(level, weights=bound * np.minimum(rate, 1), minlength=len(target))
            capped = np.bincount(level, weights=np.where(rate >= 1, bound, 0), minlength=len(target))
            off = max(off, float(np.abs(now - target).sum()))
            free = now - capped
            newton = (target > capped) & (free > 1e-15)
            step = np.where(newton, (target - capped) / np.where(newton, free, 1), target / np.maximum(now, 1e-300))
            factors[d] = np.clip(factors[d] * step, 1e-100, 1e100)
        if off < close:
            return bound * np.minimum(np.prod([f[at] for f, at in zip(factors, levels, strict=True)], axis=0), 1)
    return None


ROUNDS, CLOSE, STEPS = 200, 1e-5, 64


def rake_within(
    cells: Sequence[Sequence[str]], tokens: np.ndarray, targets: Sequence[Mapping[str, float]], keep: float
) -> tuple[np.ndarray, list[dict[str, float]]]:
    """(weights, targets met): token weights of the cells, none above its tokens over ``keep`` of all tokens.

    Cells of a level without a target get no weight; if fewer tokens are left than
    ``keep`` asks for, all of them stay."""
    usable = (tokens > 0) & np.array([all(t.get(n, 0.0) > 0 for t, n in zip(targets, c, strict=True)) for c in cells], dtype=bool)
    weight = np.zeros(len(tokens))
    if not usable.any():
        return weight, [{} for _ in targets]
    part = tokens[usable]
    bound = part / min(keep * tokens.sum(), part.sum())
    names, levels, data, best = [], [], [], []
    for d, target in enumerate(targets):
        found, level = np.unique([c[d] for c, u in zip(cells, usable, strict=True) if u], return_inverse=True)
        most = np.bincount(level, weights=bound)
        names.append(found)
        levels.append(level)
        data.append(most / most.sum())
        best.append(reachable(np.array([target[n] for n in found]), most))

    def towards(step: int) -> list[np.ndarray]:
        return [(1 - step / STEPS) * x + step / STEPS * y for x, y in zip(data, best, strict=True)]

    def attempt(step: int) -> np.ndarray | None:
        return _capped_rake(bound, levels, towards(step), ROUNDS, CLOSE) if step else bound / bound.sum()

    met, out = STEPS, attempt(STEPS)
    if out is None:
        met, no = 0, STEPS
        out = attempt(0)
        while no - met > 1:
            step = (met + no) // 2
            tried = attempt(step)
            if tried is None:
                no = step
            else:
                met, out = step, tried
    weight[usable] = out / out.sum()
    return weight, [dict(zip(n.tolist(), t.tolist(), strict=True)) for n, t in zip(names, towards(met), strict=True)]


def keep_rates(weight: np.ndarray, tokens: np.ndarray, keep: float) -> np.ndarray:
    """Probabilities in proportion to weight / tokens, capped at 1, that keep ``keep`` of all tokens."""
    some = (tokens > 0) & (weight > 0)
    rate = np.divide(weight, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    wanted, full = keep * tokens.sum(), np.zeros(len(tokens), dtype=bool)
    scale = 0.0
    for _ in range(len(tokens) + 1):
        free = some & ~full
        if not free.any():
            break
        scale = (wanted - tokens[full].sum()) / weight[free].sum()
        over = free & (rate * scale >= 1)
        if not over.any():
            break
        full |= over
    out = np.where(full, 1.0, np.clip(rate * scale, 0.0, 1.0))
    return np.where(tokens > 0, out, keep)


def rates_on_driver(counted: DataFrame, targets: Mapping[str, Mapping[str, float]], keep: float, temperature: float) -> DataFrame:
    """Levels, weight and probability of every cell of ``counted``, raked in numpy (the cells are collected)."""
    levels = [f"_{d}" for d in DIMENSIONS]
    rows = counted.select(*levels, "tokens").orderBy(*levels).collect()
    cells, tokens = [tuple(r)[:3] for r in rows], np.array([r["tokens"] for r in rows], dtype=float)
    wanted = []
    for d, name in enumerate(DIMENSIONS):
        sums: dict[str, float] = {}
        for c, t in zip(cells, tokens, strict=True):
            sums[c[d]] = sums.get(c[d], 0.0) + t
        wanted.append(targets.get(name) or flattened(sums, temperature))
    weight, _ = rake_within(cells, tokens, wanted, keep)
    rates = keep_rates(weight, tokens, keep)
    table = [(*c, float(w), float(p)) for c, w, p in zip(cells, weight, rates, strict=True)]
    return counted.sparkSession.createDataFrame(table, "_source string, _lang string, _topic string, weight double, probability double")


def _reachable_levels(cells: DataFrame, level: str) -> DataFrame:
    """Level, ``data`` and ``best`` share of the levels of ``cells`` (see ``reachable``), from ``bound`` and ``wanted_<level>``."""
    sums = keep_on_disk(cells.groupBy(level).agg(F.sum("bound").alias("most"), F.first(f"wanted{level}").alias("wanted")))
    scale, full = 0.0, -1
    while True:
        over = F.col("wanted") * scale > F.col("most")
        r = sums.agg(F.sum("most").alias("all"), F.sum(over.cast("long")).alias("n"), F.sum(F.when(over, F.col("most"))).alias("held"), F.sum(F.when(~over, F.col("wanted"))).alias("free")).first()
        if r["n"] == full or not r["free"]:
            break
        # the scale only grows, so what is full stays full
        full, scale = r["n"], max(scale, (1 - (r["held"] or 0.0)) / r["free"])
    return keep_on_disk(sums.select(level, (F.col("most") / r["all"]).alias("data"), F.least("most", F.col("wanted") * scale).alias("best")))


def _capped_rake_by_steps(cells: DataFrame, targets: Mapping[str, DataFrame], step: int) -> DataFrame | None:
    """``_capped_rake`` over a table of cells: ``cells`` with their ``rate``, or None. ``targets``: data and best share by level."""
    state = cells.withColumn("rate", F.lit(1.0))
    for _ in range(ROUNDS):
        off = 0.0
        for level, shares in targets.items():
            sums = state.groupBy(level).agg(
                F.sum(F.col("bound") * F.least("rate", F.lit(1.0))).alias("now"), F.sum(F.when(F.col("rate") >= 1, F.col("bound")).otherwise(0.0)).alias("capped")
            )
            target = F.col("data") * (1 - step / STEPS) + F.col("best") * (step / STEPS)
            met = sums.join(shares, level).withColumn("target", target).withColumn("free", F.col("now") - F.col("capped"))
            newton = (F.col("target") > F.col("capped")) & (F.col("free") > 1e-15)
            factor = F.when(newton, (F.col("target") - F.col("capped")) / F.col("free")).otherwise(F.col("target") / F.greatest("now", F.lit(1e-300)))
            factors = keep_on_disk(met.select(level, factor.alias("factor"), F.abs(F.col("now") - F.col("target")).alias("off")))
            off = max(off, factors.agg(F.sum("off")).first()[0])
            rate = F.greatest(F.lit(1e-100), F.least(F.lit(1e100), F.col("rate") * F.col("factor")))
            state = state.join(factors.select(level, "factor"), level).withColumn("rate", rate).drop("factor")
        state = keep_on_disk(state)
        if off < CLOSE:
            return state
    return None


def rates_by_steps(counted: DataFrame, targets: Mapping[str, Mapping[str, float]], keep: float, temperature: float) -> DataFrame:
    """``rates_on_driver`` for any number of cells: the driver gets sums only."""
    levels = [f"_{d}" for d in DIMENSIONS]
    cells = counted.select(*levels, "tokens").where("tokens > 0")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for d, level in zip(DIMENSIONS, levels, strict=True):
        if targets.get(d):
            wanted = counted.sparkSession.createDataFrame([(n, float(t)) for n, t in targets[d].items() if t > 0], f"{level} string, wanted{level} double")
        else:
            share = (F.sum("tokens") / F.lit(float(max(total, 1)))) ** temperature
            wanted = counted.where("tokens > 0").groupBy(level).agg(share.alias(f"wanted{level}"))
        cells = cells.join(wanted, level)
    cells = keep_on_disk(cells)
    part = cells.agg(F.sum("tokens")).first()[0] or 0
    budget = float(min(keep * total, part)) or 1.0
    bounded = cells.withColumn("bound", F.col("tokens") / budget)
    shares = {level: _reachable_levels(bounded, level) for level in levels}
    bounded = keep_on_disk(bounded.select(*levels, "tokens", "bound"))

    def attempt(step: int) -> DataFrame | None:
        return _capped_rake_by_steps(bounded, shares, step) if step and part else bounded.withColumn("rate", F.lit(budget / max(part, 1)))

    out = attempt(STEPS)
    if out is None:
        met, no = 0, STEPS
        out = attempt(0)
        while no - met > 1:
            step = (met + no) // 2
            tried = attempt(step)
            if tried is None:
                no = step
            else:
                met, out = step, tried
    rated = out.select(*levels, (F.col("bound") * F.least("rate", F.lit(1.0))).alias("weight"), F.least("rate", F.lit(1.0)).alias("probability"))
    joined = counted.join(rated, levels, "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(keep)
    return joined.select(*levels, F.coalesce("weight", F.lit(0.0)).alias("weight"), probability.alias("probability"))


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    keep: float = KEEP,
    temperature: float = TEMPERATURE,
    max_levels: int | None = None,
    seed: int = SEED,
    driver_cells: int = DRIVER_CELLS,
) -> DataFrame:
    """The sampled rows of ``docs`` (``row``) with their levels, ``tokens``, ``weight`` and ``probability``.

    ``targets``: token shares per level for any of the dimensions; the others are flattened.
    ``weight`` is the share of a cell in the kept tokens."""
    marked = with_cells(docs)
    levels = [f"_{d}" for d in DIMENSIONS]
    # one pass over the texts; a row per combination that occurs
    counted = keep_on_disk(marked.groupBy(*levels).agg(F.sum("tokens").alias("tokens")))
    if max_levels is not None:
        large = {d: [*_large_levels(counted, d, max_levels), *(targets or {}).get(d, {})] for d in ("source", "lang")}
        for d in large:
            counted, marked = (f.withColumn(f"_{d}", _folded(F.col(f"_{d}"), large[d])) for f in (counted, marked))
        counted = keep_on_disk(counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens")))
    if counted.count() <= driver_cells:
        rate_of = F.broadcast(rates_on_driver(counted, targets or {}, keep, temperature))
    else:
        rate_of = rates_by_steps(counted, targets or {}, keep, temperature)
    uniform = F.pmod(F.xxhash64(F.col("row")["doc_id"], F.col("row")["text"], F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return marked.join(rate_of, levels).where(uniform < F.col("probability"))


def sampled_documents(docs: DataFrame, **options) -> DataFrame:
    """Documents that stay, in the columns of ``docs``."""
    return mix(docs, **options).select("row.*")


def sample_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight and probability of every sampled document."""
    levels = [F.col(f"_{d}").alias(d) for d in DIMENSIONS]
    return mix(docs, **options).select(F.col("row")["doc_id"].alias("doc_id"), *levels, "tokens", "weight", "probability")
