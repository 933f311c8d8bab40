"""Mixing to target weights: iterative proportional fitting and calibrated sampling.

Documents are summed into cells (source, language, topic), the only table the
fitting works on. A table of up to ``SMALL_CELLS`` cells is counted first and then
raked as arrays; a larger one, to the same result, by joins. Each round rakes the cells' token weights to one marginal
after the other: a dimension's current sums are compared with its targets and
every cell is scaled. Rounds end when no
marginal moves by more than ``tolerance``, or after ``max_rounds`` (targets that
contradict the empty cells cannot all be met).

A document's inclusion probability is its cell's raking factor times one scale,
cut at 1; the scale is solved so that the expected tokens are ``share`` of the
corpus. Sampling compares the probability with a hash of id and seed, so a
document's fate depends on nothing else and a rerun draws the same sample. What
the cut at 1 leaves over is the document's ``weight``.

Targets are shares per value. Values without a target share what is left in
proportion to their tokens; targets are scaled to sum to 1 over the values that
occur. Where the given targets leave nothing, values without a target (null and
unknown ones) together keep their share of all tokens, and the given targets are
scaled to the remainder: no document vanishes for want of a target.

Defined cases: null source, language or topic is a value of its own; a null or
blank text has no tokens and probability 1 times its cell's factor as any other
document of the cell; a cell without tokens has factor 1; rows repeated in full
share their fate, as do rows without an id that have the same text; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import SYMBOLS_OF_TOPIC, fresh, words
from broadsheet.session import materialise

GRID = 64  # scales tried in one pass over the cells
PASSES = 6
SMALL_CELLS = 50_000  # cells that may be raked as arrays; larger tables are raked by joins


@dataclass(frozen=True)
class Mix:
    """Target shares per dimension, and how much to draw."""

    targets: dict[str, dict[str, float]] = field(default_factory=dict)
    # dimensions without given shares: 1 keeps the shares as they are, 0 makes all values equal
    temperatures: dict[str, float] = field(default_factory=dict)
    share: float = 0.5
    seed: str = "mix"
    tolerance: float = 1e-7
    max_rounds: int = 100


def topic_of(text: Column) -> Column:
    """A rough topic from the form of a text: markup, figures, lists or prose."""
    size = F.length(text)
    symbols = size - F.length(F.translate(text, SYMBOLS_OF_TOPIC, ""))
    digits = size - F.length(F.translate(text, "0123456789", ""))
    lines = size - F.length(F.translate(text, "\n", ""))
    return (
        F.when(100 * symbols > size, "markup").when(100 * digits > size, "figures")
        .when(200 * lines > size, "lists").otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _targets(cells: DataFrame, dim: str, mix: Mix) -> DataFrame:
    """``value, target`` for the values of a dimension that occur, summing to 1."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("t"))
    sums = sums.filter("t > 0")
    given = mix.targets.get(dim, {})
    power = mix.temperatures.get(dim, 1.0)
    want = F.lit(None).cast("double")
    for value, share in given.items():
        want = F.when(F.col("value") == value, F.lit(float(share))).otherwise(want)
    rows = sums.select(
        "value", F.col("t").alias("tokens"), F.pow(F.col("t").cast("double"), F.lit(power)).alias("t"), want.alias("want")
    )
    both = rows.agg(
        F.sum("want").alias("fixed"), F.sum(F.when(F.col("want").isNull(), F.col("t"))).alias("open"),
        F.sum(F.when(F.col("want").isNull(), F.col("tokens"))).alias("open_tokens"), F.sum("tokens").alias("tokens"),
    ).first()
    fixed, open_ = both["fixed"] or 0.0, both["open"] or 0.0
    rest = max(0.0, 1.0 - fixed)
    if not open_:  # nothing to share out: the given targets fill the whole
        rest = 0.0
    elif rest < 1e-9:  # the targets leave nothing: the others keep their share of the tokens
        part = both["open_tokens"] / both["tokens"]
        rest = fixed * part / (1.0 - part)
    total = fixed + rest
    share = F.when(F.col("want").isNull(), F.col("t") * (rest / open_ if open_ else 0.0)).otherwise(F.col("want"))
    return rows.select("value", (share / total if total else share).alias("target"))


def rake(cells: DataFrame, dims: list[str], mix: Mix) -> DataFrame:
    """Cells ``dims.., tokens`` with ``fitted``: tokens whose marginals meet the targets."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    targets = {d: materialise(_targets(cells, d, mix), "mix-targets") for d in dims}
    fitted = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for _ in range(mix.max_rounds):
        moved = fitted.withColumn("_before", F.col("fitted"))
        for d in dims:
            sums = moved.groupBy(F.col(d).alias("_value")).agg(F.sum("fitted").alias("_sum"))
            scale = sums.join(targets[d], F.col("_value").eqNullSafe(F.col("value"))).select(
                "_value", F.when(F.col("_sum") > 0, F.col("target") * total / F.col("_sum")).otherwise(1.0).alias("_scale")
            )
            moved = moved.join(scale, F.col(d).eqNullSafe(F.col("_value")), "left").select(
                *cells.columns, (F.col("fitted") * F.coalesce("_scale", F.lit(1.0))).alias("fitted"), "_before"
            )
        moved = materialise(moved, "mix-round")
        change = moved.agg(F.max(F.abs(F.col("fitted") - F.col("_before")))).first()[0] or 0.0
        fitted = moved.drop("_before")
        if change <= mix.tolerance * max(total, 1.0):
            break
    return fitted


def _scale(cells: DataFrame, share: float) -> float:
    """The scale at which ``sum(tokens * min(1, scale * factor))`` is ``share`` of all tokens."""
    row = cells.agg(
        F.sum("tokens"), F.min(F.when(F.col("factor") > 0, F.col("factor"))), F.max("factor"),
        F.sum(F.when(F.col("factor") > 0, F.col("tokens"))),
    ).first()
    total, least, most, reachable = row
    if not total or not most:
        return 0.0
    goal = min(share * total, reachable)
    low, high = 0.0, 1.0 / least
    for _ in range(PASSES):  # a grid of scales per pass over the cells
        grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        sums = cells.agg(
            *[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor") * g)).alias(f"s{k}") for k, g in enumerate(grid)]
        ).first()
        k = next((k for k in range(GRID + 1) if sums[k] >= goal), GRID)
        if k == 0:
            return grid[0]
        low, high = grid[k - 1], grid[k]
    return high


def _shares(sums: np.ndarray, values: list, dim: str, mix: Mix) -> np.ndarray:
    """Targets of the values of a dimension, as ``_targets``; 0 for values without tokens."""
    given = mix.targets.get(dim, {})
    want = np.array([float(given[v]) if v in given else np.nan for v in values])
    free, occurs = np.isnan(want), sums > 0
    fixed = float(want[occurs & ~free].sum())
    weight = np.where(occurs & free, np.where(occurs, sums, 1.0) ** mix.temperatures.get(dim, 1.0), 0.0)
    rest, open_ = max(0.0, 1.0 - fixed), float(weight.sum())
    if not open_:
        rest = 0.0
    elif rest < 1e-9:
        part = float(sums[free].sum() / sums.sum())
        rest = fixed * part / (1.0 - part)
    share = np.where(free, weight * (rest / open_ if open_ else 0.0), np.where(free, 0.0, want))
    share = np.where(occurs, share, 0.0)
    return share / (fixed + rest) if fixed + rest else share


def _calibrate_small(cells: DataFrame, dims: list[str], mix: Mix) -> DataFrame:
    """As ``calibrate``, for a table of cells with a proven size bound: raked as arrays, without a job per round."""
    schema = T.StructType(
        [f for f in cells.schema if f.name in dims] + [T.StructField(c, T.DoubleType()) for c in ("probability", "weight")]
    )
    rows = cells.select(*dims, "tokens").collect()
    if not rows:
        return cells.sparkSession.createDataFrame([], schema)
    tokens = np.array([r["tokens"] or 0 for r in rows], float)
    total, fitted, fits = float(tokens.sum()), tokens.copy(), []
    for d in dims:
        values = list(dict.fromkeys(r[d] for r in rows))
        place = {v: k for k, v in enumerate(values)}
        code = np.array([place[r[d]] for r in rows])
        fits.append((code, len(values), _shares(np.bincount(code, tokens, len(values)), values, d, mix)))
    for _ in range(mix.max_rounds):
        before = fitted
        for code, n, share in fits:
            now = np.bincount(code, fitted, n)
            fitted = fitted * np.where(now > 0, share * total / np.where(now > 0, now, 1.0), 1.0)[code]
        if np.abs(fitted - before).max() <= mix.tolerance * max(total, 1.0):
            break
    factor = np.where(tokens > 0, fitted / np.where(tokens > 0, tokens, 1.0), 1.0)
    scale = 0.0
    if total and factor.max() > 0:
        goal = min(mix.share * total, float(tokens[factor > 0].sum()))
        low, scale = 0.0, float(1.0 / factor[factor > 0].min())
        for _ in range(100):
            middle = (low + scale) / 2
            enough = float((tokens * np.minimum(1.0, factor * middle)).sum()) >= goal
            low, scale = (low, middle) if enough else (middle, scale)
    inclusion = np.minimum(1.0, factor * scale)
    weight = np.where(inclusion > 0, factor * scale / np.where(inclusion > 0, inclusion, 1.0), 0.0)
    found = [(*(r[d] for d in dims), float(p), float(w)) for r, p, w in zip(rows, inclusion, weight, strict=True)]
    return cells.sparkSession.createDataFrame(found, schema)


def calibrate(df: DataFrame, dims: list[str], tokens: str, mix: Mix) -> DataFrame:
    """Cells with ``probability`` and ``weight`` of their documents."""
    cells = materialise(df.groupBy(*dims).agg(F.sum(tokens).alias("tokens")), "mix-cells")
    if cells.count() <= SMALL_CELLS:
        return _calibrate_small(cells, dims, mix)
    fitted = rake(cells, dims, mix)
    factor = F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(1.0)
    cells = fitted.withColumn("factor", factor)
    scale = _scale(cells, mix.share)
    inclusion = F.least(F.lit(1.0), F.col("factor") * scale)
    weight = F.when(inclusion > 0, F.col("factor") * scale / inclusion).otherwise(0.0)
    return cells.select(*dims, inclusion.alias("probability"), weight.alias("weight"))


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by id and seed, or by text and seed where there is no id."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    mark = F.md5(F.concat(F.lit(seed), F.lit("/"), name))
    return F.conv(F.substring(mark, 1, 13), 16, 10).cast("double") / float(16**13)


def mix_documents(docs: DataFrame, mix: Mix, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, weight, sampled`` per row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), "source", "lang", topic_of(F.coalesce(F.col(text), F.lit(""))).alias("topic"),
        tokens_of(F.col(text)).alias("n_tokens"), draw(F.col(doc_id), F.col(text), mix.seed).alias("drawn"),
    )
    rows = materialise(rows, "mix-documents")
    dims = ["source", "lang", "topic"]
    cells = materialise(calibrate(rows, dims, "n_tokens", mix), "mix-calibrated")
    cells = cells.select(*[F.col(d).alias(f"_{d}") for d in dims], "probability", "weight")
    same = F.lit(True)
    for d in dims:
        same = same & F.col(d).eqNullSafe(F.col(f"_{d}"))
    out = rows.join(cells, same)
    return out.select(
        "doc_id", *dims, "n_tokens", "probability", "weight",
        (F.col("drawn") < F.col("probability")).alias("sampled"),
    )


def sample(docs: DataFrame, mix: Mix) -> DataFrame:
    """The sampled documents, columns as given."""
    probability = fresh(docs, "_p")
    topic = fresh(docs, "_topic")
    rows = docs.withColumn(topic, topic_of(F.coalesce("text", F.lit(""))))
    narrow = materialise(
        rows.select("source", "lang", F.col(topic).alias("topic"), tokens_of(F.col("text")).alias("n_tokens")), "mix-documents"
    )
    dims = ["source", "lang", "topic"]
    cells = materialise(calibrate(narrow, dims, "n_tokens", mix), "mix-calibrated")
    cells = cells.select(*[F.col(d).alias(f"_cell_{d}") for d in dims], F.col("probability").alias(probability))
    same = (
        rows["source"].eqNullSafe(F.col("_cell_source")) & rows["lang"].eqNullSafe(F.col("_cell_lang"))
        & rows[topic].eqNullSafe(F.col("_cell_topic"))
    )
    kept = rows.join(cells, same).filter(draw(F.col("doc_id"), F.col("text"), mix.seed) < F.col(probability))
    return kept.select(*docs.columns)
