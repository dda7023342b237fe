"""Mixing sources to target weights (problem 7).

Iterative proportional fitting rakes the token weights of (source, language, topic) cells to their marginals: the
target shares of the sources, and the shares that languages and topics have in the targeted sources. A cell's
weight is how often its records are taken on average; it never exceeds what the source's cap allows. The size of
the mixture is the largest at which every targeted source with records can still give its share within its cap, so
no source falls short. Then every record is taken floor(weight) times and once more with the probability that is
left. The draws of a source are systematic over its records by size, which keeps the tokens taken close to the
tokens wanted, whatever the sizes.

Cells are few (sources x languages x topics); only they are collected, records are not.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import tokens
from foliant.session import materialise

#: Most cells that are fitted on the driver; languages and topics beyond count as one (OTHER).
CELLS, OTHER = 200_000, "other"
ROUNDS, SEED = 200, 17


def fit(size: np.ndarray, source: np.ndarray, margins: list[np.ndarray], target: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """How often each cell is taken.

    ``size``: tokens of the cells; ``source``: its source's index in ``target`` (shares, of those with records they
    sum to 1) and ``cap``; ``margins``: for each further attribute the cells' values.
    """
    have = np.bincount(source, weights=size, minlength=len(target))
    total = np.min(np.where(target > 0, have * cap / np.maximum(target, 1e-300), np.inf)[have > 0]) if (have > 0).any() else 0.0
    # Rounding down keeps the tightest source within its cap.
    total *= 1 - 1e-9
    weight = np.ones(len(size))
    base = size.sum()
    wanted = [np.bincount(m, weights=size) / base for m in margins] if base else []
    limit = cap[source]
    for _ in range(ROUNDS):
        before = weight.copy()
        for m, share in zip(margins, wanted, strict=True):
            now = np.bincount(m, weights=size * weight, minlength=len(share))
            weight = weight * np.where(now > 0, share * total / np.maximum(now, 1e-300), 0)[m]
        # The source marginal comes last and holds exactly; what a cap takes from a cell, the source's others get.
        weight = _to_sources(weight, size, source, target * total, limit)
        if np.allclose(before, weight, rtol=1e-7):
            break
    return weight


def _to_sources(weight: np.ndarray, size: np.ndarray, source: np.ndarray, wanted: np.ndarray, limit: np.ndarray) -> np.ndarray:
    weight = np.minimum(weight, limit)
    for _ in range(60):
        free = weight < limit * (1 - 1e-12)
        fixed = np.bincount(source, weights=np.where(free, 0, size * weight), minlength=len(wanted))
        loose = np.bincount(source, weights=np.where(free, size * weight, 0), minlength=len(wanted))
        factor = np.where(loose > 0, (wanted - fixed) / np.maximum(loose, 1e-300), 1.0)
        scaled = np.where(free, weight * np.maximum(factor, 0)[source], weight)
        if (scaled <= limit * (1 + 1e-12)).all():
            weight = np.minimum(scaled, limit)
            now = np.bincount(source, weights=size * weight, minlength=len(wanted))
            if np.allclose(now, wanted, rtol=1e-9) or not (now > wanted * (1 + 1e-9)).any():
                return weight
            # Cells at their cap hold more than is wanted: they come down with the rest.
            over = now > wanted * (1 + 1e-9)
            weight = np.where(over[source], weight * (wanted / np.maximum(now, 1e-300))[source], weight)
            return weight
        weight = np.minimum(scaled, limit)
    return weight


def _sized(df: DataFrame, targets: DataFrame, key: str, text: str, source: str, language: str, topic: str, folder: str) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """``id, source, lang, topic, n_tokens`` of the records that may be taken, and the targets (source, share, cap)."""
    rows = df.select(F.col(key).alias("id"), F.col(source).alias("source"), F.coalesce(F.col(language), F.lit("")).alias("lang"), F.coalesce(F.col(topic), F.lit("")).alias("topic"), F.col(text).alias("text"))
    goals = [(r.source, float(r.target_share), int(r.max_repeat)) for r in targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeat").alias("max_repeat")).where("source IS NOT NULL AND target_share > 0 AND max_repeat > 0").collect()]
    rows = rows.where(F.col("source").isin([g[0] for g in goals]))
    sized = materialise(tokens.token_counts(rows, "text", "n_tokens", folder).where("n_tokens > 0"), "sized")
    for name in ("topic", "lang"):
        sized = _bounded(sized, name, len(goals))
    return sized, goals


def _mixed(sized: DataFrame, goals: list[tuple[str, float, int]]) -> DataFrame:
    cells = sized.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("records")).orderBy(F.desc("n"), "source", "lang", "topic").collect()
    schema = "source string, lang string, topic string, weight double, cap int, parts int"
    return _drawn(sized, sized.sparkSession.createDataFrame(_plan(cells, goals), schema))


def mixture(
    df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", language: str = "lang", topic: str = "document_type", folder: str = tokens.TOKENIZERS
) -> DataFrame:
    """``key, source, lang, topic, n_tokens, times``: the records taken, and how often (1 to the source's max_repeat).

    Sources without a target, null sources and texts without tokens are never taken; a target without records is
    left out and the others' shares are scaled up. Null languages and topics are values of their own ("").
    """
    return _mixed(*_sized(df, targets, key, text, source, language, topic, folder)).withColumnRenamed("id", key)


def margins(
    df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", language: str = "lang", topic: str = "document_type", folder: str = tokens.TOKENIZERS
) -> DataFrame:
    """``attribute, value, wanted_share, share, n_tokens``: of each source, language and topic the share it is to have and has.

    Sources are to have their targets, scaled to those with records; languages and topics the share they have in all
    records that may be taken. A cap or a large record can keep a share from being reached.
    """
    sized, goals = _sized(df, targets, key, text, source, language, topic, folder)
    taken = materialise(_mixed(sized, goals), "taken")
    wanted = {g[0]: g[1] for g in goals}
    goal = F.coalesce(*(F.when(F.col("value") == s, F.lit(x)) for s, x in wanted.items())) if wanted else F.lit(None).cast("double")
    out = None
    for name, attribute in (("source", "source"), ("lang", "language"), ("topic", "topic")):
        have = sized.groupBy(F.col(name).alias("value")).agg(F.sum("n_tokens").alias("all"))
        have = have.withColumn("goal", goal if name == "source" else F.col("all").cast("double"))
        got = taken.groupBy(F.col(name).alias("value")).agg(F.sum(F.col("n_tokens") * F.col("times")).alias("n_tokens"))
        # A row per value, bounded as the cells are.
        each = have.join(got, "value", "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
        share = lambda c: F.expr(f"{c} / nullif(sum({c}) OVER (), 0)")
        each = each.select(F.lit(attribute).alias("attribute"), "value", share("goal").alias("wanted_share"), F.coalesce(share("n_tokens"), F.lit(0.0)).alias("share"), "n_tokens")
        out = each if out is None else out.unionByName(each)
    return out


def _bounded(sized: DataFrame, name: str, sources: int) -> DataFrame:
    """``sized`` with the values of ``name`` beyond the largest as OTHER, so that there are CELLS cells at most.

    Languages and topics get an equal part each of what the sources leave. Few values are left as they are.
    """
    most = max(1, math.isqrt(max(1, CELLS // max(1, sources))) - 1)
    # One more than may stay shows whether there are further ones.
    kept = [r[name] for r in sized.groupBy(name).agg(F.sum("n_tokens").alias("n")).orderBy(F.desc("n"), name).limit(most + 1).collect()]
    if len(kept) <= most:
        return sized
    values = F.broadcast(sized.sparkSession.createDataFrame([(v, v) for v in kept[:most]], f"{name} string, kept string"))
    return sized.join(values, name, "left").withColumn(name, F.coalesce("kept", F.lit(OTHER))).drop("kept")


def _plan(cells: list, goals: list[tuple[str, float, int]]) -> list[tuple]:
    if not cells:
        return []
    present = sorted({c["source"] for c in cells})
    by = {g[0]: g for g in goals}
    total = sum(by[s][1] for s in present)
    at = {s: i for i, s in enumerate(present)}

    def index(values: list[str]) -> np.ndarray:
        names = {v: i for i, v in enumerate(dict.fromkeys(values))}
        return np.array([names[v] for v in values])

    weight = fit(
        np.array([c["n"] for c in cells], dtype=float),
        np.array([at[c["source"]] for c in cells]),
        [index([c["lang"] for c in cells]), index([c["topic"] for c in cells])],
        np.array([by[s][1] / total for s in present]),
        np.array([by[s][2] for s in present], dtype=float),
    )
    return [(c["source"], c["lang"], c["topic"], float(w), by[c["source"]][2], math.ceil(c["records"] / PART)) for c, w in zip(cells, weight, strict=True)]


#: A stratum of equal size is summed in parts, so many that all of its cell's records would give parts of this many.
PART = 50_000


def _drawn(sized: DataFrame, weights: DataFrame) -> DataFrame:
    """Systematic draws: the running sum of a source's fractional weights passes a grid of ones.

    A source's records stand by size, in strata, so that the draws take large and small ones alike. A stratum is
    summed in parts, and the sums of the parts, a small table, give each part its start. A part is a task's own
    however large its stratum is.
    """
    # The weights are a row per cell, CELLS at most.
    rows = sized.join(F.broadcast(weights), ["source", "lang", "topic"])
    rows = rows.withColumn("whole", F.floor("weight").cast("int")).withColumn("fraction", F.col("weight") - F.floor("weight")).withColumn("draw", F.xxhash64("id", F.lit(SEED)))
    part = ["source", "stratum", "lang", "topic", "part"]
    rows = rows.withColumn("stratum", F.floor(F.log2("n_tokens") * 8).cast("int")).withColumn("part", F.pmod(F.shiftright("draw", 8), F.col("parts")).cast("int"))
    sums = rows.groupBy(part).agg(F.sum("fraction").alias("f"))
    starts = sums.select(*part, (F.expr("sum(f) OVER (PARTITION BY source ORDER BY stratum, lang, topic, part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)") - F.col("f")).alias("start"))
    rows = rows.join(starts, part)
    rows = rows.withColumn("sum", F.col("start") + F.expr(f"sum(fraction) OVER (PARTITION BY {', '.join(part)} ORDER BY draw, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    more = F.floor(F.col("sum") + 0.5) > F.floor(F.col("sum") - F.col("fraction") + 0.5)
    times = F.least(F.col("whole") + more.cast("int"), F.col("cap"))
    return rows.select("id", "source", "lang", "topic", "n_tokens", times.alias("times")).where("times > 0")


def shares(taken: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each target: tokens and records taken, the share reached, the target, and the most one record is taken."""
    by = taken.groupBy("source").agg(F.count("*").alias("n_records"), F.sum(F.col("n_tokens") * F.col("times")).alias("n_tokens"), F.max("times").alias("most_times"))
    out = targets.select("source", "target_share", "max_repeat").join(by, "source", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_records", "n_tokens", "most_times")})
    whole = F.expr("sum(n_tokens) OVER ()")  # a row per target
    return out.withColumn("share", F.when(whole > 0, F.col("n_tokens") / whole).otherwise(0.0))
