"""Mixing sources to target weights: raking token weights to marginals, then sampling documents by calibrated probabilities.

Tokens are summed for each cell of source, language and topic. Iterative proportional fitting scales the cells so that their
sums meet each marginal's targets in turn, until all are met. What a cell should have over what it has, times a common factor,
is the probability of its documents, 1 at most; the factor is such that the expected tokens meet the budget although some cells
give all they have. A document is drawn by a hash of its id, so draws are repeatable. All of it is DataFrame operations: the
table of cells is counted, and as long as it is small its rounds are window functions over one partition, many to a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlewright.llm.skew import keyed_join
from titlewright.session import discard, materialize

DIMS = ("source", "lang", "topic")
_NONE = "(none)"
ALPHA, SHARE = 0.7, 0.8
#: Raking stops when no marginal is off by more than TOLERANCE of the whole, or after ROUNDS; BLOCK rounds are one job.
TOLERANCE, ROUNDS, BLOCK = 1e-12, 96, 8
#: Up to so many cells are one task's work and may be broadcast: some 10 MB.
SMALL = 100_000
_MADE = ("p", "selected", "residual")

#: The tables have no topics, so the registered query and the pipeline take bands of length in their place.
BANDS = ((0, "empty"), (64, "note"), (256, "short"), (1024, "medium"))


def length_band(tokens: Column) -> Column:
    out = F.lit("long")
    for most, name in reversed(BANDS):
        out = F.when(tokens <= most, name).otherwise(out)
    return out


def token_count(text: Column) -> Column:
    """Words between ASCII white space; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _value(dim: str) -> Column:
    return F.coalesce(F.col(f"`{dim}`").cast("string"), F.lit(_NONE))


def cells_of(docs: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """The dims, n (the tokens of each cell) and n_rows. Nulls of a dim are a value of their own, null tokens are none."""
    return docs.groupBy(*[_value(d).alias(d) for d in dims]).agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double").alias("n"), F.count("*").alias("n_rows"))


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """Targets in proportion to a power of what there is, which lifts the rare and lowers the frequent: dim, target (shares)."""
    own = cells.groupBy(dim).agg(F.sum("n").alias("n")).select(dim, F.pow("n", F.lit(alpha)).alias("power"))
    whole = own.agg(F.sum("power").alias("whole")).first()[0] or 1.0
    return own.select(dim, (F.col("power") / F.lit(whole)).alias("target"))


def _scaled(now: DataFrame, dim: str, small: bool) -> DataFrame:
    """w scaled to the targets of one dim. A small table is one partition, which a window function leaves as it is."""
    if small:
        have = F.sum("w").over(Window.partitionBy(dim))
        return now.withColumn("w", F.col("w") * F.coalesce(F.try_divide(F.col(f"target_{dim}"), have), F.lit(0.0)))
    sums = now.groupBy(dim).agg(F.sum("w").alias("have"))
    share = F.coalesce(F.try_divide(F.col(f"target_{dim}"), F.col("have")), F.lit(0.0))
    return materialize(now.join(sums, dim).withColumn("w", F.col("w") * share).drop("have"), "raked")


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """cells with w, shares that sum to the targets of each dim, and the residual: by how much the worst marginal is off.

    It ends at a residual within tolerance, or after `rounds` rounds: targets that contradict each other, or that cells without
    tokens would have to meet, show in the residual. Values without a target get nothing. An empty table stays empty, residual 0.
    """
    small = cells.limit(SMALL + 1).count() <= SMALL
    goals = cells.withColumn("w", F.col("n"))
    for dim, target in targets.items():
        goals = goals.join(target.select(dim, F.col("target").alias(f"target_{dim}")), dim, "left")
    now = materialize(goals.coalesce(1) if small else goals, "raked")
    off = lambda have, dim: F.abs(have - F.coalesce(f"target_{dim}", F.lit(0.0)))
    absent = [t.join(cells.select(d).distinct(), d, "left_anti").agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0] for d, t in targets.items()]
    done, residual = 0, None
    while residual is None or residual > tolerance and done < rounds:
        before, at = now, now.coalesce(1) if small else now
        for _ in range(min(BLOCK if small else 1, max(1, rounds - done))):
            for dim in targets:
                last, at = at, _scaled(at, dim, small)
                if last is not before and not small:
                    discard(last)
            done += 1
        if small:
            gaps = at.select("*", F.greatest(F.lit(0.0), F.lit(0.0), *[off(F.sum("w").over(Window.partitionBy(d)), d) for d in targets]).alias("gap"))
            at = materialize(gaps, "raked")
            residual = at.agg(F.max("gap")).first()[0]
            now = at.drop("gap")
        else:
            now = at
            residual = max(at.groupBy(d).agg(F.sum("w").alias("have"), F.first(f"target_{d}").alias(f"target_{d}")).agg(F.max(off(F.col("have"), d))).first()[0] or 0.0 for d in targets)
        discard(before)
        residual = max([residual or 0.0, *absent])
    return now.drop(*[f"target_{d}" for d in targets]), residual


def calibrate(raked: DataFrame, share: float = SHARE) -> DataFrame:
    """The cells with p, the probability of their documents: min(1, factor * w / n), with the factor at which the expected
    tokens are `share` of all. A cell without tokens has p = 1; where all that has a weight gives all it has, so does it."""
    ratio = F.try_divide(F.col("w"), F.col("n"))
    total = raked.agg(F.sum("n")).first()[0] or 0.0
    budget = F.lit(share * total)
    # Cells in the order in which a growing factor fills them: with those before one full, is the factor below its own?
    order = Window.orderBy(F.desc("ratio"), "n", "w")
    filled = order.rowsBetween(Window.unboundedPreceding, -1)
    live = raked.where("n > 0 and w > 0").select("n", "w", ratio.alias("ratio"))
    if raked.limit(SMALL + 1).count() <= SMALL:
        steps = live.coalesce(1).select("ratio", (budget - F.coalesce(F.sum("n").over(filled), F.lit(0.0))).alias("left"), F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"))
        factor = steps.select((F.col("left") / F.col("open")).alias("f"), "ratio").where("f * ratio < 1").agg(F.max("f")).first()[0]
    else:  # the same, a job for each set of cells that fills up
        factor, last = share * total, None
        while factor is not None and factor != last:
            whole = F.lit(factor) * F.col("ratio") >= 1
            given, open_ = live.agg(F.sum(F.when(whole, F.col("n")).otherwise(0.0)), F.sum(F.when(whole, 0.0).otherwise(F.col("w")))).first()
            last, factor = factor, (share * total - given) / open_ if open_ else None
    full = F.when(ratio > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    drawn = F.least(F.lit(1.0), F.lit(max(0.0, factor)) * ratio) if factor is not None else full
    # Sums of doubles differ in their last bits with the order of rows; rounding keeps the draws repeatable.
    return raked.withColumn("p", F.round(F.coalesce(F.when(F.col("n") > 0, drawn), F.lit(1.0)), 9))


def _draw(salt: str) -> Column:
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(F.col("draw_id").cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = SHARE, salt: str = "mix:", dims: tuple[str, ...] = DIMS) -> DataFrame:
    """docs with the columns p, selected and residual (how far the worst marginal is from its targets, the same in all rows).
    docs has doc_id, tokens and the dims; other columns pass through, but for those of these three names, which are replaced.

    targets: for each dim a table (dim, target) of shares; tempered shares of what there is, where none are given. Nulls of a
    dim are the value (none). A null id is drawn like an empty one; rows that share an id are drawn together if they are of
    one cell. Documents without tokens follow their cell. Texts aren't read, however long. An empty table gives no rows.
    """
    cells = materialize(cells_of(docs, dims), "cells")
    goals = {d: (targets or {}).get(d) for d in dims}
    goals = {d: t if t is not None else materialize(tempered(cells, d), "targets") for d, t in goals.items()}
    raked, residual = rake(cells, goals)
    keys = [f"cell_{i}" for i in range(len(dims))]
    ps = materialize(calibrate(raked, share).select(*[F.col(d).alias(k) for d, k in zip(dims, keys, strict=True)], "p", "n_rows"), "probabilities")
    rest = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns if c not in _MADE]).alias("own_row")
    own = docs.select(rest, F.col("doc_id").alias("draw_id"), *[_value(d).alias(k) for d, k in zip(dims, keys, strict=True)])
    if ps.limit(SMALL + 1).count() <= SMALL:
        out = own.join(F.broadcast(ps), keys)
    else:
        out = keyed_join(own, ps, keys, n="n_rows")
    return out.select("own_row.*", "p", (_draw(salt) < F.col("p")).alias("selected"), F.lit(residual).alias("residual"))


def _sql(rounds: int = 36) -> str:
    """The registered query in SQL, with more rounds than it takes until nothing changes, all written out."""
    words = "coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)"
    band = "CASE " + " ".join(f"WHEN tokens <= {most} THEN '{name}'" for most, name in BANDS) + " ELSE 'long' END"
    steps = [
        f"docs AS (SELECT doc_id, source, lang, {band} AS topic, tokens FROM (SELECT doc_id, coalesce(source, '{_NONE}') AS source, coalesce(lang, '{_NONE}') AS lang, {words} AS tokens FROM documents))",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS n FROM docs GROUP BY ALL)",
    ]
    for d in DIMS:
        steps.append(f"target_{d} AS MATERIALIZED (SELECT {d}, power / sum(power) OVER () AS target FROM (SELECT {d}, pow(sum(n), {ALPHA}) AS power FROM cells GROUP BY ALL))")
    last = "(SELECT *, n AS w FROM cells)"
    for r in range(rounds):
        for d in DIMS:
            steps.append(f"w_{r}_{d} AS MATERIALIZED (SELECT source, lang, topic, n, w * coalesce(target / nullif(sum(w) OVER (PARTITION BY {d}), 0), 0) AS w FROM {last} JOIN target_{d} USING ({d}))")
            last = f"w_{r}_{d}"
    steps.append(f"fill AS MATERIALIZED (SELECT w / n AS ratio, ({SHARE} * (SELECT sum(n) FROM cells) - coalesce(sum(n) OVER (ORDER BY w / n DESC, n, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY w / n DESC, n, w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM {last} WHERE n > 0 AND w > 0)")
    steps.append("best AS MATERIALIZED (SELECT greatest(0, max(f)) AS f FROM fill WHERE f * ratio < 1)")
    steps.append(f"ps AS MATERIALIZED (SELECT source, lang, topic, round(CASE WHEN n > 0 THEN CASE WHEN f IS NULL THEN (w > 0)::INT ELSE least(1.0, f * (w / n)) END ELSE 1.0 END, 9) AS p FROM {last}, best)")
    draw = "('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, source, lang, topic, tokens::BIGINT AS tokens, round(p, 6) AS p, {draw} < p AS selected, true AS met FROM docs JOIN ps USING (source, lang, topic)"


SQL = _sql()
