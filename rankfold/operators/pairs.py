"""Winner/loser pairs inside each session.

Only pairs with different targets are ever produced: the feature table is
unnested to ``(rid, name, pos, target, weight)`` and self-joined on
``(rid, name)`` with ``winner.target > loser.target``.  Equal-target pairs are
never emitted, and the two sides are co-partitioned on ``(rid, name)`` by one
shuffle each; AQE splits skewed sessions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.config import MIN_PAIR_WEIGHT, Cols
from rankfold.operators.indexing import with_global_index
from rankfold.operators.metrics import SESSION_ROWS, part_of, session_cuts
from rankfold.session import dealt, written


def unnest_targets(features: DataFrame, session_col: str = Cols.RID, carry: tuple = ()) -> DataFrame:
    """One row per (session, target name, position)."""
    return features.select(F.col(session_col).alias("rid"), F.col(Cols.POS).alias("pos"), *carry,
                           F.inline("targets")).where(F.col("rid").isNotNull())


def _kept(features: DataFrame, session_col: str, carry: tuple = ()) -> DataFrame:
    """Session, position and targets, written once: the feature table is made a single time, however often its targets are read."""
    return written(features.select(session_col, Cols.POS, "targets", *carry))


def _winner_loser(features: DataFrame, session_col: str, carry: tuple = ()) -> DataFrame:
    """Self-join of the unnested table on (rid, name) keeping winner.target >
    loser.target.  Both sides are the same plan, so its shuffle is reused."""
    long = unnest_targets(features, session_col, carry)
    a, b = long.alias("a"), long.alias("b")
    j = a.join(b, (F.col("a.rid") == F.col("b.rid")) & (F.col("a.name") == F.col("b.name"))
               & (F.col("a.target") > F.col("b.target")))
    return j.select(F.col("a.rid").alias("rid"), F.col("a.name").alias("target"),
                    F.col("a.pos").alias("winner_pos"), F.col("b.pos").alias("loser_pos"),
                    F.col("a.weight").alias("weight"), F.col("a.target").alias("t_w"),
                    F.col("b.target").alias("t_l"),
                    *[F.col(f"a.{c}").alias(f"{c}_w") for c in carry],
                    *[F.col(f"b.{c}").alias(f"{c}_l") for c in carry])


def pair_table(features: DataFrame, session_col: str = Cols.RID, normalize: bool = False,
               min_abs_weight: float = MIN_PAIR_WEIGHT, carry: tuple = ()) -> DataFrame:
    """P3 + P6 (+ P5 when ``normalize``): ``rid, target, winner_pos, loser_pos,
    pair_weight`` for every pair with different targets and |weight| >= 1e-8.
    ``pair_weight = weight * |t_winner - t_loser|``.  Columns named in
    ``carry`` come along as ``<c>_w`` / ``<c>_l``."""
    if normalize:  # read for the pairs and for the totals
        features = _kept(features, session_col, tuple(carry))
    j = _winner_loser(features, session_col, tuple(carry))
    gap = F.col("t_w") - F.col("t_l")
    out = j.select("rid", "target", "winner_pos", "loser_pos", (F.col("weight") * gap).alias("pair_weight"),
                   gap.alias("gap"), *[c for c in j.columns if c.endswith(("_w", "_l")) and c not in ("t_w", "t_l")])
    if normalize:
        total = _totals(features, session_col).select("rid", "target", "total_raw_weight")
        out = out.join(total, ["rid", "target"]).withColumn("pair_weight", F.col("pair_weight") / F.col("total_raw_weight")).drop("total_raw_weight")
    return out.where(F.abs(F.col("pair_weight")) >= F.lit(float(min_abs_weight))).drop("gap")


def _cuts(features: DataFrame, session_col: str, long: DataFrame, value: str, session_rows: int) -> DataFrame | None:
    """``rid, name, _cuts``: quantiles of ``value`` that cut the sessions above ``session_rows`` rows; None without such a session.

    Written to the shared folder; it has at most one cut for ``session_rows`` rows of the input.
    """
    large = features.groupBy(F.col(session_col).alias("rid")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > session_rows).select("rid")
    if large.isEmpty():
        return None
    rows = long.join(large, "rid", "left_semi")
    found = session_cuts(rows.select(F.struct("rid", "name").alias("session_id"), F.col(value).alias("score")), session_rows)
    return written(found.select("session_id.rid", "session_id.name", "_cuts"))


def _with_part(rows: DataFrame, cuts: DataFrame | None, value: str) -> DataFrame:
    """``rows`` with ``part``, the number of cuts of the session below ``value`` (0 in sessions that have none)."""
    if cuts is None:
        return rows.withColumn("part", F.lit(0))
    return rows.join(F.broadcast(cuts), ["rid", "name"], "left").withColumn("part", F.when(F.col("_cuts").isNull(), 0).otherwise(part_of(value))).drop("_cuts")


def pair_totals(features: DataFrame, session_col: str = Cols.RID, session_rows: int = SESSION_ROWS) -> DataFrame:
    """Per (session, target) the number of unordered pairs with different
    targets and the total raw weight sum |t1 - t2| (equal pairs add 0), from
    running sums over the distinct targets: no pair is formed.

    Rows are dealt once, by session, target name and part of the session's range of targets; the ordered work runs within a
    part, and the sums of the parts (one row each) give the rest.  With b rows of sum s below a part and n rows of sum t in
    it, the pairs across are n*b and weigh t*b - n*s."""
    return _totals(_kept(features, session_col), session_col, session_rows)


def _totals(features: DataFrame, session_col: str, session_rows: int = SESSION_ROWS) -> DataFrame:
    """:func:`pair_totals` of a kept table."""
    long = unnest_targets(features, session_col).where(F.col("target").isNotNull()).select("rid", "name", F.col("target").cast("double").alias("v"))
    points = features.agg(F.sum(F.size("targets"))).first()[0] or 0
    parted = dealt(_with_part(long, _cuts(features, session_col, long, "v", session_rows), "v"), points, "rid", "name", "part")
    per = parted.groupBy("rid", "name", "part", "v").agg(F.count(F.lit(1)).alias("c"))
    below = Window.partitionBy("rid", "name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("*", F.coalesce(F.sum("c").over(below), F.lit(0)).alias("b"), F.coalesce(F.sum(F.col("c") * F.col("v")).over(below), F.lit(0.0)).alias("s"))
    parts = per.groupBy("rid", "name", "part").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.col("v")).alias("t"), F.sum(F.col("c") * F.col("b")).alias("pairs"),
        F.sum(F.col("c") * (F.col("v") * F.col("b") - F.col("s"))).alias("weight"))
    lower = Window.partitionBy("rid", "name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("*", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("b"), F.coalesce(F.sum("t").over(lower), F.lit(0.0)).alias("s"))
    return parts.groupBy("rid", F.col("name").alias("target")).agg(
        F.sum(F.col("pairs") + F.col("n") * F.col("b")).alias("n_pairs"),
        F.sum(F.col("weight") + F.col("t") * F.col("b") - F.col("n") * F.col("s")).alias("total_raw_weight")).where("n_pairs > 0")


# ---------------------------------------------------------------- export / import
def row_index(features: DataFrame, session_col: str = Cols.RID) -> DataFrame:
    """X10 global form: ``row_index`` over (session, pos) order -> (rid, pos, targets, row_index)."""
    rows = features.select(F.col(session_col).alias("rid"), F.col(Cols.POS).alias("pos"), "targets")
    return with_global_index(rows, ["rid", "pos"], "row_index")


def export_pairs(pairs: DataFrame) -> DataFrame:
    """``key`` = winner row index, ``value`` = "loser\\tweight", ``target``.
    ``pairs`` is ``pair_table(row_index(features), carry=("row_index",))``: the
    index comes along with the pairs and is not joined to them."""
    return pairs.select(F.col("row_index_w").cast("string").alias("key"),
                        F.concat_ws("\t", F.col("row_index_l").cast("string"), F.col("pair_weight").cast("string")).alias("value"),
                        "target")


def import_pairs(exported: DataFrame, n_rows: int) -> DataFrame:
    """Parse ``key``/``value``; need two fields, integer indices in
    [0, n_rows) and a numeric weight, else the row is skipped."""
    parts = F.split(F.col("value"), "\t")
    parsed = exported.select(
        F.col("key").try_cast("long").alias("winner"),
        F.get(parts, 0).try_cast("long").alias("loser"),
        F.get(parts, 1).try_cast("double").alias("pair_weight"),
        F.size(parts).alias("_n"), "target")
    ok = (F.col("_n") >= 2) & F.col("winner").isNotNull() & F.col("loser").isNotNull() \
        & F.col("pair_weight").isNotNull() & F.col("winner").between(0, n_rows - 1) \
        & F.col("loser").between(0, n_rows - 1)
    return parsed.where(ok).drop("_n")


# ---------------------------------------------------------------- P9 / P10
def win_labels(features: DataFrame, session_col: str = Cols.RID, min_abs_weight: float = MIN_PAIR_WEIGHT,
               session_rows: int = SESSION_ROWS) -> DataFrame:
    """Wins per row (over all targets) divided by the maximum wins.

    A row wins against each row of its session whose target is lower by so much that the pair's weight is
    at least ``min_abs_weight``: with v = weight times target, the rows up to ``v - min_abs_weight``.  That border is a point of its own
    beside the row's v; points are dealt by session, target name and part of the session's range, counted in order within a part, and the
    rows of the parts below are added.  No pair is formed.  Targets are finite or NULL (no win, no loss) and a target name has one
    weight, as in the feature table.
    """
    if min_abs_weight <= 0:
        raise ValueError("min_abs_weight must be positive")
    features = _kept(features, session_col)
    n_points = features.agg(F.sum(F.size("targets"))).first()[0] or 0
    long = unnest_targets(features, session_col).where(F.col("target").isNotNull())
    scaled = long.select("rid", "pos", "name", (F.abs("weight") * F.col("target")).cast("double").alias("v"))
    cuts = _cuts(features, session_col, scaled, "v", session_rows)
    if cuts is None:  # every session is ordered by one task: Spark's own range frame finds the border
        lower = f"count(1) OVER (PARTITION BY rid, name ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND {float(min_abs_weight)!r}D PRECEDING)"
        return _win_table(features, session_col, dealt(scaled, n_points, "rid", "name").withColumn("c", F.expr(lower)), n_points)
    points = scaled.select("rid", "name", F.inline(F.array(
        F.struct("v", F.lit(0).alias("border"), "pos"), F.struct((F.col("v") - F.lit(float(min_abs_weight))).alias("v"), F.lit(1).alias("border"), "pos"))))
    upto = Window.partitionBy("rid", "name", "part").orderBy("v", "border").rowsBetween(Window.unboundedPreceding, 0)
    counted = dealt(_with_part(points, cuts, "v"), 2 * n_points, "rid", "name", "part").withColumn("c", F.sum(1 - F.col("border")).over(upto)).where("border = 1")
    # rows below each part, of the sessions that have parts
    sums = _with_part(scaled.join(F.broadcast(cuts.select("rid", "name")), ["rid", "name"]), cuts, "v").groupBy("rid", "name", "part").agg(F.count(F.lit(1)).alias("n"))
    lower = cuts.select("rid", "name", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("part")).join(sums, ["rid", "name", "part"], "left")
    before = Window.partitionBy("rid", "name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lower = lower.select("rid", "name", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b"))
    return _win_table(features, session_col, counted.join(lower, ["rid", "name", "part"], "left").withColumn("c", F.col("c") + F.coalesce("b", F.lit(0))), n_points)


def _win_table(features: DataFrame, session_col: str, counted: DataFrame, points: int) -> DataFrame:
    """Wins ``c`` by row and target, added up and divided by the greatest sum."""
    # the rows of a task stay as many when there are more
    wins = dealt(counted.select("rid", "pos", "c"), points, "rid", "pos").groupBy("rid", "pos").agg(F.sum("c").alias("wins"))
    rows = dealt(features.select(F.col(session_col).alias("rid"), Cols.POS), points, "rid", "pos")
    out = rows.join(wins, ["rid", "pos"], "left").withColumn("wins", F.coalesce("wins", F.lit(0)))
    # the maximum as a scalar subquery: the wins aggregate is planned once
    # and its exchange reused, instead of a separate driver round trip
    mx = wins.agg(F.max("wins")).scalar()
    label = F.when(F.coalesce(mx, F.lit(0)) > 0, F.col("wins") / mx).otherwise(F.col("wins").cast("double"))
    return out.withColumn("win_label", label.cast("float"))


def group_sizes(features: DataFrame, session_col: str = Cols.RID) -> tuple[DataFrame, DataFrame]:
    """P10: dense group id of the sorted distinct sessions and their sizes;
    plus a one-row (n_groups, min_size, max_size) summary."""
    sizes = features.groupBy(F.col(session_col).alias("rid")).agg(F.count(F.lit(1)).alias("size"))
    ids = with_global_index(sizes, ["rid"], "group_id")
    stats = sizes.agg(F.count(F.lit(1)).alias("n_groups"), F.min("size").alias("min_size"),
                      F.max("size").alias("max_size"))
    return ids, stats
