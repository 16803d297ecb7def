"""Selection: diverse top-k, balancing, quotas, samples and grouped splits.

Each greedy loop of its kind is a stack of window ranks here, so that a source or
type is one window partition and nothing comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import stable_score
from .ranking import bottom_k, first_by_quota


#: Stretches of the hashed order of groups that are ranked apart.
STRETCHES = 4096


def diverse_top_k(df: DataFrame, source: str, branch: str, kind: str, score: Column, tie: Column, branch_order: Column, k: int, kind_tie: Column) -> DataFrame:
    """Per source at most ``k`` rows: branches take turns, within them kinds take turns.

    A row's rank among its kind is at most its rank in the branch, and that its
    rank in the source, so rows beyond ``k`` go after each step.
    """
    within = Window.partitionBy(source, branch, kind).orderBy(score.desc(), tie, "sample_id")
    rows = df.withColumn("__i", F.row_number().over(within)).filter(F.col("__i") <= k)
    turn = Window.partitionBy(source, branch).orderBy("__i", kind_tie, kind)
    rows = rows.withColumn("__n", F.row_number().over(turn)).filter(F.col("__n") <= k)
    last = Window.partitionBy(source).orderBy("__n", branch_order)
    return rows.withColumn("pick", F.row_number().over(last)).filter(F.col("pick") <= k).drop("__i", "__n")


def balanced_downsample(df: DataFrame, part: str, kind: str, limits: DataFrame, tie: Column, kind_tie: Column) -> DataFrame:
    """In each part at most ``target`` rows (of ``limits``), kinds taking turns, rarer kinds first.

    Turns are a quota for each kind: as many whole rounds as the target allows, and
    one row more for the rarest kinds that aren't used up.
    """
    counts = df.groupBy(part, kind).agg(F.count(F.lit(1)).alias("n")).join(limits, part)
    first = [F.col("n"), kind_tie, F.col(kind)]
    quotas = water_fill(counts, kind, F.col("target"), [part], first).select(part, kind, "quota")
    return first_by_quota(df, [part, kind], quotas, [tie], ["sample_id"])


def largest_remainder(counts: DataFrame, key: str, total: Column, group: list[str] | None = None) -> DataFrame:
    """``quota``: shares of ``total`` in proportion to ``n``, the left-over ones to the largest remainders."""
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    rows = counts.withColumns({"__total": total, "__raw": total * F.col("n") / F.sum("n").over(whole)})
    rows = rows.withColumn("__base", F.floor("__raw")).withColumn(
        "__rank", F.row_number().over(whole.orderBy((F.col("__raw") - F.col("__base")).desc(), F.desc("n"), F.desc(key)))
    )
    more = (F.col("__rank") <= F.col("__total") - F.sum("__base").over(whole)).cast("int")
    return rows.withColumn("quota", (F.col("__base") + more).cast("long")).drop("__total", "__raw", "__base", "__rank")


def water_fill(counts: DataFrame, key: str, target: Column, group: list[str] | None = None, left_over: list[Column] | None = None) -> DataFrame:
    """``quota``: equal shares of ``target``, at most ``n`` each; what is over goes to the others.

    Shares that can't be equal go one by one to the first in the order ``left_over``: the largest, if it isn't given.
    """
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    order = whole.orderBy("n", key)
    rows = counts.withColumns(
        {
            "__t": F.least(target, F.sum("n").over(whole)),
            "__k": F.count(F.lit(1)).over(whole),
            "__i": F.row_number().over(order) - 1,
            "__pre": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    full_here = F.col("n") * (F.col("__k") - F.col("__i")) <= F.col("__t") - F.col("__pre")
    rows = rows.withColumn("__full", F.min(full_here.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rows = rows.withColumns(
        {
            "__left": F.col("__t") - F.coalesce(F.sum(F.when(F.col("__full"), F.col("n"))).over(whole), F.lit(0)),
            "__m": F.count_if(~F.col("__full")).over(whole),
        }
    )
    rank = F.row_number().over(Window.partitionBy(*(group or [F.lit(0)]), "__full").orderBy(*(left_over or [F.desc("n"), F.desc(key)])))
    share = F.expr("__left div greatest(__m, 1)") + (rank <= F.expr("__left % greatest(__m, 1)")).cast("int")
    return rows.withColumn("quota", F.when(F.col("__full"), F.col("n")).otherwise(share).cast("long")).drop(
        "__t", "__k", "__i", "__pre", "__full", "__left", "__m"
    )


def stratum_quotas(df: DataFrame, kind: str, parts: list[str], target: Column, group: list[str] | None = None) -> DataFrame:
    """``quota`` of each stratum: kinds by water filling, parts of a kind by largest remainder, level by level.

    The quotas of a group add up to the target, or to all its rows if there are fewer:
    shares of a number in proportion to counts, rounded to the next integers, are
    never above these counts.
    """
    group = group or []
    strata = df.groupBy(*group, kind, *parts).agg(F.count(F.lit(1)).alias("n"))
    kinds = strata.groupBy(*group, kind).agg(F.sum("n").alias("n"))
    quota = water_fill(kinds, kind, target, group).select(*group, kind, "quota")
    for level in range(len(parts)):
        above, here = [*group, kind, *parts[:level]], parts[level]
        counts = strata.groupBy(*above, here).agg(F.sum("n").alias("n")).join(quota.withColumnRenamed("quota", "__above"), above)
        quota = largest_remainder(counts, here, F.col("__above"), above).select(*above, here, "quota")
    return quota


def _best(tie: Column, score: Column | None) -> list[Column]:
    return [tie] if score is None else [-score, tie]


def stratified_cap(df: DataFrame, kind: str, part: str | list[str], target: int, tie: Column, score: Column | None = None) -> DataFrame:
    """``target`` rows by ``stratum_quotas``, of each stratum the best by score and tie."""
    parts = [part] if isinstance(part, str) else part
    quotas = stratum_quotas(df, kind, parts, F.lit(target))
    return first_by_quota(df, [kind, *parts], quotas, _best(tie, score), ["sample_id"])


def branch_caps(df: DataFrame, branch: str, caps: dict[str, int | None], kind: str, parts: list[str], tie: Column, score: Column | None = None) -> DataFrame:
    """Each branch of ``caps`` with at most its number of rows, all of them where it is None; others go.

    The quotas of a branch reach its cap, or all its rows, so nothing is left open
    for rows beyond them.
    """
    most = F.lit(None).cast("long")
    for name, cap in caps.items():
        most = F.when(F.col(branch) == name, F.lit((1 << 62) if cap is None else cap)).otherwise(most)
    rows = df.filter(F.col(branch).isin(*caps))
    whole = [name for name, cap in caps.items() if cap is None]
    capped = rows.filter(~F.col(branch).isin(*whole)) if whole else rows
    quotas = stratum_quotas(capped, kind, parts, most, [branch])
    kept = first_by_quota(capped, [branch, kind, *parts], quotas, _best(tie, score), ["sample_id"])
    return kept.unionByName(rows.filter(F.col(branch).isin(*whole))) if whole else kept


def sample_per_key(df: DataFrame, keys: list[str], k: int, order: list[Column]) -> DataFrame:
    """``k`` rows of each key, those first in a hashed order."""
    return bottom_k(df, keys, k, order)


def one_per_stratum(df: DataFrame, keys: list[str], total: int, first: list[Column], fill: list[Column]) -> DataFrame:
    """The first row of each stratum, then others up to ``total``, ``fill`` telling rows apart.

    A stratum's first row and ``total`` others of all are found by bounded lists,
    so neither a stratum nor the table is sorted.
    """
    names = [f"__f{i}" for i in range(len(fill))]
    rows = df.withColumns(dict(zip(names, fill, strict=True)))
    firsts = bottom_k(rows, keys, 1, first)
    others = bottom_k(rows, [], total, [F.col(n) for n in names])
    # Of rows that are equal in all of these, one is the first.
    copy = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*names))
    seen = firsts.select(*[F.col(c).alias(f"__s_{c}") for c in (*keys, *names)])
    same = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in (*keys, *names)]
    rest = others.withColumn("__copy", copy).join(seen, [*same, F.col("__copy") == 1], "left_anti").drop("__copy")
    both = firsts.withColumn("is_first", F.lit(True)).unionByName(rest.withColumn("is_first", F.lit(False)))
    return both.orderBy(F.desc("is_first"), *names).limit(total).drop(*names)


def first_per_key(df: DataFrame, keys: list[str], k: int, arrival: Column) -> DataFrame:
    """The first ``k`` rows of each key as they arrived."""
    return sample_per_key(df, keys, k, [arrival])


def grouped_split(df: DataFrame, group: str, seed: int, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Whole groups to train, val or test by a hashed order of the groups.

    The order is cut into stretches of the hash; groups are ranked within a
    stretch, and the stretches' counts are added up, so no task sorts all groups.
    """
    score = stable_score(F.lit(seed), F.col(group))
    groups = df.select(group).distinct().withColumn("__s", score)
    groups = groups.withColumn("__stretch", F.least(F.floor(F.col("__s") * STRETCHES), F.lit(STRETCHES - 1)).cast("int"))
    counts = groups.groupBy("__stretch").agg(F.count(F.lit(1)).alias("__c"))  # at most STRETCHES rows
    in_order = Window.partitionBy(F.lit(0)).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    starts = counts.select("__stretch", F.coalesce(F.sum("__c").over(in_order), F.lit(0)).alias("__before"), F.sum("__c").over(whole).alias("__n"))
    local = F.row_number().over(Window.partitionBy("__stretch").orderBy("__s", group))
    ranked = groups.withColumn("__l", local).join(F.broadcast(starts), "__stretch").withColumn("__r", F.col("__before") + F.col("__l"))
    to_train = F.bround(F.col("__n") * F.lit(train))
    to_val = to_train + F.least(F.bround(F.col("__n") * F.lit(val)), F.col("__n") - to_train)
    split = F.when(F.col("__r") <= to_train, "train").when(F.col("__r") <= to_val, "val").otherwise("test")
    return df.join(ranked.select(group, split.alias("split")), group)
