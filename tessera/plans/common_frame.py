"""Flagship plan: the shared common frame (SURVEY §3 (1), §7.2 step 2).

clean -> type -> key parts -> missing indicators -> group-consistent fill ->
flag rule inference -> flag/amount rule -> train-fit statistics (age median,
hierarchical amount medians, surname frequencies, quantile bin edges) applied
to both splits -> amount, age, structure and interaction features.

Train and test travel in one DataFrame with a ``split`` column, so every
statistic is fitted with ``fit_on = split == 'train'`` and applied by a join;
nothing is fitted or applied twice.  Column roles come from :class:`Roles`,
so the same plan runs on any entity table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera.operators import clean as CL
from tessera.operators import impute as IM
from tessera.operators.binning import apply_quantile_bins, edge_quantiles, edges_expr
from tessera.operators.core import lookup, materialize, settled, with_scalars
from tessera.operators.profile import level_quantiles, level_table


@dataclass
class Roles:
    """Column roles of an entity table (defaults: fixture W)."""

    id: str = "id"
    split: str = "split"
    label: str = "y"
    home: str = "home"
    dest: str = "dest"
    vip: str = "vip"
    flag: str = "flag"
    code: str = "code"
    age: str = "age"
    name: str = "name"
    amounts: list[str] = field(default_factory=lambda: ["a1", "a2", "a3", "a4", "a5"])
    luxury: list[str] = field(default_factory=lambda: ["a4", "a5"])
    basic: list[str] = field(default_factory=lambda: ["a1", "a2", "a3"])

    @property
    def levels(self) -> list[list[str]]:
        return [[self.home, self.dest, self.vip, "deck"], [self.home, self.dest, "deck"], [self.home, "deck"]]

    @property
    def indicator_sources(self) -> list[str]:
        return [self.age, self.home, self.flag, self.code, self.dest, self.vip, *self.amounts, self.name]


# Fixed values of the reference's age bins (left-closed) and labels.
AGE_EDGES = [13.0, 18.0, 30.0, 45.0, 60.0]
AGE_LABELS = ["Child", "Teen", "YoungAdult", "Adult", "MiddleAge", "Senior"]


def age_group(c: Column) -> Column:
    out = F.when(c < F.lit(-0.001), "Unknown")
    lo = -0.001
    for edge, lab in zip(AGE_EDGES, AGE_LABELS):
        out = out.when((c >= lo) & (c < edge), lab)
        lo = edge
    return F.coalesce(out.when(c >= lo, AGE_LABELS[-1]), F.lit("Unknown"))


def cleaned(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    return CL.normalize_booleans(CL.clean_strings(df), [r.flag, r.vip])


def parsed(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """Key parts of cleaned rows."""
    group, member = C.split_id(r.id)
    deck, num, side = C.split_code(r.code)
    return df.withColumns({
        "group_id": group, "member": member, "deck": deck, "num": num, "side": side,
        "surname": C.last_token(r.name),
    })


def typed(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """Clean, key parts and indicators: the row-local steps."""
    return IM.missing_indicators(parsed(cleaned(df, r), r), r.indicator_sources)


def prepare(df: DataFrame, r: Roles = Roles(), sizes: bool = False) -> DataFrame:
    """Clean, key parts, indicators, group fill (with ``sizes`` also ``group_size``) and rule steps (row-local + one group join).

    The join shuffles the rows, so only what it needs and the raw columns go through it: key parts and the
    indicators of columns that it doesn't fill are made from them afterwards.
    """
    filled = [r.home, r.vip, r.dest]
    # the group fill reads the rows twice (group table + join): compute them once
    df = materialize(cleaned(df, r), "rows")
    df = IM.missing_indicators(df, filled).withColumn("group_id", C.split_id(r.id)[0])
    df = IM.group_consistent_fill(df, ["split", "group_id"], filled, sizes={"group_id": "group_size"} if sizes else None)
    df = IM.missing_indicators(parsed(df, r), [c for c in r.indicator_sources if c not in filled])
    df = IM.infer_flag(df, r.flag, r.amounts, r.age)
    return IM.enforce_flag_zero(df, r.flag, r.amounts)


def prepared(df: DataFrame, r: Roles = Roles(), sizes: bool = False) -> DataFrame:
    """:func:`prepare` plus the age range guard: the frame every statistic is fitted on."""
    return IM.range_guard(prepare(df, r, sizes), r.age, 0.0, 100.0, flag="age_out_of_range")


def build(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """The whole common frame for train and test rows of ``df``."""
    train = F.col(r.split) == "train"
    # every fit below and the apply read this frame: compute it once
    source = df
    df = settled(lambda: prepared(source, r, sizes=True))
    # train-fit statistics: every global number in one row (a few fitted scalars); all global
    # quantiles (age, amounts, positive amounts, cabin number) come from one exact-quantile pass --
    fit = df.filter(train)
    qs = sorted({0.5, *edge_quantiles(5)})
    half = qs.index(0.5)
    variables = [r.age, *IM.global_values(r.amounts), "num"]
    names = [r.age, *r.amounts, *[f"pos_{a}" for a in r.amounts], "num"]
    # the amounts' level medians, in one pass with them
    found = settled(lambda: level_quantiles(fit, [*[(lvl, r.amounts) for lvl in r.levels], ([], variables)], qs), "quantiles")
    every = found.withColumn("q0", F.array(*[F.col(f"q{i}") for i in range(len(qs))]))
    wide = level_table(every, len(r.levels), [], {n: n for n in names})
    num_stats = fit.agg(F.count_distinct("num").alias("__nd"), F.min("num").alias("__lo"), F.max("num").alias("__hi"))
    glob = num_stats.withColumn("__one", F.lit(1)).join(F.broadcast(wide.withColumn("__one", F.lit(1))), "__one", "left")
    med = {n: F.get(F.col(n), half) for n in names}
    glob = glob.select(
        med[r.age].alias("age_median"),
        *[F.coalesce(med[a], F.lit(0.0)).alias(f"gmed_{a}") for a in r.amounts],
        *[F.coalesce(med[f"pos_{a}"], med[a], F.lit(0.0)).alias(f"pmed_{a}") for a in r.amounts],
        edges_expr({v: F.get(F.col("num"), i) for i, v in enumerate(qs)}, 5).alias("edges"),
    )
    spend = IM.spend_stats(fit, found.withColumn("q0", F.col(f"q{half}")), r.amounts, r.levels, [], with_global=False)
    surname_freq = (
        df.filter(train & F.col("surname").isNotNull()).groupBy("surname").agg(F.count(F.lit(1)).alias("surname_freq"))
    )
    # counted before the join: few surnames are broadcast, and the wide rows aren't shuffled by a few keys
    surname_freq = materialize(surname_freq, "surnames")
    # apply ------------------------------------------------------------------
    df = with_scalars(df, glob)
    df = df.withColumn(r.age, F.coalesce(F.col(r.age), F.col("age_median")))
    df = IM.apply_hier_medians(df, spend, r.flag)
    df = lookup(df, surname_freq, ["surname"], bound=surname_freq.count())
    df = apply_quantile_bins(df, "num", None, "num_bin", label_prefix="Bin_", missing_label="Bin_Missing")
    df = df.withColumns({
        "surname_freq": F.coalesce(F.col("surname_freq"), F.lit(0)).cast("bigint"),
        "group_size": F.coalesce(F.col("group_size"), F.lit(1)).cast("bigint"),
        "member": F.coalesce(F.col("member"), F.lit(-1)),
        "num": F.coalesce(F.col("num"), F.lit(-1.0)),
    })
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("Unknown")) for c in [r.home, r.flag, r.dest, r.vip, "deck", "side", "surname", r.name, r.code]})
    return add_features(df, r)


def build_folds(df: DataFrame, fold: str, k: int, r: Roles = Roles()) -> DataFrame:
    """K6: the common frame of every row as its own fold sees it: all statistics from the rows of the other folds.

    Rows are not copied to the folds.  A group has its size and fill values for each fold side by side, counts of a value have a
    column for each fold's train part, additive counts are the total less the own fold.  Only a row with a
    hole that the folds may fill differently stands for itself once a fold, when its values are counted.
    """
    filled = [r.home, r.vip, r.dest]
    own = F.col(fold)
    fitted = [F.coalesce(own != f, F.lit(True)) for f in range(k)]  # a row without a fold trains all

    def prepared_rows() -> DataFrame:
        rows = materialize(cleaned(df, r), "rows")
        rows = IM.missing_indicators(rows, filled).withColumn("group_id", C.split_id(r.id)[0])
        of = lambda f, c: F.when(fitted[f], F.col(c))
        one = lambda f, c: F.when(F.min(of(f, c)) == F.max(of(f, c)), F.min(of(f, c))).alias(c)
        seen = [F.struct(F.nullif(F.count_if(fitted[f]), F.lit(0)).alias("group_size"), *[one(f, c) for c in filled]) for f in range(k)]
        groups = rows.groupBy("group_id").agg(F.array(*seen).alias("__seen"))
        rows = lookup(rows, groups, ["group_id"], null_safe=True)
        hole = F.col(filled[0]).isNull() | F.col(filled[1]).isNull() | F.col(filled[2]).isNull()
        by_fold = F.transform("__seen", lambda s: F.struct(*[F.coalesce(F.col(c), s[c]).alias(c) for c in filled]))
        mine = F.get("__seen", own)
        rows = rows.withColumns({"__by_fold": F.when(hole, by_fold), "group_size": F.coalesce(mine["group_size"], F.lit(1)).cast("bigint")}
                                | {f"__own_{c}": F.coalesce(F.col(c), mine[c]) for c in filled}).drop("__seen")
        rows = IM.missing_indicators(parsed(rows, r), [c for c in r.indicator_sources if c not in filled])
        rows = IM.enforce_flag_zero(IM.infer_flag(rows, r.flag, r.amounts, r.age), r.flag, r.amounts)
        return IM.range_guard(rows, r.age, 0.0, 100.0, flag="age_out_of_range")

    rows = settled(prepared_rows, "fold-rows")
    whole = F.array(F.struct(F.lit(-1).alias("f"), *filled))
    copies = F.filter(F.transform("__by_fold", lambda s, i: F.struct(i.alias("f"), *[s[c].alias(c) for c in filled])), lambda s: F.coalesce(s["f"] != own, F.lit(True)))
    fit = rows.withColumn("__s", F.explode(F.when(F.col("__by_fold").isNull(), whole).otherwise(copies)))
    fit = fit.withColumns({c: F.col(f"__s.{c}") for c in filled})
    parts = [F.when(F.col("__s.f") == -1, fitted[f]).otherwise(F.col("__s.f") == f) for f in range(k)]
    qs = sorted({0.5, *edge_quantiles(5)})
    half = qs.index(0.5)
    names = [*r.amounts, *[f"pos_{a}" for a in r.amounts], r.age, "num"]
    variables = [*IM.global_values(r.amounts), r.age, "num"]
    found = settled(lambda: level_quantiles(fit, [*[(lvl, r.amounts) for lvl in r.levels], ([], variables)], qs, parts=parts, part="fit_fold"), "fold-quantiles")
    medians = found.withColumn("q0", F.col(f"q{half}"))
    others = F.explode(F.filter(F.array(*[F.lit(f) for f in range(k)]), lambda f: F.coalesce(f != own, F.lit(True)))).alias("fit_fold")
    spread = rows.groupBy(fold, "num").agg(F.count(F.lit(1))).select(others, "num")  # distinct values, not rows, go to the folds
    spread = spread.groupBy("fit_fold").agg(F.count_distinct("num").alias("__nd"), F.min("num").alias("__lo"), F.max("num").alias("__hi"))
    spread = materialize(spread, "fold-spread")
    stats = IM.spend_stats(spread, medians, r.amounts, r.levels, ["fit_fold"])
    every = found.withColumn("q0", F.array(*[F.col(f"q{i}") for i in range(len(qs))]))
    wide = level_table(every, len(r.levels), [], {n: f"__{n}" for n in names}, by=["fit_fold"])
    glob = spread.join(wide, "fit_fold", "left").select(
        "fit_fold", F.get(F.col(f"__{r.age}"), half).alias("age_median"), edges_expr({v: F.get(F.col("__num"), i) for i, v in enumerate(qs)}, 5).alias("edges")
    )
    freq = rows.where(F.col("surname").isNotNull()).groupBy("surname").agg(*[F.count_if(c).alias(f"__f{f}") for f, c in enumerate(fitted)])
    freq = freq.select("surname", F.posexplode(F.array(*[F.col(f"__f{f}") for f in range(k)])).alias("fit_fold", "surname_freq")).where("surname_freq > 0")
    freq = materialize(freq, "fold-surnames")
    out = rows.where(own.isin(*range(k))).withColumns({c: F.col(f"__own_{c}") for c in filled} | {"fit_fold": own}).drop("__by_fold", *[f"__own_{c}" for c in filled])
    out = lookup(lookup(out, glob, ["fit_fold"], bound=k), freq, ["fit_fold", "surname"], bound=freq.count())
    out = IM.apply_hier_medians(out.drop("fit_fold"), stats, r.flag, fold_col=fold, k=k)
    out = apply_quantile_bins(out, "num", None, "num_bin", label_prefix="Bin_", missing_label="Bin_Missing")
    out = out.withColumns({
        r.age: F.coalesce(F.col(r.age), F.col("age_median")), "surname_freq": F.coalesce(F.col("surname_freq"), F.lit(0)).cast("bigint"),
        "member": F.coalesce(F.col("member"), F.lit(-1)), "num": F.coalesce(F.col("num"), F.lit(-1.0)),
        **{c: F.coalesce(F.col(c), F.lit("Unknown")) for c in [r.home, r.flag, r.dest, r.vip, "deck", "side", "surname", r.name, r.code]},
    })
    return add_features(out, r)


def add_features(df: DataFrame, r: Roles = Roles()) -> DataFrame:
    """Amount, age, structure and interaction features (one projection)."""
    total = C.row_sum(r.amounts)
    luxury = C.row_sum(r.luxury)
    count_pos = C.row_count_positive(r.amounts)
    age = F.col(r.age)
    return df.withColumns({
        "total": total,
        "is_zero": (total == 0).cast("int"),
        "spend_count": count_pos,
        "is_child": (age < 18).cast("int"),
        "is_senior": (age >= 60).cast("int"),
        "age_group": age_group(age),
        "luxury": luxury,
        "basic": C.row_sum(r.basic),
        "luxury_share": C.safe_ratio(luxury, total + 1.0),
        "spend_per_active": C.safe_ratio(total, F.when(count_pos == 0, F.lit(None)).otherwise(count_pos)),
        "has_luxury": (luxury > 0).cast("int"),
        "is_solo": (F.col("group_size") == 1).cast("int"),
        "is_multi": (F.col("group_size") > 1).cast("int"),
        "is_leader": (F.col("member") == 1).cast("int"),
        "deck_side": C.interaction_key("deck", "side"),
        "home_dest": C.interaction_key(r.home, r.dest),
    })


OUTPUT_COLUMNS = [
    "id", "split", "y", "group_id", "member", "group_size", "home", "flag", "dest", "vip", "deck", "num",
    "side", "surname", "age", "age_out_of_range", "a1", "a2", "a3", "a4", "a5",
    "a1_fill", "a2_fill", "a3_fill", "a4_fill", "a5_fill", "flag_rule",
    "ageMissing", "homeMissing", "flagMissing", "codeMissing", "destMissing", "vipMissing",
    "a1Missing", "a2Missing", "a3Missing", "a4Missing", "a5Missing", "nameMissing",
    "home_group_filled", "vip_group_filled", "dest_group_filled",
    "surname_freq", "num_bin", "total", "is_zero", "spend_count", "is_child", "is_senior", "age_group",
    "luxury", "basic", "luxury_share", "spend_per_active", "has_luxury", "is_solo", "is_multi", "is_leader",
    "deck_side", "home_dest",
]
