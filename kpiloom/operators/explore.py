"""Exploratory statistics of a labelled history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numeric import percent_change, ratio
from kpiloom.functions.timegrid import hour_of_day
from kpiloom.operators.blocks import BLOCK, BLOCK_STEPS, in_block, over_blocks, with_block, with_halo, with_position
from kpiloom.operators.quantiles import exact_quantiles
from kpiloom.schema import AUTOCORR_LAGS, GRID, KPI_UNITS, KPIS, STATES, THRESHOLDS

PERCENTILES = {0.05: "p5", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95", 0.99: "p99"}


def _unit(kpi: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k in KPIS for x in (k, KPI_UNITS[k])]), kpi)


def long_kpis(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One row per KPI value: ``kpi, value``."""
    return df.unpivot(list(keep), KPIS, "kpi", "value")


def describe(history: DataFrame) -> DataFrame:
    """Count, mean, spread, exact percentiles and bias-adjusted skew per KPI."""
    n = F.count("value")
    moments = (
        long_kpis(history)
        .groupBy("kpi")
        .agg(
            n.alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.when(n > 2, F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        )
    )
    points = exact_quantiles(history, KPIS, list(PERCENTILES))
    shares = points.groupBy(F.col("name").alias("kpi")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in PERCENTILES.items()]
    )
    return moments.join(shares, "kpi").withColumn("unite", _unit(F.col("kpi")))


def normal_vs_anomaly(history: DataFrame) -> DataFrame:
    """How far apart the two regimes are, KPI by KPI, the clearest first."""
    odd = F.col("is_anomaly")
    stats = (
        long_kpis(history, ["is_anomaly"])
        .groupBy("kpi")
        .agg(
            F.avg(F.when(~odd, F.col("value"))).alias("mu_n"),
            F.avg(F.when(odd, F.col("value"))).alias("mu_a"),
            F.stddev_samp(F.when(~odd, F.col("value"))).alias("sigma"),
        )
    )
    return stats.select(
        "kpi",
        _unit(F.col("kpi")).alias("unite"),
        F.round("mu_n", 3).alias("moy_normal"),
        F.round("mu_a", 3).alias("moy_anomalie"),
        F.round(percent_change(F.col("mu_a"), F.col("mu_n")), 2).alias("ecart_relatif_pct"),
        F.round(ratio(F.abs(F.col("mu_a") - F.col("mu_n")), F.col("sigma")), 3).alias("separabilite_sigma"),
    ).orderBy(F.col("separabilite_sigma").desc(), "kpi")


def hourly_profile(history: DataFrame) -> DataFrame:
    return history.groupBy(hour_of_day(F.col("ts")).alias("heure")).agg(*[F.avg(k).alias(k) for k in KPIS])


def amplitude(profile: DataFrame) -> DataFrame:
    """Daily swing of the profile in percent of its mean."""
    swing = ratio(F.max("value") - F.min("value"), F.avg("value")) * 100
    return long_kpis(profile).groupBy("kpi").agg(F.round(swing, 1).alias("amplitude_pct"))


def correlation(history: DataFrame) -> DataFrame:
    """The Pearson matrix in long form ``kpi_a, kpi_b, r``, from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(KPIS) for b in KPIS[i + 1 :]]
    row = history.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("kpi_a"), F.lit(b).alias("kpi_b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs]
    cells += [F.struct(F.lit(b).alias("kpi_a"), F.lit(a).alias("kpi_b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs]
    cells += [F.struct(F.lit(k).alias("kpi_a"), F.lit(k).alias("kpi_b"), F.lit(1.0).alias("r")) for k in KPIS]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def strongest_pairs(matrix: DataFrame, n: int = 3) -> DataFrame:
    """Distinct KPI pairs by absolute correlation."""
    return (
        matrix.where(F.col("kpi_a") < F.col("kpi_b"))
        .orderBy(F.abs("r").desc(), "kpi_a", "kpi_b")
        .limit(n)
    )


def autocorrelation(
    history: DataFrame, grid: str = GRID, lags: list[int] = AUTOCORR_LAGS, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """Correlation of each cell's KPIs with their own past, by row shift."""
    longest = max(lags)
    placed = with_position(history.select("cell_id", "ts", *KPIS), grid, block_steps)
    size = max(block_steps, longest)
    blocked = with_halo(placed, "_pos", before=longest, block_steps=size)
    past = F.array(
        *[F.struct(F.lit(n).alias("lag"), F.lag(F.struct(*KPIS), n).over(in_block("_pos")).alias("before")) for n in lags]
    )
    shifted = blocked.withColumn("_past", past).where("_own").select("cell_id", *KPIS, F.explode("_past").alias("p"))
    rows = shifted.groupBy("cell_id", "p.lag").agg(*[F.corr(k, F.col("p.before")[k]).alias(k) for k in KPIS])
    return rows.unpivot(["cell_id", "lag"], KPIS, "kpi", "r").select(
        "cell_id", "kpi", "lag", F.nanvl("r", F.lit(None)).alias("autocorr")
    )


def grid_gaps(history: DataFrame, grid: str = GRID, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Number of consecutive row pairs per cell that are not one step apart."""
    blocked = with_block(history.select("cell_id", "ts"), grid, block_steps)
    here = Window.partitionBy(*BLOCK).orderBy("_i")
    stepped = blocked.withColumn("_delta", F.col("_i") - F.lag("_i").over(here))
    summary = stepped.groupBy(*BLOCK).agg(
        F.count_if(F.col("_delta") != 1).alias("_odd"), F.min("_i").alias("_first"), F.max("_i").alias("_last")
    )
    border = F.col("_first") - F.lag("_last").over(over_blocks())
    return (
        summary.withColumn("_border", F.coalesce((border != 1).cast("int"), F.lit(0)))
        .groupBy("cell_id")
        .agg(F.sum(F.col("_odd") + F.col("_border")).alias("irregular"))
    )


def contract_audit(history: DataFrame, grid: str = GRID, thresholds=THRESHOLDS) -> DataFrame:
    """One row on size, period, imputation, truth rate and breaches of the contract."""
    present = [k for k in KPIS if k in history.columns]
    out = lambda k: (F.col(k) < 0) | (F.col(k) > 100)
    has = lambda c: c in history.columns
    nulls = [F.count_if(F.col(k).isNull()) for k in present]
    seconds = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1_000_000)
    facts = history.agg(
        F.count(F.lit(1)).alias("n_lignes"),
        F.min("ts").alias("periode_debut"),
        F.max("ts").alias("periode_fin"),
        F.round(seconds / 86400, 2).alias("duree_jours"),
        F.round((F.avg(F.col("is_missing").cast("int")) if has("is_missing") else F.lit(0.0)) * 100, 4).alias(
            "taux_imputation_pct"
        ),
        F.round(F.avg(F.col("is_anomaly").cast("int")) * 100, 4).alias("taux_anomalie_pct"),
        sum(nulls[1:], nulls[0]).alias("valeurs_nulles"),
        *[
            (F.count_if(out(k)) if has(k) else F.lit(0).cast("long")).alias(f"hors_bornes_{k}")
            for k in ("packet_loss", "cell_load")
        ],
        *[F.count_if(F.col(k) < 0).alias(f"negatifs_{k}") for k in present],
        F.lit(",".join(k for k in KPIS if k not in present)).alias("kpi_absents"),
        F.lit(",".join(k for k in KPIS if k not in thresholds)).alias("seuils_absents"),
    )
    gaps = grid_gaps(history, grid).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("irregular"), F.lit(0)).alias("irregular")
    )
    pair = gaps.select(F.struct("n", "irregular").alias("g")).scalar()
    return (
        facts.withColumn("_g", pair)
        .withColumns({"n_cellules": F.col("_g.n"), "intervalles_irreguliers": F.col("_g.irregular")})
        .drop("_g")
    )


def histogram(df: DataFrame, bins: int = 80, by: list[str] = ("kpi",), value: str = "value") -> DataFrame:
    """Equal-width counts per group between the group's lowest and highest value.

    ``by`` must name few groups, such as KPIs or detectors.
    """
    by = list(by)
    v = F.col(value)
    ends = df.groupBy(by[0]).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.when(F.col("_hi") > F.col("_lo"), F.floor((v - F.col("_lo")) / width)).otherwise(0)
    binned = df.where(v.isNotNull()).join(ends, by[0]).withColumn("bin", F.least(place, F.lit(bins - 1)))
    return binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


def _share(n: Column, total: Column) -> Column:
    return F.round(n * 100.0 / total, 2)


def state_distribution(df: DataFrame, state: str = "qos_state") -> DataFrame:
    """Count and share of each state; a state that never occurs counts 0."""
    row = df.agg(
        F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(state) == s).alias(f"n{r}") for r, s in enumerate(STATES)]
    )
    states = F.array(*[F.struct(F.lit(s).alias("etat"), F.col(f"n{r}").alias("n")) for r, s in enumerate(STATES)])
    return row.select(F.explode(states).alias("s"), "all").select(
        "s.etat", "s.n", F.coalesce(_share(F.col("s.n"), F.nullif(F.col("all"), F.lit(0))), F.lit(0.0)).alias("pct")
    )


def _state_shares(df: DataFrame, by: str, state: str) -> DataFrame:
    counted = df.groupBy(by).agg(
        F.count(state).alias("all"), *[F.count_if(F.col(state) == s).alias(f"n{r}") for r, s in enumerate(STATES)]
    )
    return counted.select(by, *[_share(F.col(f"n{r}"), F.col("all")).alias(s) for r, s in enumerate(STATES)])


def state_by_cell(df: DataFrame, state: str = "qos_state") -> DataFrame:
    """Share of time each cell spends in each state."""
    return _state_shares(df, "cell_id", state)


def state_by_kpi(df: DataFrame, suffix: str = "") -> DataFrame:
    """Share of each state per KPI."""
    columns = [f"{k}_state{suffix}" for k in KPIS if f"{k}_state{suffix}" in df.columns]
    named = df.select(*[F.col(c).alias(c.removesuffix(f"_state{suffix}")) for c in columns])
    return _state_shares(named.unpivot([], named.columns, "kpi", "state"), "kpi", "state")


def state_truth_crosstab(df: DataFrame, state: str = "qos_state") -> DataFrame:
    """Share of each state among normal and among anomalous rows."""
    counted = df.groupBy(state, "is_anomaly").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("is_anomaly")
    return counted.select(
        F.col(state).alias("etat"), "is_anomaly", _share(F.col("n"), F.sum("n").over(whole)).alias("pct")
    )


def independence_check(per_kpi: DataFrame, distribution: DataFrame) -> DataFrame:
    """Share of good rows if KPIs were independent, next to the observed one."""
    share = F.col(STATES[0]) / 100.0
    expected = F.when(F.min(share) <= 0, 0.0).otherwise(F.exp(F.sum(F.ln(F.nullif(share, F.lit(0.0))))))
    observed = distribution.where(F.col("etat") == STATES[0]).select("pct").scalar()
    return per_kpi.agg((expected * 100).alias("attendu_pct")).withColumn("observe_pct", observed)


