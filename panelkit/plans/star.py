"""Star schema: one fact table on (entity, period) and three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit import config
from panelkit.config import ENTITY, PERIOD
from panelkit.functions import expressions as x
from panelkit.operators import windows as win
from panelkit.operators.relational import attach, dense_key, keep_one
from panelkit.session import store


def _unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key under an order over all columns, so that reruns keep the same row."""
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in keys]
    return keep_one(df, keys, rest or [F.lit(1)])


def join_sources(
    wide: DataFrame, by_period: DataFrame, *by_entity: DataFrame, entity=ENTITY, period=PERIOD, unique=False
) -> DataFrame:
    """Left joins of the panel with a per-period series and with per-entity indicator tables.

    ``unique``: the caller states that every source has one row per key, for example because it was
    just grouped by it; then no window looks for repeats.
    """
    keys = [entity, period]
    one = (lambda df, on: df) if unique else _unique
    out = attach(one(wide, keys), one(by_period, [period]), [period])
    for indicators in by_entity:
        out = out.join(one(indicators, keys), keys, "left")
    return out


def energy_features(fact: DataFrame) -> DataFrame:
    """Row-wise features: intensity, fuel shares, the residual share and their difference."""
    c = F.col
    shares = {
        f"{fuel}_share": x.share_of(c(f"{fuel}_co2"), c("co2")) for fuel in ("coal", "gas", "oil")
    }
    return (
        fact.withColumn("energy_intensity", x.guarded_ratio(c("energy_per_capita"), c("gdp") / non_zero(c("population"))))
        .withColumns(shares)
        .withColumn("renewables_share", x.residual_share(*map(c, shares)))
        .withColumn("sustainability_score", c("renewables_share") - c("coal_share"))
    )


def non_zero(c):
    """The value where it is not zero (a zero divisor then gives NULL, not an error)."""
    return F.when(c != 0, c)


def history_features(fact: DataFrame, entity=ENTITY, period=PERIOD) -> DataFrame:
    """Growth, rolling mean and gap fill; all share one window spec, hence one exchange and sort."""
    filled = {c: win.fill_both(c, entity, period) for c in config.FILL_COLUMNS if c in fact.columns}
    return fact.withColumns({
        "co2_growth_rate": win.percent_change("co2", entity, period),
        "co2_per_capita_5yr_avg": win.rolling_mean("co2_per_capita", 5, 2, entity, period),
        **filled,
    })


def build_fact(
    wide: DataFrame, by_period: DataFrame, *by_entity: DataFrame, entity=ENTITY, period=PERIOD, unique=False
) -> DataFrame:
    joined = join_sources(wide, by_period, *by_entity, entity=entity, period=period, unique=unique)
    return history_features(energy_features(joined), entity, period)


def with_country_id(fact: DataFrame, entities: DataFrame | None = None, entity=ENTITY) -> DataFrame:
    """Number the entities of the fact, or of the narrower table it was built from."""
    ids = dense_key(fact if entities is None else entities, entity, "country_id")
    return fact.join(ids.withColumn("country_id", F.col("country_id").cast("int")), entity, "left")


def build_dim_country(fact: DataFrame, lookup: DataFrame | None = None, entity=ENTITY, period=PERIOD) -> DataFrame:
    """One row per entity: first known name, key, continent and income group.

    ``lookup`` (entity, continent, income_group) replaces the built-in country tables.
    """
    names = store(fact.groupBy(entity).agg(
        F.min_by("country", F.when(F.col("country").isNotNull(), F.col(period))).alias("country_name")
    ), "names")  # read for the key and for the table
    ids = dense_key(names, entity, "country_id").withColumn("country_id", F.col("country_id").cast("int"))
    dim = names.join(ids, entity)
    if lookup is None:
        dim = dim.withColumns({
            "continent": x.lookup(F.col(entity), config.CONTINENT_OF, config.DEFAULT_CONTINENT),
            "income_group": x.lookup(F.col(entity), config.INCOME_GROUP_OF, config.DEFAULT_INCOME_GROUP),
        })
    else:
        dim = dim.join(lookup.select(entity, "continent", "income_group"), entity, "left").fillna({
            "continent": config.DEFAULT_CONTINENT, "income_group": config.DEFAULT_INCOME_GROUP,
        })
    return dim.select("country_id", "country_name", "continent", "income_group", entity)


def build_dim_time(fact: DataFrame, period=PERIOD) -> DataFrame:
    c = F.col(period)
    return fact.select(period).distinct().select(
        period,
        x.first_day(c).alias("date"),
        x.decade(c).alias("decade"),
        x.period_label(c).alias("period"),
    )


def build_dim_energy_type(spark: SparkSession) -> DataFrame:
    rows = F.explode(F.array(*[
        F.struct(F.lit(t).alias("energy_type"), F.lit(c).alias("category")) for t, c in config.ENERGY_TYPES]))
    return spark.range(1).select(rows.alias("r")).select("r.*")
