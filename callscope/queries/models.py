"""The models: staging, intermediate, marts, and the published roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope import fixtures as fx
from callscope.operators.coding import unmatched_notes
from callscope.plans import intermediate, marts, rollups, staging
from callscope.queries import ctes
from callscope.queries.registry import query, with_ctes


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_calls(fx.calls(spark, sf_dir))


def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_dispositions(fx.dispositions(spark, sf_dir))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_payments(fx.payments(spark, sf_dir))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_agent_mapping(fx.agent_mapping(spark, sf_dir))


def money(df: DataFrame, *columns: str) -> DataFrame:
    """Round sums of doubles, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 4) for c in columns})


query("stg_calls", with_ctes(*ctes.CALLS, select="SELECT * FROM stg_calls"))(calls)
query("stg_dispositions", with_ctes(*ctes.DISPOSITIONS, select="SELECT * FROM stg_dispositions"))(
    dispositions
)
query("stg_payments", with_ctes(*ctes.PAYMENTS, select="SELECT * FROM stg_payments"))(payments)
query("stg_agent_mapping", with_ctes(*ctes.MAPPING, select="SELECT * FROM stg_mapping"))(mapping)


@query(
    "dim_agent",
    with_ctes(
        *ctes.MAPPING, select="SELECT ameyo_user_id, atlas_user_name, team, market FROM stg_mapping"
    ),
)
def dim_agent(spark, sf_dir):
    return marts.dim_agent(mapping(spark, sf_dir))


@query("int_calls_coded", with_ctes(*ctes.ALL_CODED, select="SELECT * FROM coded"))
def int_calls_coded(spark, sf_dir):
    return intermediate.int_calls_coded(calls(spark, sf_dir), dispositions(spark, sf_dir))


@query("j1_calls_coded_salted", with_ctes(*ctes.ALL_CODED, select="SELECT * FROM coded"))
def calls_coded_salted(spark, sf_dir):
    """The same rows when an id on two notes already counts as too frequent for one task."""
    return intermediate.int_calls_coded(
        calls(spark, sf_dir), dispositions(spark, sf_dir), split_rows=1
    )


@query(
    "int_dispositions_hierarchy", with_ctes(*ctes.ALL_DRIVERS, select="SELECT * FROM hierarchy")
)
def int_dispositions_hierarchy(spark, sf_dir):
    return intermediate.int_dispositions_hierarchy(dispositions(spark, sf_dir))


@query(
    "int_calls_payment_attribution",
    with_ctes(*ctes.ALL_ATTRIBUTION, select="SELECT * FROM attribution"),
)
def attribution(spark, sf_dir):
    return intermediate.int_calls_payment_attribution(
        dispositions(spark, sf_dir), payments(spark, sf_dir), fx.AS_OF
    )


@query(
    "payment_attribution_split_contracts",
    with_ctes(*ctes.ALL_ATTRIBUTION, select="SELECT * FROM attribution"),
)
def attribution_split(spark, sf_dir):
    """The same rows when every contract counts as too large for one task."""
    return intermediate.int_calls_payment_attribution(
        dispositions(spark, sf_dir), payments(spark, sf_dir), fx.AS_OF, split_rows=2
    )


@query("m1_coding_rate", with_ctes(*ctes.ALL_CODING, select="SELECT * FROM fct_coding"))
def coding_rate(spark, sf_dir):
    return marts.fct_coding_rate(
        int_calls_coded(spark, sf_dir), marts.dim_agent(mapping(spark, sf_dir))
    )


@query("m2_paid_post_call", with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid"))
def paid_post_call(spark, sf_dir):
    return marts.fct_paid_post_call(attribution(spark, sf_dir))


@query(
    "m3_value_recovered_usd", with_ctes(*ctes.ALL_VALUE, select="SELECT * FROM fct_value")
)
def value_recovered(spark, sf_dir):
    value = marts.fct_value_recovered_usd(attribution(spark, sf_dir), fx.fx_rates(spark))
    return money(value, "value_recovered_usd")


@query("m4_inbound_call_drivers", with_ctes(*ctes.ALL_DRIVERS, select="SELECT * FROM fct_drivers"))
def inbound_drivers(spark, sf_dir):
    return marts.fct_inbound_call_drivers(int_dispositions_hierarchy(spark, sf_dir))


@query(
    "k1_coding_rate_overall",
    with_ctes(
        *ctes.ALL_CODED,
        select="""
        SELECT count(*) FILTER (is_coded) AS coded_calls, count(*) AS total_calls,
               count(*) FILTER (is_coded)::DOUBLE / count(*) AS coding_rate
        FROM coded""",
    ),
)
def k1(spark, sf_dir):
    return rollups.coding_rate_overall(coding_rate(spark, sf_dir))


@query(
    "k2_paid_post_call_overall",
    with_ctes(
        *ctes.ALL_PAID,
        select="""
        SELECT count(*) FILTER (is_paid_post_call) AS paid_calls, count(*) AS assessable_calls,
               count(*) FILTER (is_paid_post_call)::DOUBLE / count(*) AS paid_rate
        FROM fct_paid WHERE is_window_closed""",
    ),
)
def k2(spark, sf_dir):
    return rollups.paid_post_call_overall(paid_post_call(spark, sf_dir))


@query(
    "k3_value_recovered_by_market",
    with_ctes(
        *ctes.ALL_ATTRIBUTION,
        fx.FX_RATES_SQL,
        ctes.FCT_VALUE,
        select="""
        SELECT market, grouping(market)::INTEGER AS is_total,
               round(sum(amount_local / rate), 4) AS value_recovered_usd
        FROM attribution LEFT JOIN newest USING (currency) WHERE is_paid_post_call
        GROUP BY ROLLUP (market)""",
    ),
)
def k3(spark, sf_dir):
    value = marts.fct_value_recovered_usd(attribution(spark, sf_dir), fx.fx_rates(spark))
    return money(rollups.value_recovered_by_market(value), "value_recovered_usd")


@query(
    "k4_top_inbound_drivers",
    with_ctes(
        *ctes.ALL_DRIVERS,
        select="""
        SELECT level_one, count(*) AS call_count FROM hierarchy
        GROUP BY level_one ORDER BY call_count DESC, level_one LIMIT 3""",
    ),
)
def k4(spark, sf_dir):
    return rollups.top_drivers(inbound_drivers(spark, sf_dir), 3)


@query(
    "a10_driver_drill_down",
    with_ctes(
        *ctes.ALL_DRIVERS,
        select="""
        SELECT level_one, level_two, level_three,
               grouping(level_one, level_two, level_three)::INTEGER AS depth_id,
               count(*) AS call_count
        FROM hierarchy GROUP BY ROLLUP (level_one, level_two, level_three)""",
    ),
)
def a10(spark, sf_dir):
    return rollups.driver_drill_down(inbound_drivers(spark, sf_dir))


@query(
    "p15_settled_paid_post_call",
    with_ctes(*ctes.ALL_PAID, select="SELECT * FROM fct_paid WHERE is_window_closed"),
)
def p15(spark, sf_dir):
    return rollups.settled(paid_post_call(spark, sf_dir))


@query(
    "j8_unmatched_notes",
    with_ctes(
        *ctes.ALL_CODED,
        select="""
        SELECT call_id, candidate_call_log_id FROM coded
        WHERE candidate_call_log_id IS NOT NULL AND NOT is_coded""",
    ),
)
def j8(spark, sf_dir):
    return unmatched_notes(calls(spark, sf_dir), dispositions(spark, sf_dir)).select(
        "call_id", "candidate_call_log_id"
    )
