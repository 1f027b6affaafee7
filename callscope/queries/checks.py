"""Data checks, gap figures and single functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from callscope import fixtures as fx
from callscope.functions import note_to_id, strip_outer_whitespace
from callscope.operators import profile, quality
from callscope.operators.attribution import attribute_payments
from callscope.plans import marts
from callscope.queries import ctes, models
from callscope.queries.registry import query, with_ctes


@query(
    "d1_duplicate_logins",
    with_ctes(
        fx.AGENT_MAPPING_SQL,
        select="""
        SELECT ameyo_user_id, count(*) AS n FROM raw_mapping
        GROUP BY ameyo_user_id HAVING count(*) > 1""",
    ),
)
def d1(spark, sf_dir):
    return quality.unique("mapping", fx.agent_mapping(spark, sf_dir), "ameyo_user_id").violations


@query(
    "d2_null_contracts",
    with_ctes(
        fx.DISPOSITIONS_SQL,
        select="SELECT count(*) AS n FROM raw_dispositions WHERE contract_id IS NULL",
    ),
)
def d2(spark, sf_dir):
    check = quality.not_null("dispositions", models.dispositions(spark, sf_dir), "contract_id")
    return check.violations.agg(F.count("*").alias("n"))


@query(
    "d3_rates_out_of_range",
    with_ctes(
        *ctes.ALL_CODING,
        select="SELECT coding_rate_id, coding_rate FROM fct_coding WHERE coding_rate > 0.25",
    ),
)
def d3(spark, sf_dir):
    coding = models.coding_rate(spark, sf_dir)
    check = quality.accepted_range("fct_coding_rate", coding, "coding_rate", 0, 0.25)
    return check.violations.select("coding_rate_id", "coding_rate")


@query(
    "d5_blank_note_share",
    with_ctes(
        *ctes.CALLS,
        select="""
        SELECT count(*) FILTER (call_notes_raw IS NULL) AS blank, count(*) AS total,
               count(*) FILTER (call_notes_raw IS NULL)::DOUBLE / count(*) AS share
        FROM stg_calls""",
    ),
)
def d5_share(spark, sf_dir):
    return quality.blank_share(models.calls(spark, sf_dir), "call_notes_raw")


@query(
    "d5_unaccepted_providers",
    with_ctes(
        *ctes.PAYMENTS,
        select="""
        SELECT payment_request_provider, count(*) AS n FROM stg_payments
        WHERE payment_request_provider <> 'MPESA' GROUP BY 1""",
    ),
)
def d5_providers(spark, sf_dir):
    return quality.accepted_values(
        "payments", models.payments(spark, sf_dir), "payment_request_provider", ["MPESA"]
    ).violations


@query(
    "d6_payments_without_rate",
    with_ctes(
        *ctes.ALL_ATTRIBUTION,
        select="""
        SELECT pay_timestamp_utc::DATE AS call_date, market, currency, count(*) AS payments,
               round(sum(amount_local), 4) AS amount_local
        FROM attribution WHERE is_paid_post_call AND currency = 'NGN' GROUP BY ALL""",
    ),
)
def d6(spark, sf_dir):
    rates = fx.fx_rates(spark).filter("currency <> 'NGN'")
    priced = marts.priced_payments(models.attribution(spark, sf_dir), rates)
    return models.money(quality.missing_rates(priced), "amount_local")


@query(
    "g1_blank_notes",
    with_ctes(
        *ctes.CALLS,
        select="""
        SELECT count(*) - count(call_notes_raw) AS blank, count(*) AS total FROM stg_calls""",
    ),
)
def g1(spark, sf_dir):
    return profile.blank_notes(models.calls(spark, sf_dir))


@query(
    "g2_note_classes",
    with_ctes(
        *ctes.ALL_CODED,
        select="""
        SELECT CASE WHEN is_coded THEN 'matched' WHEN candidate_call_log_id IS NULL THEN 'not an id'
                    ELSE 'unmatched' END AS note_class, count(*) AS n
        FROM coded WHERE call_notes_raw IS NOT NULL GROUP BY 1""",
    ),
)
def g2(spark, sf_dir):
    return profile.note_classes(models.calls(spark, sf_dir), models.dispositions(spark, sf_dir))


@query(
    "g3_mapping_duplicates",
    with_ctes(
        fx.AGENT_MAPPING_SQL,
        select="""
        SELECT CASE WHEN variants = 1 THEN 'exact' WHEN teams = 1 THEN 'conflicting'
                    ELSE 'conflicting on team' END AS duplicate_class,
               count(*) AS logins, sum(n)::BIGINT AS mapping_rows
        FROM (SELECT ameyo_user_id, count(*) AS n, count(DISTINCT team) AS teams,
                     count(DISTINCT (contact_centre, team, atlas_user_name)) AS variants
              FROM raw_mapping GROUP BY 1 HAVING count(*) > 1)
        GROUP BY 1""",
    ),
)
def g3(spark, sf_dir):
    return profile.mapping_duplicates(fx.agent_mapping(spark, sf_dir))


@query(
    "g4_odd_payments",
    with_ctes(
        *ctes.PAYMENTS,
        select="""
        SELECT count(*) FILTER (amount_local <= 0) AS not_positive,
               count(*) FILTER (payment_request_provider = 'MANUAL') AS manual,
               count(*) FILTER (payment_request_provider = 'UNKNOWN') AS unknown,
               count(*) FILTER (payment_request_provider = 'LOYALTY_DISCOUNT') AS loyalty_discount
        FROM stg_payments""",
    ),
)
def g4(spark, sf_dir):
    return profile.odd_payments(models.payments(spark, sf_dir))


@query(
    "g5_null_contracts_by_call_type",
    with_ctes(
        *ctes.DISPOSITIONS,
        select="""
        SELECT call_type, count(*) - count(contract_id) AS null_contracts, count(*) AS dispositions
        FROM stg_dispositions GROUP BY 1""",
    ),
)
def g5(spark, sf_dir):
    return profile.null_contracts(models.dispositions(spark, sf_dir))


@query(
    "g6_tied_dispositions",
    with_ctes(
        *ctes.DISPOSITIONS,
        select="""
        SELECT count(*) AS tied FROM (
          SELECT 1 FROM stg_dispositions WHERE contract_id IS NOT NULL
          GROUP BY contract_id, disposed_at_utc HAVING count(*) > 1)""",
    ),
)
def g6(spark, sf_dir):
    return profile.tied_dispositions(models.dispositions(spark, sf_dir))


@query(
    "g7_call_types",
    with_ctes(
        *ctes.DISPOSITIONS,
        select="SELECT call_type, count(*) AS n FROM stg_dispositions GROUP BY 1",
    ),
)
def g7(spark, sf_dir):
    return profile.call_types(models.dispositions(spark, sf_dir))


@query(
    "g8_contract_load",
    with_ctes(
        *ctes.DISPOSITIONS,
        *ctes.PAYMENTS,
        """
        paying AS (SELECT contract_id, count(*) AS n FROM stg_payments
                   WHERE contract_id IS NOT NULL GROUP BY 1),
        called AS (SELECT contract_id, count(*) AS n FROM stg_dispositions
                   WHERE contract_id IS NOT NULL GROUP BY 1)""",
        select="""
        SELECT count(*) AS paying, count(*) FILTER (n > 1) AS paying_repeatedly,
               (SELECT max(n) FROM called) AS most_dispositions,
               count(*) FILTER (n > 1)::DOUBLE / count(*) AS repeat_share
        FROM paying""",
    ),
)
def g8(spark, sf_dir):
    return profile.contract_load(models.dispositions(spark, sf_dir), models.payments(spark, sf_dir))


@query(
    "collapsed_payments",
    with_ctes(
        *ctes.PAYMENTS,
        select="""
        SELECT (count(*) - count(DISTINCT (contract_id, pay_timestamp_utc, amount_local)))::BIGINT
               AS collapsed
        FROM stg_payments WHERE contract_id IS NOT NULL AND amount_local > 0""",
    ),
)
def collapsed(spark, sf_dir):
    return profile.collapsed_payments(models.payments(spark, sf_dir))


@query(
    "j4_payment_owner",
    with_ctes(
        *ctes.ALL_ATTRIBUTION,
        select="""
        SELECT contract_id, pay_timestamp_utc, amount_local, call_log_id, disposed_at_utc
        FROM attribution WHERE is_paid_post_call""",
    ),
)
def j4(spark, sf_dir):
    owned = attribute_payments(
        models.dispositions(spark, sf_dir), models.payments(spark, sf_dir)
    ).filter("pay_timestamp_utc is not null")
    return owned.select(
        "contract_id", "pay_timestamp_utc", "amount_local", "call_log_id", "disposed_at_utc"
    )


@query(
    "a9_distinct_mapping",
    with_ctes(fx.AGENT_MAPPING_SQL, select="SELECT DISTINCT * FROM raw_mapping"),
)
def a9(spark, sf_dir):
    return profile.mapping_variants(fx.agent_mapping(spark, sf_dir)).drop("n")


@query(
    "f4_f6_note_ids",
    with_ctes(
        *ctes.CALLS,
        select=r"""
        SELECT call_id, regexp_replace(call_notes_raw, '^\s+|\s+$', '', 'g') AS stripped,
               try_cast(nullif(regexp_extract(call_notes_raw, '^\s*([0-9]+)\s*$', 1), '') AS BIGINT)
                 AS note_id
        FROM stg_calls""",
    ),
)
def note_ids(spark, sf_dir):
    note = F.col("call_notes_raw")
    return models.calls(spark, sf_dir).select(
        "call_id",
        strip_outer_whitespace(note).alias("stripped"),
        note_to_id(note).alias("note_id"),
    )
