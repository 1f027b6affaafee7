"""DuckDB SQL of the models, for comparison. Written apart from the Spark plans: list lookups for
labels, ASOF JOIN for the attribution."""

from __future__ import annotations

from callscope import fixtures as fx
from callscope.functions.keys import NULL_MARKER


def key_sql(*columns: str) -> str:
    parts = ", ".join(f"coalesce({c}::VARCHAR, '{NULL_MARKER}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


_MARKETS = "['Kenya', 'Uganda', 'Tanzania', 'Nigeria']"
_CURRENCIES = "['KES', 'UGX', 'TZS', 'NGN']"

STG_CALLS = f"""
stg_calls AS (
  SELECT ch_call_id AS call_id, ch_date_added AS called_at_local,
         {_MARKETS}[ch_contact_center_id] AS market,
         ch_system_disposition AS system_disposition, ch_call_type AS call_type,
         total_talk_time AS talk_time_ms, udh_user_id AS ameyo_user_id, campaign_name,
         nullif(trim(udh_notes), '') AS call_notes_raw
  FROM raw_calls)
"""

STG_DISPOSITIONS = f"""
stg_dispositions AS (
  SELECT call_log_id, {_MARKETS}[tenant_id - 1000] AS market, customer_id, contract_id,
         created_timestamp_utc AS disposed_at_utc, createdby AS disposed_by, call_type, level_one,
         nullif(trim(level_two), '') AS level_two, nullif(trim(level_three), '') AS level_three
  FROM raw_dispositions)
"""

STG_PAYMENTS = f"""
stg_payments AS (
  SELECT pay_timestamp_utc, {_MARKETS}[tenant_id - 1000] AS market,
         {_CURRENCIES}[tenant_id - 1000] AS currency, tenant_id, contract_id,
         trim(payment_request_provider) AS payment_request_provider, create_program,
         amount AS amount_local
  FROM raw_payments)
"""

STG_MAPPING = """
stg_mapping AS (
  SELECT DISTINCT ON (ameyo_user_id)
         contact_centre AS market, ameyo_user_id, team, atlas_user_name
  FROM raw_mapping
  ORDER BY ameyo_user_id, atlas_user_name, team, contact_centre)
"""

CODED = r"""
noted AS (
  SELECT *, regexp_extract(call_notes_raw, '^\s*([0-9]+)\s*$', 1) AS digits FROM stg_calls),
coded AS (
  SELECT c.* EXCLUDE (digits, system_disposition),
         try_cast(nullif(c.digits, '') AS BIGINT) AS candidate_call_log_id,
         d.call_log_id AS matched_call_log_id, d.contract_id AS matched_contract_id,
         d.disposed_at_utc AS matched_disposed_at_utc, d.call_log_id IS NOT NULL AS is_coded
  FROM noted c LEFT JOIN stg_dispositions d
    ON d.call_log_id = try_cast(nullif(c.digits, '') AS BIGINT))
"""

ATTRIBUTION = f"""
heads AS (
  SELECT contract_id, disposed_at_utc, max(call_log_id) AS call_log_id
  FROM stg_dispositions WHERE contract_id IS NOT NULL GROUP BY ALL),
paid AS (
  SELECT contract_id, pay_timestamp_utc, amount_local, min(currency) AS currency
  FROM stg_payments WHERE contract_id IS NOT NULL AND amount_local > 0 GROUP BY ALL),
owned AS (
  SELECT h.call_log_id, p.pay_timestamp_utc, p.currency, p.amount_local
  FROM paid p ASOF JOIN heads h
    ON p.contract_id = h.contract_id AND p.pay_timestamp_utc >= h.disposed_at_utc
  WHERE p.pay_timestamp_utc - h.disposed_at_utc <= INTERVAL 3 DAY),
attribution AS (
  SELECT {key_sql("d.call_log_id", "o.pay_timestamp_utc", "o.amount_local")} AS attribution_id,
         d.call_log_id, d.market, d.contract_id, d.disposed_at_utc,
         d.disposed_at_utc + INTERVAL 3 DAY AS window_closes_at_utc,
         d.disposed_at_utc + INTERVAL 3 DAY <= {fx.AS_OF_SQL} AS is_window_closed,
         o.pay_timestamp_utc, o.currency, o.amount_local,
         o.call_log_id IS NOT NULL AS is_paid_post_call
  FROM stg_dispositions d LEFT JOIN owned o USING (call_log_id)
  WHERE d.contract_id IS NOT NULL)
"""

FCT_CODING = f"""
fct_coding AS (
  SELECT {key_sql("call_date", "market", "campaign_name", "ameyo_user_id")} AS coding_rate_id,
         call_date, market, campaign_name, ameyo_user_id, m.atlas_user_name, m.team,
         total_calls, coded_calls, coded_calls::DOUBLE / total_calls AS coding_rate
  FROM (SELECT called_at_local::DATE AS call_date, market, campaign_name, ameyo_user_id,
               count(*) AS total_calls, count(*) FILTER (is_coded) AS coded_calls
        FROM coded GROUP BY ALL) AS g
       LEFT JOIN (SELECT ameyo_user_id, atlas_user_name, team FROM stg_mapping) AS m
         USING (ameyo_user_id))
"""

FCT_PAID = """
fct_paid AS (
  SELECT call_log_id, any_value(market) AS market, any_value(contract_id) AS contract_id,
         any_value(disposed_at_utc) AS disposed_at_utc,
         any_value(window_closes_at_utc) AS window_closes_at_utc,
         any_value(is_window_closed) AS is_window_closed,
         count(pay_timestamp_utc) > 0 AS is_paid_post_call,
         count(pay_timestamp_utc) AS attributed_payment_count
  FROM attribution GROUP BY call_log_id)
"""

FCT_VALUE = f"""
newest AS (
  SELECT currency, arg_max(local_units_per_usd, rate_date) AS rate, max(rate_date) AS rate_date
  FROM raw_fx GROUP BY currency),
fct_value AS (
  SELECT {key_sql("pay_timestamp_utc::DATE", "market")} AS value_recovered_id,
         pay_timestamp_utc::DATE AS call_date, market, max(rate_date) AS fx_rate_date_used,
         round(sum(amount_local / rate), 4) AS value_recovered_usd
  FROM attribution LEFT JOIN newest USING (currency)
  WHERE is_paid_post_call GROUP BY ALL)
"""

FCT_DRIVERS = f"""
hierarchy AS (
  SELECT call_log_id, market, disposed_at_utc, level_one, level_two, level_three
  FROM stg_dispositions WHERE call_type = 'Inbound Team'),
fct_drivers AS (
  SELECT {key_sql("call_date", "market", "level_one", "level_two", "level_three")} AS driver_id, *
  FROM (SELECT disposed_at_utc::DATE AS call_date, market, level_one, level_two, level_three,
               count(*) AS call_count
        FROM hierarchy GROUP BY ALL))
"""

CALLS = (fx.CALLS_SQL, STG_CALLS)
DISPOSITIONS = (fx.DISPOSITIONS_SQL, STG_DISPOSITIONS)
PAYMENTS = (fx.PAYMENTS_SQL, STG_PAYMENTS)
MAPPING = (fx.AGENT_MAPPING_SQL, STG_MAPPING)
ALL_CODED = (*CALLS, *DISPOSITIONS, CODED)
ALL_ATTRIBUTION = (*DISPOSITIONS, *PAYMENTS, ATTRIBUTION)
ALL_CODING = (*ALL_CODED, *MAPPING, FCT_CODING)
ALL_PAID = (*ALL_ATTRIBUTION, FCT_PAID)
ALL_VALUE = (*ALL_ATTRIBUTION, fx.FX_RATES_SQL, FCT_VALUE)
ALL_DRIVERS = (*DISPOSITIONS, FCT_DRIVERS)
