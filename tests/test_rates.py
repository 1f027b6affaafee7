from datetime import date, datetime

import pytest
import raw_files as rf

from callscope.operators import quality
from callscope.operators.rates import known_rates, latest_rates, price_nearest
from callscope.plans import daily, marts
from callscope.sources import fx
from callscope.sources.tables import Tables

NOW = datetime(2024, 1, 5, 6)



def load(spark, folder, body, at=NOW):
    tables = Tables(spark, f"{folder}/out")
    fx.load_payload(tables, rf.write_text(f"{folder}/fx/latest.json", body), at)
    return tables


def test_keeps_the_four_currencies(spark, folder):
    rows = fx.read_rates(load(spark, folder, rf.FX)).collect()
    assert {r["currency"]: r["local_units_per_usd"] for r in rows} == {
        "KES": 100.0, "UGX": 1.0, "TZS": 1.0, "NGN": 1.0,
    }
    assert {(r["rate_date"], r["fetched_at"], r["source"]) for r in rows} == {
        (date(2024, 1, 5), NOW, "exchangerate-api.com")
    }


@pytest.mark.parametrize(
    ("body", "message"),
    [
        ('{"result": "error", "error-type": "quota"}', "did not answer with success"),
        ("not json", "did not answer with success"),
        ('{"result": "success"}', "holds no rates"),
        (
            '{"result": "success", "conversion_rates": {"KES": 1.0}}',
            "no rate for UGX, TZS, NGN",
        ),
        (rf.FX.replace("100.0", "0.0"), "not above zero"),
    ],
)
def test_unusable_payload_fails(spark, folder, body, message):
    with pytest.raises(fx.FxPayloadError, match=message):
        load(spark, folder, body)


def test_second_load_of_a_day_replaces_it(spark, folder):
    load(spark, folder, rf.FX)
    load(spark, folder, rf.FX, datetime(2024, 1, 6))
    tables = load(spark, folder, rf.FX.replace("100.0", "200.0"))
    rates = {
        (str(r["rate_date"]), r["local_units_per_usd"])
        for r in fx.read_rates(tables).filter("currency = 'KES'").collect()
    }
    assert rates == {("2024-01-05", 200.0), ("2024-01-06", 100.0)}
    assert fx.read_rates(tables).count() == 8


RATES = [(2, "KES", 2.0), (5, "KES", 5.0), (20, "KES", 20.0), (9, "UGX", 9.0)]


def rates(spark):
    return spark.createDataFrame(
        [(date(2024, 1, d), c, v) for d, c, v in RATES],
        "rate_date date, currency string, local_units_per_usd double",
    )


def test_latest(spark):
    got = {r["currency"]: r["local_units_per_usd"] for r in latest_rates(rates(spark)).collect()}
    assert got == {"KES": 20.0, "UGX": 9.0}


def test_nearest_prefers_the_earlier_of_two(spark):
    days = [1, 2, 3, 4, 5, 12, 13, 31]
    amounts = spark.createDataFrame(
        [(date(2024, 1, d), "Kenya", "KES", 1.0) for d in days] + [(date(2024, 1, 1), "x", None, 1.0)],
        "call_date date, market string, currency string, amount_local double",
    )
    got = {
        r["call_date"].day: r["local_units_per_usd"]
        for r in price_nearest(amounts, rates(spark)).filter("currency = 'KES'").collect()
    }
    assert got == {1: 2.0, 2: 2.0, 3: 2.0, 4: 5.0, 5: 5.0, 12: 5.0, 13: 20.0, 31: 20.0}
    unknown = price_nearest(amounts, rates(spark)).filter("currency is null").collect()
    assert [r["local_units_per_usd"] for r in unknown] == [None]


def test_payment_without_rate_fails(spark):
    attribution = spark.createDataFrame(
        [("Kenya", datetime(2024, 1, 5), "KES", 1.0), ("Kenya", datetime(2024, 1, 5), None, 1.0)],
        "market string, pay_timestamp_utc timestamp_ntz, currency string, amount_local double",
    )
    priced = marts.priced_payments(attribution, rates(spark))
    assert quality.missing_rates(priced).count() == 1
    with pytest.raises(quality.QualityError, match="rate for every attributed payment"):
        quality.require_rates(priced)
    assert marts.value_by_day(priced).head()["value_recovered_usd"] == 1 / 20


def test_known_rates_by_both_times(spark):
    versions = spark.sql(
        "select date(d) as rate_date, c as currency, r as local_units_per_usd, cast(f as timestamp_ntz) as fetched_at"
        " from values ('2024-01-01', 'KES', 1.0D, '2024-01-01 06:00:00'), ('2024-01-01', 'KES', 2.0D, '2024-01-03 06:00:00'),"
        " ('2024-01-02', 'KES', 3.0D, '2024-01-02 06:00:00'), ('2024-01-02', 'UGX', 9.0D, null),"
        " ('2024-01-01', 'KES', 1.5D, '2024-01-01 06:00:00') t(d, c, r, f)"
    )

    def known(at):
        rows = known_rates(versions, datetime.fromisoformat(at)).collect()
        return sorted((r["rate_date"].day, r["currency"], r["local_units_per_usd"]) for r in rows)

    assert known("2024-01-01 05:59:59") == []
    assert known("2024-01-01 06:00:00") == [(1, "KES", 1.5)]
    assert known("2024-01-02 23:00:00") == [(1, "KES", 1.5), (2, "KES", 3.0)]
    assert known("2024-02-01 00:00:00") == [(1, "KES", 2.0), (2, "KES", 3.0)]
    assert known_rates(versions, datetime(2024, 1, 1, 6)).columns == versions.columns


def test_versions_are_kept_and_replayed_loads_change_nothing(spark, folder):
    tables = Tables(spark, folder)

    def load(rate, fetched):
        row = spark.sql(f"select date '2024-01-01' as rate_date, 'KES' as currency, {rate}D as local_units_per_usd,"
                        f" timestamp_ntz '{fetched}' as fetched_at, 's' as source")
        fx.upsert_rates(tables, row)

    def rate(*known_at):
        return [r["local_units_per_usd"] for r in fx.read_rates(tables, *known_at).collect()]

    load(1.0, "2024-01-01 06:00:00")
    for _ in range(2):
        load(2.0, "2024-01-05 06:00:00.123456")
    assert tables.read("raw", "fx_rate_versions").count() == 2
    assert (rate(), rate(datetime(2024, 1, 4)), rate(datetime(2024, 1, 6))) == ([2.0], [1.0], [2.0])
    assert rate(datetime(2023, 1, 1)) == []


def test_rerun_for_an_old_day_prices_as_then(spark, folder):
    rf.write_day(
        f"{folder}/raw",
        "2024-01-05",
        dispositions=[rf.disposition(1, 10, "2024-01-05 10:00:00")],
        payments=[rf.payment(10, "2024-01-05 11:00:00", 50)],
    )
    cheap = rf.write_text(f"{folder}/fx/later.json", rf.FX.replace("100.0", "25.0"))

    def run(at, **options):
        daily.run_daily(spark, f"{folder}/raw", f"{folder}/out", datetime.fromisoformat(at), **options)
        (row,) = Tables(spark, f"{folder}/out").read(*daily.VALUE).collect()
        return row["value_recovered_usd"]

    assert run("2024-01-05 23:00", fx_payload=rf.write_text(f"{folder}/fx/first.json", rf.FX)) == 0.5
    assert run("2024-01-07 23:00", fx_payload=cheap) == 2.0
    assert run("2024-01-06 23:00", rates_as_known=True) == 0.5
    assert run("2024-01-06 23:00") == 2.0
