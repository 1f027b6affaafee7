import pytest

from callscope.plans import staging


def test_calls(spark, at):
    raw = spark.createDataFrame(
        [
            ("1", "2024-01-05 23:59:59", "1", "done", "out", "1000", "u1", "c", " 12 ", "f", "t"),
            ("2", "2024-01-06 00:00:00", "9", None, None, None, None, None, "   ", "f", "t"),
        ],
        "ch_call_id string, ch_date_added string, ch_contact_center_id string, "
        "ch_system_disposition string, ch_call_type string, total_talk_time string, "
        "udh_user_id string, campaign_name string, udh_notes string, "
        "_ab_source_file_url string, _airbyte_extracted_at string",
    )
    first, second = staging.stg_calls(raw).collect()
    assert first["called_at_local"] == at("2024-01-05 23:59:59")
    assert (first["call_id"], first["market"], first["talk_time_ms"]) == (1, "Kenya", 1000)
    assert first["call_notes_raw"] == "12"
    assert (first["_source_file"], first["_loaded_at"]) == ("f", "t")
    assert second["market"] is None and second["call_notes_raw"] is None


def test_bad_cast_fails(spark):
    raw = spark.createDataFrame(
        [("x", "1001", "5", "2024-01-01", "p", "q")],
        "pay_timestamp_utc string, tenant_id string, contract_id string, amount string, "
        "payment_request_provider string, create_program string",
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_payments(raw).collect()


def test_dispositions_blank_levels(spark):
    raw = spark.createDataFrame(
        [(1, 1002, 7, 5, "2024-01-01 10:00:00", "a", "Inbound Team", " ", " ", "")],
        "call_log_id int, tenant_id int, customer_id int, contract_id int, "
        "created_timestamp_utc string, createdby string, call_type string, "
        "level_one string, level_two string, level_three string",
    )
    row = staging.stg_dispositions(raw).head()
    assert (row["level_one"], row["level_two"], row["level_three"]) == (" ", None, None)
    assert (row["market"], row["customer_id"]) == ("Uganda", "7")


def test_agent_mapping_keeps_first_name_then_team(spark):
    raw = spark.createDataFrame(
        [
            ("K", "1", "B", "ann"),
            ("K", "1", "B", "ann"),
            ("K", "2", "Z", "bob"),
            ("K", "2", "A", "bob"),
            ("K", "3", "A", "dan"),
            ("K", "3", "T", "cat"),
            ("K", "4", "T", None),
            ("K", "4", "U", "eve"),
            ("K", None, "U", "fay"),
        ],
        "contact_centre string, ameyo_user_id string, team string, atlas_user_name string",
    )
    got = {
        r["ameyo_user_id"]: (r["atlas_user_name"], r["team"])
        for r in staging.stg_agent_mapping(raw).collect()
    }
    assert got == {
        "1": ("ann", "B"),
        "2": ("bob", "A"),
        "3": ("cat", "T"),
        "4": ("eve", "U"),
        None: ("fay", "U"),
    }
