import pytest

from callscope.operators import quality


def test_checks(spark):
    df = spark.sql(
        "select * from values (1, 0.5D, 'a'), (1, 1.0D, null), (2, 0.0D, 'b'), (null, 1.5D, 'a'), "
        "(null, null, 'z') as t(k, r, s)"
    )
    found = {
        "unique": quality.unique("t", df, "k"),
        "not_null": quality.not_null("t", df, "k"),
        "range": quality.accepted_range("t", df, "r", 0, 1),
        "values": quality.accepted_values("t", df, "s", ["a", "b"]),
        "blank": quality.blank_share_at_most("t", df, "s", 0.1),
    }
    counts = {name: check.violations.count() for name, check in found.items()}
    assert counts == {"unique": 1, "not_null": 2, "range": 1, "values": 1, "blank": 1}
    assert quality.blank_share_at_most("t", df, "s", 0.2).violations.count() == 0
    with pytest.raises(quality.QualityError) as error:
        quality.run_checks(found.values())
    for part in ("unique(t.k): 1", "not_null(t.k): 2", "accepted_range(t.r): 1"):
        assert part in str(error.value)


def test_blank_share_of_nothing_passes(spark):
    empty = spark.sql("select cast(null as string) s where false")
    quality.run_checks([quality.blank_share_at_most("t", empty, "s", 0.0)])
