"""The two parts of the live ratings hold all rows."""

from reelrank.catalog.registry import Inputs


def test_early_and_late_hold_rows_without_a_day(spark):
    class Given(Inputs):
        def stream(self):
            days = "(DATE'2024-01-15'), (DATE'2024-01-16'), (NULL)"
            return spark.sql(f"SELECT * FROM VALUES {days} AS t(batch_day)")

    given = Given(spark, "")
    assert (given.early().count(), given.late().count()) == (2, 1)
