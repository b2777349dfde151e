import datetime as dt

import pytest
from helpers import rows, vocabulary

from medloom.operators import terminology as V
from medloom.plans import csv_cdm as P


@pytest.mark.parametrize(
    ("version", "start", "end", "want"),
    [
        ("2.7.0", "2001", "2003", (dt.date(2001, 1, 1), dt.date(2003, 12, 31))),
        ("3.0.0", "2001-02-03T00:00:00Z", "2003-04-05T00:00:00Z", (dt.date(2001, 2, 3), dt.date(2003, 4, 5))),
    ],
)
def test_payer_periods_of_older_exports(spark, version, start, end, want):
    tables = {
        "patients": spark.createDataFrame([("p", "M"), ("q", None)], "id string, gender string"),
        "payers": spark.createDataFrame([("y", "Payer")], "id string, name string"),
        "payer_transitions": spark.createDataFrame(
            [("p", "y", start, end), ("q", "y", start, end)],
            "patient string, payer string, start_year string, end_year string",
        ),
    }
    df = P.payer_plan_period(P.Sources(tables, vocabulary(spark), version=version))
    assert rows(df, "payer_plan_period_start_date", "payer_plan_period_end_date") == [want]


def test_listed_value_sets(spark):
    vocab = vocabulary(spark)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vocab.concept.schema)
    extra = [
        (8527, "White", "Race", "Race", "Race", "S", "5", None, None, None),
        (1, "Odd", "Race", "Race", "Race", "S", "9", None, None, None),
        (38003563, "Hispanic", "Ethnicity", "Ethnicity", "Ethnicity", "S", "H", None, None, None),
        (38003564, "Old", "Ethnicity", "Ethnicity", "Ethnicity", None, "N", None, None, None),
    ]
    vocab.concept = vocab.concept.unionByName(spark.createDataFrame(extra, columns))
    assert rows(V.race_value_set(vocab), "code", "display") == [("8527", "White")]
    assert rows(V.ethnicity_value_set(vocab), "code", "display") == [("38003563", "Hispanic")]
