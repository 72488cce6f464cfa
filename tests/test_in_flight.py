import pytest

from tablewarden.operators import evaluate as ev
from tablewarden.operators import in_flight, quarantine
from tablewarden.operators.rules import Rule
from tablewarden.session import new_path

RULES = [
    Rule("A", "positive", "t", "accuracy", violation="x <= 0", min_pass_pct=50),
    Rule("B", "named", "t", "completeness", violation="diverted IS NULL"),
    Rule("C", "idle", "t", "accuracy", violation="true", active=False),
    Rule("D", "unknown", "t", "accuracy", violation="CAST(NULL AS boolean)"),
]
SCHEMA = "x int, diverted string"  # the name of the folder column


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("rows", [[(1, "a"), (0, "a"), (-1, None), (None, None), (None, "b"), (1, "a")], [(1, "a")], [(0, None)], []])
def test_counts_of_a_write_equal_a_scan(spark, frame, rows):
    df, active = frame(rows, SCHEMA), [r for r in RULES if r.active]
    written = in_flight.write_split(df, RULES, new_path(spark, "split"))
    assert rows_of(written.run_row_counts(spark)) == rows_of(ev.run_row_counts(df, active))
    clean, bad = quarantine.split(df, active)
    assert rows_of(written.clean(spark)) == rows_of(clean) and rows_of(written.diverted(spark)) == rows_of(bad)
    got = written.results(spark, RULES, run_id="r", as_of="2024-01-01 00:00:00")
    want = ev.evaluate_tables({"t": df}, RULES, run_id="r", as_of="2024-01-01 00:00:00").select(got.columns)
    assert rows_of(got) == rows_of(want)


def test_the_input_is_read_once(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).selectExpr("CAST(id AS int) AS x", "'a' AS diverted").mapInArrow(counted, SCHEMA)
    written = in_flight.write_split(df, RULES, new_path(spark, "split"))
    assert written.counts == {"records_in": 100, "records_out": 99, "records_diverted": 1} and seen.value == 100


def test_other_rules_are_refused(spark, frame):
    with pytest.raises(ValueError, match="row rules"):
        in_flight.write_split(frame([], SCHEMA), [Rule("K", "key", "t", "uniqueness", key=("x",))], "/nowhere")
