from tidelane.operators.regular_grid import regular_grid

SCHEMA = "src string, at long, reading double, o long"


def run(df, **options):
    out = regular_grid(df, ["src"], "at", value="reading", order="o", **options)
    return {(r.src, r.slot): (r.readings, r.value, r.status) for r in out.collect()}


def test_fills_within_the_gap_and_marks_the_rest(spark, crowded):
    rows = [("a", 2, 1.0, 1), ("a", 2, 5.0, 2), ("a", 7, 9.0, 3), ("b", 3, None, 1), ("b", 5, 2.0, 1), (None, 1, 1.0, 1), ("c", None, 1.0, 1), ("d", 4, 4.0, 4)]
    for block in (2, 3, 1000):
        got = run(crowded(spark.createDataFrame(rows, SCHEMA)), max_gap=2, block=block)
        assert got[("a", 2)] == (2, 5.0, "read")
        assert got[("a", 3)] == got[("a", 4)] == (0, 5.0, "filled")
        assert got[("a", 5)] == got[("a", 6)] == (0, None, "missing")
        assert got[("b", 3)] == (1, None, "read")
        assert got[("b", 4)] == (0, None, "missing")
        assert got[("d", 4)] == (1, 4.0, "read")
        assert len(got) == 6 + 3 + 1


def test_far_outlier_and_negative_slots(spark):
    got = run(spark.createDataFrame([("a", -5, 1.0, 0), ("a", 4000, 2.0, 0)], SCHEMA), block=64)
    assert len(got) == 4006
    assert got[("a", 3999)] == (0, 1.0, "filled")


def test_repeated_readings_and_empty(spark):
    got = run(spark.createDataFrame([("a", 1, 1.0, 0)] * 3, SCHEMA))
    assert got == {("a", 1): (3, 1.0, "read")}
    assert run(spark.createDataFrame([], SCHEMA)) == {}
