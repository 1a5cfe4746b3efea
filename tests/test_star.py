"""Invoice lines from a star schema of its own rows."""

import datetime

from conftest import rows_of

from tillroll.sources import star


def test_part_text_is_made_before_the_join(spark, tmp_path):
    day = datetime.datetime(2011, 2, 3, 10, 15)
    tables = {
        "lineitem": [(1, 97, 1, 4.0, "R"), (1, 97, 2, 5.0, "N"), (1, 5, 7, 1.0, "N"), (1, None, 3, 1.0, "N"),
                     (1, 8, 4, 2.0, None)],
        "orders": [(1, 14, day)], "customer": [(14, 1)], "nation": [(1,)],
        "part": [(97, "red ring"), (5, "gear"), (5, None), (None, "bolt"), (8, "")]}
    for name, rows in tables.items():
        spark.createDataFrame(rows, star._SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = star.retail_lines(spark, str(tmp_path))
    date, customer = "03/02/2011 10:15:00", str(14 * 7919 % 30000)
    assert rows_of(lines) == sorted([
        ("C536366", "00097A", " RED HEART ", "4", date, "1.42", customer, "France"),
        ("536366", "00097A", " RED HEART ", "5", date, "1.42", customer, "France"),
        ("536366", "00005", " CLOCK ", None, date, "0.0", customer, "France"),
        ("536366", "00005", None, None, date, "0.0", customer, "France"),
        ("536366", "00008", "  ", "2", date, "0.53", customer, "France")], key=repr)
    plan = lines._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "upper" not in plan and "lpad" not in plan
