"""Many inputs, each a set of tables: the result is that of a run for each input."""

import pytest

from rulecheck import InputSets, TableSet, run_kpi, run_kpi_inputs
from rulecheck.sources.tables import FILE

RULES = {
    "sheetlist": ["sales", "book", "extra"],
    "sheetvalidation": {"sales": {"fields": [{"name": "Key"}, {"name": "note"}]}},
    "dataqualityvalidation": {
        "duplicatecheck": [{"name": "dup", "sheetname": "sales", "columns": ["key"]}],
        "nullcheck": [{"name": "nulls", "sheetname": "sales", "columns": ["key", "amount"]}],
        "numericprecision": []},
    "formulavalidation": [{"name": "sum", "sheetname": "sales", "leftformula": "amount", "rightformula": "paid", "operator": "==", "threshold": 0}],
    "businessrulevalidation": [{"name": "look", "sheetname": "sales", "type": "lookupmatch", "lookupsheet": "book", "lookupkeyleft": "key",
                                "lookupkeyright": "key", "leftcolumn": "label", "rightcolumn": "label"},
                               {"name": "late", "sheetname": "sales", "type": "staledata", "column": "day", "months": 6}],
    "reconciliationvalidation": [{"name": "rec", "sourcesheet": "sales", "targetsheet": "book", "matchcolumns": ["key"], "sourcecolumn": "amount",
                                  "targetcolumn": "total", "distinctcolumn": d} for d in ("key", "amount", "none")],
    "crosssheetvalidation": [{"name": "first", "sourcesheet": "sales", "targetsheet": "book", "matchcolumn": "key", "sourcecolumn": "label",
                              "targetcolumn": "label", "validationtype": "valuecomparison", "dropnullkeys": n} for n in (True, False)]
                            + [{"name": "keys", "sourcesheet": "sales", "targetsheet": "book", "matchcolumn": "key", "validationtype": "existencecheck"}],
    "trendvalidation": [{"name": "up", "sheet": "sales", "metric": "amount", "previousmetric": "paid", "operator": ">", "threshold": 10,
                         "aggregate": True, "groupbycolumns": ["key", "month"]}],
}
HEAD, BOOK = "key,month,amount,paid,label,day\n", "key,total,label\n"
INPUTS = {
    "north +1": {"sales": HEAD + "1,1,10,10,a,2024-01-05\n1,2,20,20,b,2026-05-01\n2,1,5,6,c,2026-05-02\n,1,3,3,d,2026-05-02\n", "book": BOOK + "1,30,a\n2,9,c\n3,1,z\n"},
    "south": {"sales": HEAD + "1,1,7,7,q,2026-05-01\n1,2,7,7,a,2026-05-01\n", "book": BOOK + "1,14,q\n4,0,\n"},
    "no book": {"sales": HEAD + "1,1,7,7,a,2026-05-01\n"},
    "more": {"sales": HEAD.strip() + ",note\n9,1,1,1,a,2026-05-01,x\n", "book": BOOK + "9,1,a\n", "extra": "x\n1\n"},
    "nothing": {},
}


@pytest.fixture()
def folder(tmp_path):
    for name, tables in INPUTS.items():
        (tmp_path / "in" / name).mkdir(parents=True)
        for t, text in tables.items():
            (tmp_path / "in" / name / f"{t}.csv").write_text(text)
    return str(tmp_path / "in")


def _rows(df, name=None):
    return sorted((r["sheet_name"], r["field"], r["test_type"], r["test_name"], r["status"], r["failed_count"])
                  for r in df.collect() if name is None or r["source_file"] == name)


def test_each_input_as_by_itself(spark, folder):
    sets = InputSets.from_dir(spark, folder)
    assert len(sets.groups) == 4  # north and south are alike
    got = run_kpi_inputs(sets, RULES, as_of="2026-06-08").summary
    got = spark.createDataFrame(got.collect(), got.schema)
    assert {r["source_file"] for r in got.collect()} == set(INPUTS)
    assert not [r for r in _rows(got, "north +1") if r[2] == "Configuration Validation"]
    for name in INPUTS:
        alone = TableSet.from_dir(spark, f"{folder}/{name}")
        assert _rows(got, name) == _rows(run_kpi(alone, RULES, as_of="2026-06-08").summary), name


def test_inputs_in_common_tables(spark):
    """An input without rows in a table has that table, empty; rows without an input belong to none."""
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("b", 1, 7), (None, 1, 99)], "run string, key int, amount int")
    right = spark.createDataFrame([("a", 1, 10), ("c", 3, 4)], "run string, key int, total int")
    sets = InputSets.from_frames(spark, {"sales": left, "book": right}, "run")
    rule = {"name": "rec", "sourcesheet": "sales", "targetsheet": "book", "matchcolumns": ["key"], "sourcecolumn": "amount",
            "targetcolumn": "total", "distinctcolumn": "key"}
    out = run_kpi_inputs(sets, {"reconciliationvalidation": [rule], "sheetlist": ["book"]}).summary.filter("test_name <> 'Configuration Validation'")
    assert {(r["source_file"], r["failed_count"]) for r in out.collect() if r["field"] == "rec"} == {("a", 1), ("b", 1), ("c", 1)}
    assert {(r["source_file"], r["status"]) for r in out.collect() if r["field"] == "Sheet"} == {("a", "P"), ("b", "P"), ("c", "P")}
    empty = InputSets.from_frames(spark, {"sales": left.limit(0), "book": right.limit(0)}, "run")
    assert run_kpi_inputs(empty, {"reconciliationvalidation": [rule]}).summary.count() == 0
    assert FILE not in sets.groups[0].tables.get("sales").columns


def test_schemas_given_no_column_is_read(spark, folder):
    told = {"sales": "key int, month int, amount int, paid int, label string, day string, note string", "book": "key int, total int, label string", "extra": "x int"}
    sets = InputSets.from_dir(spark, folder, schemas=told)
    assert sorted(sorted(g.tables.names) for g in sets.groups) == [[], ["book", "extra", "sales"], ["book", "sales"], ["sales"]]
    group = next(g for g in sets.groups if g.tables.names == ["book", "sales"])
    assert {r["source_file"] for r in group.inputs.collect()} == {"north +1", "south"}
    marked = {r[FILE] for r in group.tables.get("sales").df.select(FILE).distinct().collect()}
    assert marked == {"north +1", "south"}
