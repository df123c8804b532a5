import json

import pytest

from tallyguard.operators import designs
from tallyguard.sources.payloads import unwrap_rows


def rows_of(spark, payloads, **extra):
    data = [
        {"pos": n, "payload": p if isinstance(p, str) else json.dumps(p), **extra}
        for n, p in enumerate(payloads)
    ]
    names = ", ".join(f"{name} string" for name in extra)
    schema = "pos long, payload string" + (f", {names}" if names else "")
    return unwrap_rows(spark.createDataFrame(data, schema))


def test_envelopes(spark):
    rows = rows_of(
        spark,
        [[{"id": 1}], {"rows": [{"id": 2}, {"id": 3}]}, {"other": []}, "broken{", {"rows": 5}, []],
    )
    assert sorted((r.pos, r.row_index, r.row["id"]) for r in rows.collect()) == [
        (0, 0, "1"),
        (1, 0, "2"),
        (1, 1, "3"),
    ]


def test_types_are_complete_and_first_wins(spark):
    rows = rows_of(
        spark,
        [
            [
                {"DocumentDesignTypeID": 1, "Name": "first"},
                {"id": "1", "name": "second"},
                {"Id": 2, "DocumentDesignName": "", "name": "shadowed"},
                {"id": 3, "name": "  "},
                {"name": "no id"},
                {"id": None, "Id": 4, "displayText": " kept "},
            ]
        ],
    )
    got = {(r.id, r.name) for r in designs.dedup_design_types(rows).collect()}
    assert got == {("1", "first"), ("4", " kept ")}


def test_distinct_names_keep_first_place(spark):
    rows = rows_of(
        spark,
        [[{"FormDesignName": "b"}, {"formDesignName": "a"}], [{"DocumentDesignName": "b"}, {"x": 1}]],
    )
    got = {(r.name, r.pos, r.row_index) for r in designs.distinct_design_names(rows).collect()}
    assert got == {("b", 0, 0), ("a", 0, 1)}


@pytest.mark.parametrize(("term", "ids"), [("", {"1", "2", "3"}), (" AB ", {"1"}), ("%", {"2"})])
def test_folder_search(spark, term, ids):
    rows = rows_of(
        spark,
        [[{"FormGroupId": 1, "FormDesignGroupName": "xAbx"}, {"id": 2, "name": "50%"}, {"id": 3}]],
    )
    got = designs.folder_search(designs.folders(rows), term).collect()
    assert {r.folder_id for r in got} == ids


def test_folder_mappings(spark):
    folders = designs.folders(rows_of(spark, [[{"FormGroupId": 7, "name": "F"}]]))
    details = rows_of(
        spark,
        [
            [
                {"FormDesignName": "one", "AllowMultipleInstance": False, "MultipleInstance": True},
                {"documentDesignName": "two", "isMultipleInstance": True, "IsIncluded": None,
                 "include": True, "Abbreviation": "T"},
            ]
        ],
        folder_id="7",
    )
    got = {
        (r.design_name, r.abbreviation, r.multiple_instance, r.include)
        for r in designs.folder_mappings(folders, details).collect()
    }
    assert got == {("one", "", "No", "No"), ("two", "T", "Yes", "Yes")}


GRID = list(designs.GRID_FIELDS.values())


@pytest.fixture(scope="module")
def grid(spark):
    rows = [
        (1, "Alpha", "d", "Doc_1", 10, "v1", "Final", 1, " Complete ", "2024-01-02T08:00:00",
         "2024-01-03T09:10:11", None, "ann"),
        (2, None, "d", "100%", 20, "v2", "Draft", 2, "Errored", None, "", "boom", "bob"),
        (3, "beta", "d", "Docx1", 30, "v1", None, 3, "complete", "oops", None, None, None),
    ]
    kinds = "long string string string long string string long string string string string string"
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(GRID, kinds.split(), strict=True))
    return designs.rename_grid(spark.createDataFrame(rows, schema))


@pytest.mark.parametrize(
    ("filters", "ids"),
    [
        ({}, [1, 2, 3]),
        ({"formName": "A"}, [1, 3]),
        ({"documentDesignName": "c_1"}, [1]),
        ({"documentDesignName": "%"}, [2]),
        ({"compiledStatus": " COMPLETE"}, [1, 3]),
        ({"formName": "a ", "status": ""}, []),
        ({"versionNumber": "V1", "effectiveDate": "2024"}, [1]),
    ],
)
def test_grid_filter(grid, filters, ids):
    assert sorted(r.formID for r in designs.grid_filter(grid, filters).collect()) == ids


def test_grid_filter_refuses_unknown_columns(grid):
    with pytest.raises(ValueError, match="formID"):
        designs.grid_filter(grid, {"formID": "1"})


def test_grid_projection(grid):
    by_id = {r.formID: r for r in designs.grid_projection(grid).collect()}
    assert by_id[1].effectiveDate == "2024-01-02"
    assert by_id[1].compiledDate == "2024-01-03 09:10:11"
    assert by_id[2].effectiveDate == "N/A" and by_id[2].compiledDate == "N/A"
    assert by_id[3].effectiveDate == "Invalid Date"
    assert [by_id[n].compiledGroup for n in (1, 2, 3)] == [None, "error", None]
    assert by_id[2].formName == "" and by_id[2].hasError == "Yes"


def test_select_by_keys(spark, grid):
    chosen = spark.createDataFrame([(3,), (3,), (9,)], "formID long")
    assert [r.formID for r in designs.select_by_keys(grid, chosen).collect()] == [3]
