import duckdb
import pytest
from helpers import ODD, SMALL, documents, prose

from wayfare.llm import licenses, queries


def test_query_equals_its_statement(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    df = queries.op10_license_scan(spark, SMALL)
    assert sorted(map(tuple, df.collect())) == sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({licenses.SQL})").fetchall())


def test_every_template_anywhere_in_a_text(spark):
    names = sorted(licenses.TEMPLATES)
    rows = []
    for k, name in enumerate(names):
        for before in (0, 1, 7, 40, 1000):
            rows.append((10_000 * k + before, f"{prose(before, k)}\n{licenses.TEMPLATES[name].upper()} {prose(50, k)}"))
    found = {r["doc_id"]: r["licenses"] for r in licenses.scanned(documents(spark, rows)).collect()}
    for k, name in enumerate(names):
        for before in (0, 1, 7, 40, 1000):
            assert name in found[10_000 * k + before]


def test_share_of_a_template(spark):
    words = licenses.TEMPLATES["mit-permission"].split()
    rows = [(1, " ".join(words[:-3])), (2, " ".join(words[: len(words) // 2])), (3, " ".join(reversed(words))), (4, "All rights are reserved."), (5, "x all  RIGHTS\nreserved x")]
    found = {r["doc_id"]: r["licenses"] for r in licenses.scanned(documents(spark, rows)).collect()}
    assert found == {1: ["mit-permission"], 2: [], 3: [], 4: [], 5: ["all-rights-reserved"]}


def test_places_and_containment(spark):
    match = licenses.license_matches(documents(spark, [(1, prose(100) + " Released under the MIT License. " + prose(30))])).collect()
    assert [(r["template"], r["containment"]) for r in match] == [("mit-line", 1.0)] and 90 <= match[0]["word_start"] <= 100


def test_odd_rows(spark):
    docs = documents(spark, [*ODD, (None, "All rights reserved."), (None, "All rights reserved.")])
    rows = licenses.scanned(docs).collect()
    assert len(rows) == len(ODD) + 2 and sum(r["licenses"] == ["all-rights-reserved"] for r in rows) == 2
    assert licenses.scanned(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        licenses.license_matches(docs, {"short": "two words"})


def test_no_python_in_the_plan(spark):
    plan = licenses.scanned(documents(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "Cartesian" not in plan
