import hashlib
import re

import duckdb
from helpers import ODD, SMALL, documents, prose
from pyspark.sql import functions as F

from wayfare.llm import fillmiddle, queries

MARKED = [(20, "a <P> b"), (21, "x<S>"), (22, "<M>"), (23, "ends in <"), (24, "<S <P <M"), (25, ">>S> P>"), (26, "$1 \\ $2 ${x}\n"), (27, "  \n lead and trail \t ")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    """(n, form, output, prefix, middle) by a list of units."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    n = len(units)
    if doc_id is None:
        return n, "plain", text, None, None
    h = [int(sha(f"42:{doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", text, None, None
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return n, form, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_query_equals_its_statement(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    df = queries.op13_fill_in_middle(spark, SMALL)
    listed = ", ".join(df.columns)
    got = df.collect()
    assert sorted(map(tuple, got)) == sorted(duck.execute(f"SELECT {listed} FROM ({fillmiddle.SQL})").fetchall())
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_parts_of_odd_and_marked_rows(spark):
    rows = [*ODD, *MARKED, *((100 + i, text) for i in range(12) for _, text in MARKED[3:]), *((300 + i, prose(i)) for i in range(40))]
    out = fillmiddle.rearranged(documents(spark, rows))
    got = sorted(((r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, *brute(i, t)) for i, t, *_ in rows), key=repr)
    back = out.select("doc_id", fillmiddle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t, *_ in rows), key=repr)
    assert fillmiddle.rearranged(documents(spark, [])).collect() == []


def test_very_long_texts_need_no_stack(spark):
    rows = [(i, "word " * 300_000 + "é" * 1_000_000 + " " * 200_000) for i in range(6)]
    got = fillmiddle.digests(documents(spark, rows)).collect()
    assert {r["restored_sha256"] for r in got} == {sha(rows[0][1])} and {r["n"] for r in got} == {300_002}
    assert {(r["doc_id"], r["output_sha256"]) for r in got} == {(i, sha(brute(i, t)[2])) for i, t in rows}


def test_no_python_in_the_plan(spark):
    plan = fillmiddle.digests(documents(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
