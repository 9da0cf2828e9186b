import re

import duckdb
from helpers import ODD, SMALL, documents, prose

from wayfare.llm import linededup, queries


def words(line):
    return tuple(w for w in re.split(r"[\x20\x09-\x0d]+", line) if w)


def alike(a, b, least=linededup.MIN_WORDS):
    """Equal, or one word edit apart if both are long enough, by the usual table of edit distances."""
    if a == b:
        return True
    if min(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= 1


def brute(rows):
    """Cleaned texts of distinct ids, comparing each line with all earlier ones."""
    earlier, out = [], {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            w = words(line)
            if not w or not any(alike(w, e) for e in earlier):
                kept.append(line)
            if w:
                earlier.append(w)
        out[doc_id] = "\n".join(kept) if text is not None else None
    return out


def test_query_equals_its_statement(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    df = queries.op4_line_dedup(spark, SMALL)
    listed = ", ".join(df.columns)
    assert sorted(map(tuple, df.collect())) == sorted(duck.execute(f"SELECT {listed} FROM ({linededup.SQL})").fetchall())


def test_every_edit_and_its_limits(spark):
    base = prose(12, 1)
    w = base.split()
    rows = [
        (1, base + "\nshort line here"), (2, " ".join(["first", *w]) + "\nshort line there\nshort  line\there"), (3, " ".join(w[:-1])), (4, " ".join([*w[:5], "new", *w[6:]])),
        (5, " ".join([*w[:5], "new", "two", *w[7:]])), (6, " ".join([w[1], w[0], *w[2:]])), (7, " ".join(w[:4] + w[5:])), (8, " ".join([*w, "x", "y"])),
        (9, " ".join(w[:7])), (10, " ".join([*w[:6], "in", *w[6:]])), (11, "a b a b a b a b a b\nb a b a b a b a b a\na b a b a b a b a b a"), (12, "\n \n\n"), (13, base.upper()),
        (14, " ".join(w[:8])), (15, " ".join(w[1:8])), (16, " ".join(["x", *w[1:8]])), (17, prose(4000, 7)), (18, prose(4000, 7) + " end"),
    ]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_numbered_lines_and_a_line_in_every_document(spark):
    base = prose(9, 3)
    rows = [(i, f"{base} {i}\ncommon line of all documents that is the same everywhere\nown {prose(10, 50 + i)}") for i in range(120)]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.dedup_lines(documents(spark, rows)).collect()}
    assert {k: v[0] for k, v in got.items()} == brute(rows)
    assert got[0][1:] == (3, 0) and got[7][1:] == (3, 2)


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    out = linededup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"] and out.count() == len(ODD)
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {(1, None), (2, ""), (3, " \n\t "), (None, ODD[0][1]), (5, prose(300)), (6, "")} <= texts
    assert linededup.dedup_lines(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = linededup.dedup_lines(documents(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "Cartesian" not in plan
