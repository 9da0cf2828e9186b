import re
from collections import Counter

import duckdb
from helpers import ODD, SMALL, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import queries, rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\r\x0b\x1c\x85#|é😀"), max_size=80))
def test_measures(text):
    assert rules.measure(text) == brute(text)


def test_query_equals_its_statement(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    df = queries.op7_host_quality_rules(spark, SMALL)
    assert sorted(map(tuple, df.collect())) == sorted(duck.execute(f"SELECT {', '.join(df.columns)} FROM ({rules.SQL})").fetchall())


def test_a_bad_host_goes_and_a_small_unlucky_one_stays(spark):
    good = [(i, prose(60, i), f"host{i % 8}") for i in range(400)]
    bad = [(1000 + i, "## " * 30 + prose(60, i), "bad") for i in range(60)] + [(2000, prose(60, 1), "bad")]
    unlucky = [(3000, "## " * 30 + prose(60, 2), "one"), (3001, prose(60, 3), "one")]
    docs = documents(spark, [*good, *bad, *unlucky, (4000, prose(60), None), (4001, "few", "host1")])
    kept = {r["doc_id"]: r["kept"] for r in rules.judged(docs).collect()}
    assert kept == {i: True for i in range(400)} | {1000 + i: False for i in range(60)} | {2000: False, 3000: True, 3001: True, 4000: True, 4001: False}
    left = rules.kept_documents(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {k for k, v in kept.items() if v}


def test_prior_strength():
    assert rules.strength(0.5, 0.0, 0.01) == 1e6 and rules.strength(0.0, 0.1, 0.01) == 1e6
    assert rules.strength(0.5, 0.24, 0.0) == 1.0 and abs(rules.strength(0.5, 0.05, 0.0) - 4) < 1e-9


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    rows = rules.judged(docs).collect()
    assert len(rows) == len(ODD)
    assert sorted((r["doc_id"] or 0, r["n_words"], r["base_failed"]) for r in rows) == sorted((d or 0, brute(t)[0], brute(t)[0] < 50 or 2 * brute(t)[4] > brute(t)[0]) for d, t in ODD)
    assert rules.judged(documents(spark, [])).collect() == [] and rules.kept_documents(documents(spark, [])).collect() == []
