import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from helpers import ODD, PATH, documents, prose
from pyspark.sql import functions as F
from test_linededup import brute as clean_lines
from test_neardup import brute as near_duplicates
from test_rules import brute as measures

from wayfare.llm import classifier
from wayfare.llm.bpe import library_ids
from wayfare.llm.common import table

DATA = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force_over_what_the_one_before_kept(spark):
    docs = table(spark, DATA, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = {r["doc_id"]: r for r in docs.collect()}
        out = corpus_pipeline.staged(stage(spark, docs, DATA), "test-stage")
        got = {r["doc_id"]: r for r in out.collect()}
        assert out.columns == columns and out.count() == len(got)
        if name == "quality rules":  # no host of these tables is rejected
            found = {k: measures(r["text"]) for k, r in given.items()}
            assert set(got) == {k for k, m in found.items() if m[0] >= 50 and 2 * m[4] <= m[0]}
        elif name == "quality classifier":
            scores = {r["doc_id"]: r["score"] for r in classifier.with_scores(docs, table(spark, DATA, "labels")).collect()}
            assert set(got) == {k for k, s in scores.items() if s >= classifier.KEEP_FROM}
        elif name == "line dedup":
            cleaned = clean_lines([(k, r["text"]) for k, r in given.items()])
            assert {k: r["text"] for k, r in got.items()} == {k: t for k, t in cleaned.items() if re.search(r"[^\x20\x09-\x0D]", t)}
            assert all(r["n_chars"] == len(r["text"]) for r in got.values())
        else:
            assert set(got) == {k for k, v in near_duplicates([(k, r["text"]) for k, r in given.items()], 80).items() if v[2]}
        docs = out
    packed = Counter()
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect():
        packed[r["doc_id"]] += r["length"]
    assert packed == {r["doc_id"]: len(library_ids(r["text"], PATH)) + 1 for r in docs.collect()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    filled = Counter()
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert rows and max(filled.values()) <= 2048
    texts = {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}
    whole = [r for r in rows if r["start"] == 0 and "\n" not in texts[r["doc_id"]]][:20]
    for r in whole:
        ids = np.append(library_ids(texts[r["doc_id"]], PATH).astype("<u4"), np.uint32(0))
        assert r["ids_crc32"] == zlib.crc32(ids[: r["length"]].tobytes())


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_stand_odd_rows(spark, rows):
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        got = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and len(got) <= len(rows)


CLASHING = ("_id", "_row_key", "_dropped", "_clean", "_host", "n_lines", "n_dropped", "score", "content_score", "row", "row_key", "spot", "key", "_word", "_b", "rejected_host", "dropped")


def with_clashes(spark, rows):
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in CLASHING])


def test_columns_of_any_name_come_through(spark):
    rows = [(i, prose(80, i, 3000) + f"\ncommon line that stands in every one of the documents here\nown {i}") for i in range(12)]
    rows += [(20, rows[3][1]), (21, "short")]
    docs = with_clashes(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert all(r[c] == f"{c} {r['doc_id']}" for r in out.collect() for c in CLASHING), name


def test_near_dedup_judges_rows_not_ids(spark):
    x, y, z = prose(90, 1), prose(90, 2), prose(90, 3)
    near = " ".join(["other", *x.split()[1:]])
    rows = [(1, x), (2, x), (2, y), (3, z), (3, z), (None, z), (5, None), (5, None), (6, ""), (6, " \n"), (None, near), (7, near), (7, prose(90, 4)), (None, prose(90, 5)), (None, prose(90, 5))]
    got = corpus_pipeline.near_dedup(spark, with_clashes(spark, rows), DATA).collect()
    stay = [(1, x), (2, y), (3, z), (5, None), (5, None), (6, ""), (6, " \n"), (7, prose(90, 4)), (None, prose(90, 5))]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(stay, key=repr)
    assert corpus_pipeline.near_dedup(spark, with_clashes(spark, []), DATA).collect() == []
