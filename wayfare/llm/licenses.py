"""License notices found by MinHash bands over overlapping windows, in DataFrame operations only.

For a template of ``n`` words, windows of ``2 n`` words begin at every ``n``-th word, so each place of the notice lies
wholly in one window. A window that holds the share ``CONTAINED`` of a template's shingles has a
Jaccard similarity of at least 0.2 with it; bands of one row each then miss it with a probability
below one in a million. What the bands retrieve is verified by exact containment of shingles.
Windows that hold no shingle of any template cannot match, so only those around such shingles are sketched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import ascii_lower

# Public license notices and opening paragraphs.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit-line": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SHINGLE = 3
CONTAINED = 0.8
BANDS = 64


def words_of_notice(text: Column) -> Column:
    """Runs of letters and digits, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of three words; of fewer words there are none."""
    runs = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    hashed = F.transform(runs, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    return F.when(F.size(words) >= SHINGLE, hashed).otherwise(F.array().cast("array<bigint>"))


def minima(shingles: Column, bands: int = BANDS) -> Column:
    """The least hash of the shingles under each of ``bands`` hash functions."""
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda s: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, s))))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, n, shingles) of each stated template; those with fewer than three words are refused."""
    texts = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    return texts.select("template", words_of_notice(F.col("text")).alias("words")).select(
        "template", F.size("words").alias("n"), F.array_distinct(shingles_of(F.col("words"))).alias("shingles")
    )


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED, bands: int = BANDS) -> DataFrame:
    """(doc_id, row_key, template, word_start, containment): each template a row's whole text holds, best window.

    ``row_key`` tells rows with equal ids apart; equal rows are one. Null, empty and short texts match nothing. Very long
    texts are searched whole. Ties of containment go to the first window.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates).collect()  # the stated templates, a few dozen rows
    if any(not t["shingles"] for t in known):
        raise ValueError("a template needs three words at least")
    every = sorted({s for t in known for s in t["shingles"]})
    table = spark.createDataFrame([(t["template"], t["n"], t["shingles"]) for t in known], "template string, n int, template_shingles array<bigint>")
    index = table.select("template", "n", "template_shingles", F.posexplode(minima(F.col("template_shingles"), bands)).alias("band", "value"))

    def among(hashes: list[int]) -> Column:
        return F.array(*[F.lit(h) for h in hashes])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row_key"), words_of_notice(F.col("text")).alias("words"))
    hashed = rows.select("doc_id", "row_key", shingles_of(F.col("words")).alias("all"))
    spots = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.get("all", i).isin(every))
    hashed = hashed.select("doc_id", "row_key", "all", F.when(F.size("all") > 0, spots).alias("spots"))

    def windows_of(n: int) -> Column:
        """The windows for templates of ``n`` words around the places where any template's shingle stands."""
        blocks = F.transform("spots", lambda p: F.floor(p / n).cast("int"))
        starts = F.filter(F.array_distinct(F.concat(blocks, F.transform(blocks, lambda k: k - 1))), lambda k: k >= 0)
        return F.transform(
            starts,
            lambda k: F.struct(F.lit(n).alias("n"), (k * n).alias("word_start"), F.array_distinct(F.slice("all", k * n + 1, F.lit(2 * n - SHINGLE + 1))).alias("shingles")),
        )

    # "Outer" with a later filter keeps the optimizer from evaluating the windows twice.
    windows = hashed.select("doc_id", "row_key", F.explode_outer(F.concat(*[windows_of(n) for n in sorted({t["n"] for t in known})])).alias("w"))
    windows = windows.where("w is not null").select("doc_id", "row_key", "w.*")
    banded = windows.select("doc_id", "row_key", "n", "word_start", "shingles", F.posexplode(minima(F.col("shingles"), bands)).alias("band", "value"))
    # The index has ``bands`` rows for each stated template.
    found = banded.join(F.broadcast(index), ["n", "band", "value"])
    share = F.size(F.array_intersect("shingles", "template_shingles")) / F.size("template_shingles")
    verified = found.withColumn("containment", share).where(F.col("containment") >= contained)
    best = F.max(F.struct("containment", (-F.col("word_start")).alias("s")))
    return verified.groupBy("doc_id", "row_key", "template").agg(best.alias("b")).select(
        "doc_id", "row_key", "template", (-F.col("b.s")).alias("word_start"), F.col("b.containment").alias("containment")
    )


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Every row's doc_id with the names of the notices its text holds (sorted array, empty if none).

    Null ids and repeated rows are kept; an empty table gives no rows.
    """
    found = license_matches(docs, templates).groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list("template")).alias("licenses"))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row_key"))
    found = found.withColumnsRenamed({"doc_id": "_id", "row_key": "_key"})
    joined = rows.join(found, rows.doc_id.eqNullSafe(F.col("_id")) & (rows.row_key == F.col("_key")), "left")
    return joined.select("doc_id", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"))


_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{L}\p{N}]+')"
SQL = f"""
WITH t AS (SELECT template, {_WORDS} AS ws FROM (VALUES {_VALUES}) AS v(template, text)),
ts AS (SELECT DISTINCT template, len(ws) AS n, ws[i + 1:i + 3] AS s FROM (SELECT *, unnest(range(0, len(ws) - 2)) AS i FROM t)),
tn AS (SELECT template, count(*) AS total FROM ts GROUP BY template),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
ds AS (SELECT r, p, ws[p + 1:p + 3] AS s FROM (SELECT *, unnest(range(0, len(ws) - 2)) AS p FROM d)),
hits AS (SELECT r, template, n, p, s FROM ds JOIN ts USING (s)),
windows AS (
  SELECT r, template, p // n AS k, s FROM hits WHERE p + 3 <= (p // n) * n + 2 * n
  UNION ALL SELECT r, template, p // n - 1, s FROM hits WHERE p // n >= 1 AND p + 3 <= (p // n - 1) * n + 2 * n),
found AS (
  SELECT DISTINCT r, template FROM (SELECT r, template, k, count(DISTINCT s) AS c FROM windows GROUP BY r, template, k) JOIN tn USING (template)
  WHERE c >= {CONTAINED} * total),
named AS (SELECT r, string_agg(template, ',' ORDER BY template) AS licenses, count(*) AS n FROM found GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_licenses FROM d LEFT JOIN named USING (r)
"""
