"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame operations only.

Edits are whole words: two lines are alike when one insertion, deletion or replacement of a word
turns one into the other (short lines: when they are equal). Every line emits the hash of each of
its variants: with word ``i`` deleted, with word ``i`` as a hole, and as it is. Lines with the same hole
variant, or where one's deletion is the other as it is, are alike; so the earliest line of each
variant is found by an aggregate, and no pairs of a group are ever formed. The found pairs are
verified on their words.

The hash of a word sequence is the sum over its words of a hash of word and position, so all
variants of a line come from running sums: the cost is linear in the length of the line.

Most lines have no neighbour at all. One edit leaves the first or the second half of a line as it
was, so only lines that share a half with another line emit variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import may_be_in, parted, staged, words_of

#: Lines with fewer words are only compared for equality: one word is too much of them.
MIN_WORDS = 8
SEEDS = (11, 47)


def _places(docs: DataFrame) -> DataFrame:
    """One row per line with a word: its place (document, key of the row, number) and its text."""
    # A null id sorts before all others; rows that share an id are told apart by their text.
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64("text").alias("row_key"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"),
    )
    # A filter on the words would be moved below their projection and split each line twice.
    return source.where(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")) != "")


def _with_words(places: DataFrame) -> DataFrame:
    """The lines with the hash of their words, and the words."""
    lines = places.select("id", "row_key", "line_no", words_of(F.col("line")).alias("words"))
    return lines.select("id", "row_key", "line_no", "words", F.xxhash64("words").alias("line"), F.size("words").alias("n"))


def _halves() -> Column:
    """Hashes of the halves that a line shares with any line within one edit.

    Of two lines with ``m`` and ``m`` or ``m + 1`` words, either the first ``m // 2`` words or the last ``m - m // 2`` are equal.
    """
    n = F.col("n")

    def pair(m: Column) -> list[Column]:
        head = F.floor(m / 2).cast("int")
        tail = (m - head).cast("int")
        return [
            F.xxhash64(F.lit(0), m, F.slice("words", F.lit(1), head)),
            F.xxhash64(F.lit(1), m, F.slice("words", n - tail + 1, tail)),
        ]

    return F.array(*pair(n), *pair(n - 1))


def _variants(lines: DataFrame) -> DataFrame:
    """(key, role, line, place) of every variant of the lines; role 0: as it is, 1: deletion, 2: hole."""
    by_line = Window.partitionBy("line")
    # Sums of 40 bits per word do not overflow below eight million words.
    def h(seed: int, place: Column) -> Column:
        return F.shiftright(F.xxhash64(F.lit(seed), F.col("word"), place), 24)

    each = lines.select("line", "n", "place", F.posexplode("words").alias("i", "word"))
    for k in SEEDS:
        each = each.withColumns({f"at{k}": h(k, F.col("i")), f"moved{k}": h(k, F.col("i") - 1)})
    until = by_line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = each.select(
        "line", "n", "place", "i",
        *[F.col(f"at{k}") for k in SEEDS],
        *[F.sum(f"at{k}").over(until).alias(f"head{k}") for k in SEEDS],
        *[F.sum(f"at{k}").over(by_line).alias(f"all{k}") for k in SEEDS],
        *[(F.sum(f"moved{k}").over(by_line) - F.sum(f"moved{k}").over(until)).alias(f"tail{k}") for k in SEEDS],
    )
    hole = F.xxhash64(F.lit(2), "n", "i", *[F.col(f"all{k}") - F.col(f"at{k}") for k in SEEDS])
    deleted = F.xxhash64(F.lit(0), F.col("n") - 1, *[F.col(f"head{k}") - F.col(f"at{k}") + F.col(f"tail{k}") for k in SEEDS])
    whole = F.xxhash64(F.lit(0), "n", *[F.col(f"all{k}") for k in SEEDS])
    kinds = F.array(
        F.struct(hole.alias("key"), F.lit(2).alias("role")),
        F.struct(deleted.alias("key"), F.lit(1).alias("role")),
        F.when(F.col("i") == 0, F.struct(whole.alias("key"), F.lit(0).alias("role"))),
    )
    return summed.select("line", "place", F.explode(kinds).alias("v")).where("v is not null").select("v.key", "v.role", "line", "place")


def _within_one(a: str, b: str) -> Column:
    """Whether one word edit at most lies between two arrays of words."""
    short = F.least(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        differ = F.array_position(F.zip_with(F.slice(x, F.lit(1), short), F.slice(y, F.lit(1), short), lambda p, q: p != q), True)
        return F.when(differ == 0, short).otherwise(differ - 1)

    head, tail = common(F.col(a), F.col(b)), common(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (head + tail >= F.greatest(F.size(a), F.size(b)) - 1)


def earliest_alike(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(occurrences, firsts): all lines by place, and for each distinct line the earliest place of one like it."""
    places = _places(docs)
    lines = _with_words(places)
    place = F.struct("id", "line_no")
    # Texts are split into words once for this table of hashes; those of the lines that need it are fetched by their places.
    halves = F.when(F.col("n") >= min_words, _halves()).alias("halves")
    hashes = staged(lines.select("id", "row_key", "line_no", "line", halves), "line-hashes")
    occurrences = hashes.drop("halves")
    distinct = staged(hashes.groupBy("line").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("times")), "distinct-lines")

    halves = hashes.where("halves is not null").select("line", F.explode("halves").alias("half"))
    shared = staged(halves.groupBy("half").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low <> high").select("half"), "shared-halves")
    sharing = staged(may_be_in(halves, "half", shared, "half").join(shared, "half").select("line").distinct(), "sharing-lines")
    firsts = may_be_in(occurrences, "line", sharing, "line").join(sharing, "line")
    firsts = firsts.groupBy("line").agg(F.min(F.struct("id", "line_no", "row_key")).alias("f"))
    firsts = staged(firsts.select("line", F.xxhash64("f.id", "f.row_key", "f.line_no").alias("spot")), "first-spots")
    spots = places.withColumn("spot", F.xxhash64("id", "row_key", "line_no"))
    found = _with_words(may_be_in(spots, "spot", firsts, "spot")).dropDuplicates(["id", "row_key", "line_no"])
    found = found.withColumn("spot", F.xxhash64("id", "row_key", "line_no")).join(firsts, ["line", "spot"])
    candidates = staged(found.select("line", place.alias("place"), "n", "words"), "candidates")
    variants = staged(_variants(candidates), "variants")

    def first_of(role: str) -> Column:
        return F.min(F.when(F.expr(role), F.struct("place", "line")))

    by_key = variants.groupBy("key").agg(
        F.min("line").alias("low"), F.max("line").alias("high"),
        first_of("role = 0").alias("whole"), first_of("role = 1").alias("shorter"), first_of("role = 2").alias("hole"),
    ).where("low <> high").drop("low", "high")
    by_key = staged(by_key, "variant-firsts")
    earlier = F.expr("case role when 0 then shorter when 1 then whole else hole end")
    pairs = (
        may_be_in(variants, "key", by_key, "key").join(by_key, "key").select("line", "place", earlier.alias("e"))
        .where("e is not null and e.place < place").select("line", F.col("e.line").alias("other"), F.col("e.place").alias("other_place")).distinct()
    )
    words = candidates.select("line", "words")
    verified = (
        pairs.join(words, "line").join(words.select(F.col("line").alias("other"), F.col("words").alias("other_words")), "other")
        .where(_within_one("words", "other_words"))
        .groupBy("line").agg(F.min("other_place").alias("near_place"))
    )
    firsts = distinct.join(staged(verified, "near-lines"), "line", "left").select(
        "line", "times", "place", F.least(F.col("place"), F.coalesce("near_place", "place")).alias("first")
    )
    return occurrences, staged(firsts, "first-places")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """All columns and rows, ``text`` without lines that an earlier line of the corpus is like.

    Lines lie between line feeds and are compared by their words; places are ordered by doc_id, then line number.
    Lines without a word stay. A line goes if any earlier one is alike, whether that one stays or
    not. The numbers of lines and of dropped ones are added as ``names``, in place of columns of these names. Null and empty texts
    stay as they are; a null doc_id comes first; equal rows with the same doc_id share their places, so neither drops the
    other's lines. Documents that lose nothing are not shuffled.
    """
    occurrences, firsts = earliest_alike(docs, min_words)
    repeated = firsts.where("times > 1 or first < place").select("line", "first")
    repeated = staged(repeated, "repeated-lines")
    # Joined first by itself: a line that is in a third of all documents is then split by the planner.
    marks = may_be_in(occurrences, "line", repeated, "line").join(repeated, "line")
    dropped = marks.where(F.struct("id", "line_no") > F.col("first")).select(F.xxhash64("id", "row_key").alias("spot"), "line_no")
    by_doc = staged(dropped.groupBy("spot").agg(F.collect_set("line_no").alias("dropped")), "dropped-lines")
    # The columns of the table stay by themselves in a struct, whatever their names.
    columns = [c for c in docs.columns if c not in names]
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    own = docs.select(F.xxhash64(id_, F.xxhash64("text")).alias("spot"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    maybe, whole = parted(own, "spot", by_doc, "spot")
    joined = maybe.join(by_doc, "spot", "left").unionByName(whole.withColumn("dropped", F.lit(None).cast("array<int>")))
    parts = F.split("row.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("dropped"))
    cleaned = F.array_join(F.transform(stay, lambda i: F.element_at(parts, i + 1)), "\n")
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(cleaned)
    # Counted without cutting the text up: most documents lose nothing.
    n_lines = F.octet_length("row.text") - F.octet_length(F.replace("row.text", F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in columns],
        F.coalesce(n_lines, F.lit(0)).alias(names[0]),
        F.coalesce(F.size("dropped"), F.lit(0)).alias(names[1]),
    )


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, text IS NULL AS none FROM documents),
parts AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS part, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS line_no FROM d),
lines AS (SELECT r, doc_id, line_no, regexp_extract_all(part, '[^\\x20\\x09-\\x0D]+') AS ws FROM parts WHERE regexp_matches(part, '[^\\x20\\x09-\\x0D]')),
kinds AS (SELECT ws, len(ws) AS n, min((doc_id, line_no)) AS place FROM lines GROUP BY ws),
spots AS (SELECT ws, n, place, unnest(range(1, n + 1)) AS i FROM kinds WHERE n >= {MIN_WORDS}),
cut AS (SELECT ws, n, place, i, ws[1:i - 1] || ws[i + 1:] AS v FROM spots),
near AS (
  SELECT ws, min(o) AS place FROM (
    SELECT ws, min(place) OVER (PARTITION BY i, v) AS o FROM cut
    UNION ALL SELECT k.ws, c.place FROM kinds k JOIN cut c ON k.ws = c.v WHERE k.n >= {MIN_WORDS}
    UNION ALL SELECT c.ws, k.place FROM cut c JOIN kinds k ON k.ws = c.v WHERE k.n >= {MIN_WORDS}
  ) GROUP BY ws),
firsts AS (SELECT kinds.ws, least(kinds.place, coalesce(near.place, kinds.place)) AS place FROM kinds LEFT JOIN near USING (ws)),
dropped AS (SELECT r, line_no FROM lines JOIN firsts USING (ws) WHERE (doc_id, line_no) > place),
kept AS (SELECT parts.r, string_agg(part, chr(10) ORDER BY line_no) AS clean FROM parts ANTI JOIN dropped USING (r, line_no) GROUP BY parts.r),
counts AS (SELECT r, count(*) AS n_dropped FROM dropped GROUP BY r)
SELECT doc_id, CASE WHEN none THEN 0 ELSE len(string_split(t, chr(10))) END::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
  sha256(coalesce(clean, '')) AS text_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN counts USING (r)
"""
