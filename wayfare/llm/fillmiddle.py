"""Fill-in-the-middle rearrangement of documents by counted quantifiers, in DataFrame operations only.

A text is cut into units (a word with the white space before it; white space at the end is a unit of its own).
``regexp_count`` says how many units a text has; the two cuts follow from a hash of the doc_id. Each row then
has a pattern of its own, ``(unit{a}+)(unit{b-a}+)(rest)``, and one match puts the three parts in their new order.
The quantifiers are possessive: they never go back, so they take no stack, however long the text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The unit, the marks of prefix, suffix and middle, and the seed of the hash.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 documents, so many stay plain; of 100 others, so many have the suffix first.
PLAIN_SHARE, SPM_SHARE = 50, 80


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a doc_id: the first groups of eight digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut_pattern(first: Column, second: Column) -> Column:
    """The pattern that captures ``first`` units, the units up to ``second``, and the rest."""
    unit = f"(?:{UNIT})"
    return F.concat(
        F.lit(f"(?s)^((?:{unit}{{"), first.cast("string"), F.lit("}+))((?:" + unit + "{"), (second - first).cast("string"), F.lit("}+))(.*+)$")
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    rearranged = F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
    return F.when(form == "plain", output).otherwise(
        rearranged.otherwise(F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
    )


def rearranged(docs: DataFrame, seed: int = SEED, plain_share: int = PLAIN_SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of every row of ``doc_id``, ``text``.

    ``n`` counts units. Prefix and middle end after the smaller and the larger of two cuts drawn from the doc_id. ``form`` is
    ``plain`` (text as it is, null as empty), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle);
    empty texts and those that hold a mark stay plain. Character counts are of code points, null where the text is plain.
    Rows with a null doc_id stay plain, as nothing is drawn for them; repeated rows are each returned, equal ones alike; rows with
    the same doc_id and other texts share their draws. An empty table gives no rows, further columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"), F.array(*draws(F.col("doc_id"), seed)).alias("h"))
    units, h = F.col("n") + 1, [F.get("h", F.lit(k)) for k in range(4)]
    cuts = [h[k] % units for k in (0, 1)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = F.col("doc_id").isNull() | (F.col("text") == "") | marked | (h[2] % 100 >= plain_share)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = F.regexp_replace("text", cut_pattern(F.col("first"), F.col("second")), order)
    rows = rows.select("doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(moved).alias("output"))

    def chars(before: str, after: str | None) -> Column:
        """Code points between two marks; only there to count, the text between is not copied out."""
        begin = F.locate(before, F.col("output")) + len(before)
        end = F.locate(after, F.col("output")) if after else F.length("output") + 1
        return F.when(F.col("form") != "plain", (end - begin).cast("long"))

    prefix_chars = F.when(F.col("form") == "psm", chars(PREFIX, SUFFIX)).otherwise(chars(PREFIX, MIDDLE))
    return rows.select("doc_id", "n", "form", "output", prefix_chars.alias("prefix_chars"), chars(MIDDLE, None).alias("middle_chars"))


def digests(docs: DataFrame) -> DataFrame:
    """The same with the SHA-256 of the output and of the text restored from it instead of the output."""

    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    return rearranged(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || doc_id::VARCHAR) AS s FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units FROM d),
h AS (SELECT *, len(units) AS n, {", ".join(f"('0x' || substr(s, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))} FROM u),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN doc_id IS NULL OR t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {PLAIN_SHARE} THEN 'plain'
      WHEN h4 % 100 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form
  FROM h),
parts AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s3 FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s3 || '{MIDDLE}' || m ELSE '{SUFFIX}' || s3 || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
