"""Operator 5: document fingerprints by a Merkle tree over paragraphs and sections.

Only DataFrame functions.  Leaves are paragraphs (lines); a section is a run of
paragraphs that ends where a paragraph's hash says so, so sections do not
shift when one is edited; the root hashes the sections.  Equal roots mean equal texts; where
roots differ, differing sections and in them differing paragraphs are the
edits.  Below the paragraphs stand pieces of a few words, cut after a character of even code,
whose shared share is the likeness of two trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.session import cut_lineage

#: a section ends after a paragraph whose hash is 0 modulo this
SECTION = 4
#: white space after an ASCII sign of even code ends a piece (the piece keeps it)
CUT = r"(?<=[\x22\x24\x26\x28\x2A\x2C\x2E02468:<>@BDFHJLNPRTVXZ\x5C\x5E`bdfhjlnprtvxz|~]\s)"
#: ids of one window of neighbours, and windows of one upper window
WINDOW = 256
UPPER = 4096


def tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add ``<prefix>paragraphs`` and ``<prefix>sections`` (hashes, in order) and ``<prefix>root``."""
    leaf, cut, sec = f"{prefix}paragraphs", f"_{prefix}ends", f"{prefix}sections"
    df = df.withColumn(leaf, F.transform(F.split(F.col(text), "\n", -1), lambda p: F.sha2(p, 256)))
    df = df.withColumn(cut, F.filter(F.sequence(F.lit(1), F.size(leaf)), lambda i: (i == F.size(leaf)) | (
        F.pmod(F.xxhash64(F.element_at(F.col(leaf), i)), F.lit(SECTION)) == 0)))
    df = df.withColumn(sec, F.transform(cut, lambda e, k: F.sha2(F.array_join(F.slice(
        F.col(leaf), F.when(k == 0, 1).otherwise(F.get(F.col(cut), k - 1) + 1),
        e - F.when(k == 0, 0).otherwise(F.get(F.col(cut), k - 1))), ""), 256)))
    return df.withColumn(f"{prefix}root", F.sha2(F.array_join(sec, ""), 256)).drop(cut)


def pieces(text: str) -> F.Column:
    """Distinct piece hashes of a text."""
    return F.array_distinct(F.transform(F.split(F.col(text), CUT), lambda p: F.xxhash64(p)))


def likeness(a: str, b: str) -> F.Column:
    """Share of pieces that two trees have in common, 0 to 1."""
    return (2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))).cast("double")


def changed(a: str, b: str) -> F.Column:
    """Positions (from 0) of hashes of ``a`` that do not stand in ``b``: the branches to descend."""
    return F.filter(F.transform(F.col(a), lambda h, k: F.when(~F.array_contains(F.col(b), h), k)), lambda k: k.isNotNull())


def with_next(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``(_id, _text, _next)``: the text of the next row by falling id, the first row's after
    the last.  Neighbours meet in windows over ranges of ``WINDOW`` ids; the first row of
    every range is also the next of the last row of the range before it, found
    over ranges of ranges, so no window spans the table."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_text"))
    keyed = rows.where("_id IS NOT NULL").withColumn("_b", F.floor(F.col("_id") / WINDOW).cast("bigint"))
    order = [F.col("_id").desc(), F.sha2("_text", 256)]
    inside = Window.partitionBy("_b").orderBy(*order)
    near = keyed.select("*", F.lead("_text").over(inside).alias("_next"), F.row_number().over(inside).alias("_k"))
    near = near.withColumn("_last", F.col("_next").isNull())
    # ranges in falling order and the range that follows each
    ranges = cut_lineage(keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_m"))
                         .withColumn("_u", F.floor(F.col("_b") / UPPER).cast("bigint")))
    upper = ranges.groupBy("_u").agg(F.max("_b").alias("_top")).withColumn(
        "_after", F.lead("_top").over(Window.orderBy(F.col("_u").desc())))       # one row per WINDOW * UPPER ids
    top = F.lit(ranges.agg(F.max("_b")).first()[0])
    follows = ranges.withColumn("_f", F.lead("_b").over(Window.partitionBy("_u").orderBy(F.col("_b").desc())))
    follows = cut_lineage(follows.join(upper, "_u").select("_b", F.coalesce("_f", "_after", top).alias("_f")))
    heads = keyed.groupBy("_b").agg(F.max_by("_text", F.struct("_id", _flip(F.sha2("_text", 256)))).alias("_head"))
    heads = cut_lineage(follows.join(heads.withColumnRenamed("_b", "_f"), "_f").select("_b", "_head"))
    return (near.join(heads, "_b", "left").select("_id", "_text", F.when(F.col("_last"), F.col("_head"))
                                                  .otherwise(F.col("_next")).alias("_next"))
            .unionByName(rows.where("_id IS NULL").withColumn("_next", F.lit(""))))


def _flip(hex_col: F.Column) -> F.Column:
    """Hex text whose order is reversed, so that a maximum takes the smallest."""
    return F.translate(hex_col, "0123456789abcdef", "fedcba9876543210")


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_paragraphs, n_sections, edited_sections, edited_paragraphs)`` per row.

    The edited text replaces the last floor(n_chars / 2) code points by the first as
    many (or all) of the next document's.  The last two columns locate the edit: positions of
    sections and paragraphs of the text that the edited tree lacks.  Null texts
    count as empty; two empty texts are alike.  Rows of equal id follow one
    another by the hash of their text.  Rows with a null id have no place in the
    order: their next document is empty.  Other columns are ignored."""
    df = with_next(docs, text_col, id_col).withColumn("n_chars", F.length("_text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("_edited", F.concat(F.expr("substring(_text, 1, cast(n_chars - floor(n_chars / 2) AS int))"),
                                           F.substring("_next", F.lit(1), cut)))
    df = tree(tree(df, "_text", "t_"), "_edited", "e_")
    for name, text in (("_pt", "_text"), ("_pe", "_edited"), ("_pn", "_next")):
        df = df.withColumn(name, pieces(text))
    return df.select(
        F.col("_id").alias(id_col), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        F.col("t_root").alias("fingerprint"), F.col("e_root").alias("edited_fingerprint"),
        F.when(F.col("t_root") == F.col("e_root"), 1.0).otherwise(likeness("_pt", "_pe")).alias("near_edited"),
        likeness("_pt", "_pn").alias("near_next"),
        F.size("t_paragraphs").alias("n_paragraphs"), F.size("t_sections").alias("n_sections"),
        changed("t_sections", "e_sections").alias("edited_sections"),
        changed("t_paragraphs", "e_paragraphs").alias("edited_paragraphs"))
