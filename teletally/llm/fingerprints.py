"""Document fingerprints: sketches scaled by a threshold.

Of all shingle hashes a sketch keeps those in the lowest fraction of the hash range, so its size
follows the document's and sketches of very unequal documents compare without bias: the sketch
of a union is the union of the sketches, and the share of one sketch found in another estimates
containment. The smallest hash is kept in any case, so that only a text without words has an
empty sketch; this too survives unions.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from teletally.llm.common import text_or_empty

WORDS = 5
FRACTION = 1 / 4
HIGHEST = 2**63 - 1


def words_of(text: Column) -> Column:
    """Lower-case words between white space."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def shingle_hashes(words: Column, width: int = WORDS) -> Column:
    """Hashes of all runs of ``width`` words; a shorter text is one run.

    ``words`` must be a plain column: each hash refers to it ``width`` times.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below the threshold, and the smallest one."""
    threshold = -(2**63) + int(fraction * 2**64)
    low = F.filter(hashes, lambda h: h < F.lit(threshold))
    return F.array_sort(F.array_distinct(F.concat(low, F.filter(F.array(F.array_min(hashes)), F.isnotnull))))


def with_sketch(df: DataFrame, text: str, name: str, width: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Adds the sketch of a text column; every step is a projection of its own, evaluated once."""
    worded = df.withColumn(f"{name}_words", words_of(F.col(text)))
    hashed = worded.withColumn(f"{name}_hashes", shingle_hashes(F.col(f"{name}_words"), width))
    return hashed.withColumn(name, sketch(F.col(f"{name}_hashes"), fraction)).drop(f"{name}_words", f"{name}_hashes")


def merged(a: Column, b: Column) -> Column:
    """Sketch of two documents taken together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Share of ``a`` found in ``b``; 1 for two empty sketches, 0 for one."""
    shared = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) > 0, shared).when(F.size(b) > 0, F.lit(0.0)).otherwise(F.lit(1.0))


def resemblance(a: Column, b: Column) -> Column:
    """Shared part of the union of two sketches; 1 for two empty ones."""
    either = F.size(F.array_union(a, b))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(F.lit(1.0))


def printed(hashes: Column) -> Column:
    """A sketch as text: hexadecimal, comma-joined, ascending."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ",")


def fingerprint(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WORDS,
    fraction: float = FRACTION,
) -> DataFrame:
    """``doc_id`` and ``sketch`` of every whole text.

    A null text counts as empty and has an empty sketch, a text of fewer words than ``width`` the hash
    of all of them; equal texts have equal sketches. One row per input row; other columns are ignored.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return with_sketch(texts, "text", "sketch", width, fraction).drop("text")


def range_ends(df: DataFrame, order: str, tie: str, parts: int) -> list[tuple[int, int]]:
    """The last (order, tie) of about ``parts`` ranges of like size, ascending; none for an empty table.

    A value of the order that fills several ranges is cut at values of ``tie`` that occur with it. Others
    are not cut: their end holds the highest tie there may be.
    """
    shares = [k / parts for k in range(1, parts)]
    found = df.agg(F.percentile_approx(order, shares, 100 * parts).alias("cuts"), F.max(order).alias("last")).first()
    if found["last"] is None:
        return []
    # Percentiles are doubles; the values that occur are looked up, since a long may lie beside them.
    cuts = sorted({*found["cuts"], found["last"]})
    place = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda cut: cut < F.col(order)))
    highest = {r["place"]: r["value"] for r in df.groupBy(place.alias("place")).agg(F.max(order).alias("value")).collect()}
    filled = Counter(found["cuts"])
    filled = {value: filled[cuts[k]] for k, value in highest.items() if k < len(cuts)}
    heavy = [value for value, count in filled.items() if count > 1]
    ends = {(value, HIGHEST) for value in highest.values()} - {(value, HIGHEST) for value in heavy}
    if heavy:
        # No more values, nor ends of them all, than there are cuts.
        most = max(filled.values())
        within = F.percentile_approx(tie, [k / most for k in range(1, most)], 100 * most)
        rows = df.where(F.col(order).isin(heavy)).groupBy(order).agg(within.alias("cuts"), F.max(tie).alias("last"))
        for row in rows.collect():
            ends |= {(row[order], cut) for cut in [*row["cuts"][:: -(-most // filled[row[order]])], row["last"]]}
    return sorted(ends)


def with_next(df: DataFrame, order: str, tie: str, columns: tuple[str, ...]) -> DataFrame:
    """Adds ``next_<column>`` of the next row by descending ``order``, after the last the first.

    ``order`` and ``tie`` hold longs without nulls, ``tie`` of 52 bits; equal values follow each other by descending ``tie``, then by
    the first of ``columns``. Rows go to ranges of (order, tie), cut at values that occur, so the last value of
    each range is known beforehand; rows with that value are sent to the range above as well, where they stand
    behind all others as the next row of its last one. So one shuffle does, without a global window, and
    only rows that agree in order and tie stay together.
    """
    parts = max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ends = range_ends(df, order, tie, parts)
    if not ends:
        return df.select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(f"next_{c}") for c in columns])
    stride = max(1, int(len(ends) ** 0.5))

    def listed(values: list[tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(v).cast("long").alias("value"), F.lit(t).cast("long").alias("tie")) for v, t in values])

    def below(values: Column) -> Column:
        own, own_tie = F.col(order), F.col(tie)
        return F.size(F.filter(values, lambda end: (end.value < own) | ((end.value == own) & (end.tie < own_tie))))

    all_ends, coarse = listed(ends), listed(ends[stride - 1 :: stride])
    ranged = df.withColumn("_coarse", below(coarse) * stride)
    ranged = ranged.withColumn("_range", F.col("_coarse") + below(F.slice(all_ends, F.col("_coarse") + 1, stride)))
    own = F.struct(F.col("_range"), F.lit(0).alias("guest"))
    above = F.struct(((F.col("_range") + 1) % len(ends)).alias("_range"), F.lit(1).alias("guest"))
    end = F.get(all_ends, F.col("_range"))
    is_end = (end.value == F.col(order)) & ((end.tie == F.col(tie)) | (end.tie == HIGHEST))
    placed = ranged.withColumn("_at", F.explode(F.when(is_end, F.array(own, above)).otherwise(F.array(own))))
    placed = placed.select(*df.columns, "_at._range", F.col("_at.guest").alias("_guest"))
    window = Window.partitionBy("_range").orderBy("_guest", F.desc(order), F.desc(tie), columns[0])
    following = [F.lead(c).over(window).alias(f"next_{c}") for c in columns]
    return placed.select("*", *following).where(F.col("_guest") == 0).drop("_range", "_guest")


def fingerprint_report(docs: DataFrame, width: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its second half replaced by the start of the next document (descending id).
    Likeness is the containment of the document's sketch in the other one. Null texts count as empty;
    null ids come last; rows with equal ids follow each other by descending hash of the text (52 bits), so that many rows
    of one id are divided; the only row of a table is its own next one; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    texts = texts.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    texts = texts.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 12))
    paired = with_next(with_sketch(texts, "text", "sketch", width, fraction), "key", "tie", ("text", "sketch"))
    paired = paired.withColumn("n_chars", F.length("text").cast("long"))
    half = F.expr("n_chars div 2").cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    paired = paired.withColumn("edited", edited).drop("text", "next_text")
    paired = with_sketch(paired, "edited", "edited_sketch", width, fraction)
    return paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
