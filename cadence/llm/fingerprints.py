"""Document fingerprints: bottom-k sketches of word-shingle hashes, DataFrame functions only.

A sketch is the ascending array of the ``k`` smallest distinct 64-bit hashes of a text's
shingles (``width`` lower-cased words; fewer words: the whole sequence). Sketches of
parts merge into the sketch of the whole, and estimate resemblance, containment and the
number of distinct shingles. Null, empty and blank texts have an empty sketch; two empty
sketches are alike (1), an empty and another one are not (0). Equal texts have
equal sketches. Repeated rows and ids keep one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import narrow

K, WIDTH = 128, 5


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the shingles of a text, in text order, repeats included."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))
        return F.when(F.size(h) >= width, many).when(F.size(h) > 0, F.array(F.aggregate(h, F.lit(42).cast("long"), lambda a, x: F.xxhash64(a, x)))).otherwise(F.expr("array()").cast("array<bigint>"))

    return let(hashes, shingles)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    return bottom(shingle_hashes(text, width), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two texts' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, key: str, sketches: str = "sketch", k: int = K) -> DataFrame:
    """One merged sketch for each key: the k smallest distinct hashes are kept before and after
    the shuffle, so a key with any number of parts costs each task k rows."""
    parts = df.select(F.col(key).alias("key"), F.explode(sketches).alias("h")).distinct()
    least = parts.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("h"))).where(F.col("r") <= k)
    return least.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list("h")).alias(sketches))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k shingles; else (k - 1) over the k-th smallest hash as a share of the range."""
    share = F.element_at(a, -1).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's sketch that both have."""
    both = let(merge(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of a's shingles that b has, from resemblance and the two distinct counts."""
    r = resemblance(a, b, k)
    part = let(r, lambda x: x / (1 + x) * (distinct_shingles(a, k) + distinct_shingles(b, k)) / F.greatest(distinct_shingles(a, k), F.lit(1.0)))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(part, F.lit(1.0)))


def hexed(a: Column) -> Column:
    """Text form: 16 hex digits for each hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def with_next(df: DataFrame, key: str, carried: list[str], buckets: int | None = None) -> DataFrame:
    """Every row with the ``carried`` columns (as next_*) of the following row in descending ``key``
    order (nulls last, ties by the carried columns); the last row is followed by the first.

    No task holds the whole order: rows are dealt into ranges of the key cut at quantiles, and the
    one row before each range start comes from a table with a row for each range.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    coarse = min(n, 512)
    found = df.agg(F.percentile_approx(key, [k / coarse for k in range(coarse + 1)], 10_000).alias("m")).first().m
    marks = sorted(set(found or []), reverse=True)
    fine = -(-n // coarse)
    # coarse range 0 holds the largest keys, a null key is in the last one; beyond 512 ranges each is cut evenly
    if marks:
        at = F.size(F.filter(F.lit(marks).cast("array<bigint>"), lambda m: m > F.col(key)))
        top, low = (F.get(F.lit([marks[0], *marks]).cast("array<double>"), F.col("_c")), F.get(F.lit([*marks, marks[-1]]).cast("array<double>"), F.col("_c")))
        part = F.floor((top - F.col(key)) / F.greatest(top - low, F.lit(1.0)) * fine)
        df_b = df.withColumn("_c", F.when(F.col(key).isNull(), F.lit(len(marks) + 1)).otherwise(at))
        bucket = F.col("_c").cast("long") * fine + F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(fine - 1))
        dealt = df_b.withColumn("_b", bucket).drop("_c")
    else:
        dealt = df.withColumn("_b", F.lit(0).cast("long"))
    order = [F.col(key).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in carried]]
    row = F.struct(*carried)
    ahead = dealt.withColumn("_n", F.lead(row).over(Window.partitionBy("_b").orderBy(*order)))
    sort_key = F.struct(F.col(key).isNull().alias("_null"), (-F.col(key)).alias("_minus"), *carried)
    heads = dealt.groupBy("_b").agg(F.min(sort_key).alias("h")).select("_b", F.struct(*[F.col(f"h.{c}").alias(c) for c in carried]).alias("_h"))
    ring = Window.orderBy("_b")  # one number for each range
    turn = heads.select("_b", F.coalesce(F.lead("_b").over(ring), F.first("_b").over(ring)).alias("_to"))
    after = turn.join(heads.withColumnsRenamed({"_b": "_to"}), "_to").select("_b", "_h")
    out = ahead.join(after, "_b").withColumn("_n", F.coalesce("_n", "_h"))
    return out.select(*[c for c in df.columns], *[F.col(f"_n.{c}").alias(f"next_{c}") for c in carried])


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles."""
    docs = narrow(df, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("a", sketch(F.col("text"), k, width))
    pairs = with_next(docs, "doc_id", ["text", "a"]).withColumn("n_chars", F.length("text").cast("long"))
    cut_at = F.expr("cast(n_chars - n_chars div 3 as int)")
    edited = F.concat(F.substring("text", F.lit(1), cut_at), F.substring("next_text", F.lit(1), F.expr("cast(n_chars div 3 as int)")))
    made = (pairs.withColumn("edited", edited)
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a",
                    sketch(F.col("edited"), k, width).alias("e"), F.col("next_a").alias("n")))
    a, e, n = F.col("a"), F.col("e"), F.col("n")
    return made.select("doc_id", "n_chars", "edited_sha256", hexed(a).alias("fingerprint"), hexed(e).alias("edited_fingerprint"),
                       resemblance(a, e, k).alias("near_edited"), resemblance(a, n, k).alias("near_next"),
                       distinct_shingles(a, k).alias("n_shingles"))
