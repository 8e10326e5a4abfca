"""Document fingerprints in DataFrame functions only: one-permutation MinHash, packed to low bits.

A text's five-word shingles are hashed once. The hash's first bits name one of BINS bins, and each bin
keeps its least hash. An empty bin copies a bin that is not empty, found by trying a sequence of bins
that depends on the empty bin's number only (optimal densification), so equal sets stay equal and
similar sets agree as often as they are similar. Of each bin the lowest BITS bits are kept, packed
into longs. Two fingerprints that agree in a share m of the bins have likeness (m - c) / (1 - c), with
c = 2 ** -BITS for agreement by chance, and at least 0.

Every step is local to a row; nothing is exploded. The bins are filled by one sort: a marker behind each
bin's largest hash makes every bin's first element its least hash, or the marker if it is empty.

Cases: a text of one to four words is one shingle; a null text, or one without words, has no
fingerprint (an empty string) and is like its equals (1) and nothing else (0); repeated rows have equal
fingerprints; null ids come last, ties by a hash of the text; an empty table gives no row; texts count whole; columns other
than doc_id and text play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlight.llm.common import SPACE, cut, documents
from fieldlight.llm.secrets import let

WORDS, BINS, BITS = 5, 256, 4
#: 63-bit hashes; the first 8 name the bin.
_SHIFT = 63 - 8
_REST = (1 << _SHIFT) - 1
_PER_LONG = 64 // BITS
#: A bin's low bits are no zero where they differ; one bit of each remains.
_ONES = int("1" * 16, 16)
#: Attempts of densification, in batches so that few are tried in vain.
_ATTEMPTS = ((1, 8), (9, 64), (65, 256))
#: Rows of a bucket of neighbouring ids, and buckets at most: their first ids travel in the plan. From 200 million rows on
#: buckets grow; a bucket is sorted by a window, which spills, so it need not fit in memory.
BUCKET, BUCKETS = 2000, 100_000
#: Where rows without id stand.
_LAST = (1 << 63) - 1


def shingles(text: Column, n: int = WORDS) -> Column:
    """63-bit hashes of all n-word shingles, in order; of all words, if they are fewer."""

    def hashed(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(n))))
        few = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.get(w, F.lit(0)) == "", F.array().cast("array<bigint>")).when(F.size(w) < n, few).otherwise(grams)

    return F.transform(let(F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), SPACE), hashed), lambda h: h.bitwiseAND(F.lit((1 << 63) - 1)))


def least_of_bins(hashes: Column) -> Column:
    """BINS elements: each bin's least hash, or its marker."""
    markers = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.shiftleft(j.cast("long"), _SHIFT).bitwiseOR(F.lit(_REST)))
    both = F.sort_array(F.concat(hashes, markers))
    return let(both, lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT))))


def low_bits(bins: Column) -> Column:
    """Densified bins, BITS low bits of each."""
    full = lambda x: x.bitwiseAND(F.lit(_REST)) != _REST

    def donor(j: Column) -> Column:
        tried = [F.get(F.filter(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda t: F.get(bins, F.pmod(F.xxhash64(j, t), F.lit(BINS)).cast("int"))), full), F.lit(0)) for a, b in _ATTEMPTS]
        return F.coalesce(*tried, F.get(F.filter(bins, full), F.lit(0)))

    return F.transform(bins, lambda x, j: F.when(full(x), x).otherwise(donor(j)).bitwiseAND(F.lit((1 << BITS) - 1)))


def fingerprint(text: Column) -> Column:
    """Array of longs; empty for a text without words."""

    def packed(bits: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), lambda g: F.aggregate(F.slice(bits, g * _PER_LONG + 1, F.lit(_PER_LONG)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x)))

    def of(h: Column) -> Column:
        whole = let(let(least_of_bins(h), low_bits), packed)
        return F.when(F.size(h) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return let(shingles(F.coalesce(text, F.lit(""))), of)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingle sets."""

    def differ(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in (2, 1):  # nibbles: fold the upper bits down
            d = d.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(d.bitwiseAND(F.lit(_ONES)))

    unlike = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (1 - unlike / BINS - chance) / (1 - chance))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), estimate).otherwise((F.size(a) == F.size(b)).cast("double"))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def buckets(ids: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Ascending ids that begin buckets of about BUCKET rows, BUCKETS at most, of which the first is the least id; and the hot
    ids, which fill several buckets alone, with how many. A hot id's successor begins a bucket too."""
    n = ids.count()
    if not n:
        return [], {}
    k = min(BUCKETS, -(-n // BUCKET))
    row = ids.agg(F.min("_order"), F.percentile_approx("_order", [i / k for i in range(k)], min(20 * k, 400_000))).first()
    hot = {x: c for x, c in Counter(row[1]).items() if c > 2}
    return sorted({row[0], *row[1], *(x + 1 for x in hot if x < _LAST)}), hot


def bucket_of(order: Column, firsts: list[int]) -> Column:
    """The place of the last of firsts that is not above; looked up in two steps."""
    step = max(1, int(len(firsts) ** 0.5))
    groups = [firsts[i : i + step] for i in range(0, len(firsts), step)]
    longs = lambda a: F.lit(a).cast("array<bigint>") if a else F.array().cast("array<bigint>")
    outer = F.size(F.filter(longs([g[0] for g in groups]), lambda x: x <= order)) - 1
    inner = F.size(F.filter(F.get(F.array(*map(longs, groups)), outer), lambda x: x <= order)) - 1
    return outer * step + inner


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with next_text, the text after by ascending id (null ids last; after the last
    the first), and with what a window over neighbours needs: _bucket, _copy, _order, _tie. Rows are
    dealt by ranges of ids; a range's first row also goes to the range before it, as a copy. The rows of a hot id, or those without
    id, are dealt by ranges of _tie as well, and equal ones of them in turn."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_order"))
    firsts, hot = buckets(rows.select("_order"))
    firsts = firsts or [0]
    own = bucket_of(F.col("_order"), firsts)
    if hot:
        return with_next_of_hot(rows.withColumn("_own", own), hot)
    begins = F.col("_order").isin(firsts) if len(firsts) < 100 else F.get(F.transform(F.array(own), lambda b: F.get(F.lit(firsts).cast("array<bigint>"), b)), F.lit(0)) == F.col("_order")
    place = lambda b, copy: F.struct(b.alias("bucket"), F.lit(copy).alias("copy"))
    places = F.when(begins, F.array(place(own, 0), place(F.pmod(own - 1, F.lit(len(firsts))), 1))).otherwise(F.array(place(own, 0)))
    dealt = rows.select("doc_id", "text", "_order", F.explode(places).alias("_p")).select("doc_id", "text", "_order", F.col("_p.bucket").alias("_bucket"), F.col("_p.copy").alias("_copy"))
    return dealt.withColumn("_tie", F.xxhash64("text")).withColumn("next_text", F.lead("text").over(neighbours()))


def with_next_of_hot(rows: DataFrame, hot: dict[int, int]) -> DataFrame:
    """with_next where ids are hot; rows: doc_id, text, _order, _own. A bucket is (place, turn): the place is a range of ids, or
    of a hot id's ties. Rows of one id and text, if they are many, take turns; each is followed by its equal, but for the last of
    turn 0, which is followed by the next place's first row."""
    spark = rows.sparkSession
    pieces = F.broadcast(spark.createDataFrame(list(hot.items()), "_order long, _pieces int"))  # BUCKETS / 3 rows at most
    share = F.xxhash64("text") / F.lit(2.0**64) + 0.5
    piece = F.coalesce(F.least(F.floor(share * F.col("_pieces")).cast("int"), F.col("_pieces") - 1), F.lit(0))
    tied = rows.join(pieces, "_order", "left").select("doc_id", "text", "_order", "_own", "_pieces", piece.alias("_piece"), F.xxhash64("text").alias("_tie"))
    # Rows outside the hot ids are alone in their ranges; only their ids tell which is first there.
    key = F.struct("_order", F.when(F.col("_pieces").isNotNull(), F.col("_tie")).alias("_tie"))
    edges = cut(tied.groupBy("_own", "_piece").agg(F.min(key).alias("_edge")), "edges")
    # A row a bucket, so one task can number them.
    edges = edges.select("*", F.row_number().over(Window.orderBy("_own", "_piece")).alias("_bucket"), F.count("*").over(Window.partitionBy(F.lit(1))).alias("_n"))
    equal = tied.where("_pieces is not null").groupBy("_order", "_tie").agg(F.count("*").alias("_m")).where(F.col("_m") > 4 * BUCKET)
    equal = cut(equal.select("_order", "_tie", F.ceil(F.col("_m") / BUCKET).cast("int").alias("_turns")), "equal")
    dealt = tied.withColumn("_row", F.monotonically_increasing_id()).join(cut(edges, "buckets"), ["_own", "_piece"]).join(equal, ["_order", "_tie"], "left")
    turn = F.coalesce(F.pmod("_row", "_turns").cast("int"), F.lit(0))
    place = lambda b, copy, turn: F.struct(b.alias("bucket"), F.lit(copy).alias("copy"), turn.alias("turn"))
    before = F.when(F.col("_bucket") == 1, F.col("_n").cast("int")).otherwise(F.col("_bucket") - 1)
    places = F.when(key.eqNullSafe(F.col("_edge")) & (turn == 0), F.array(place(F.col("_bucket"), 0, turn), place(before, 1, F.lit(0)))).otherwise(F.array(place(F.col("_bucket"), 0, turn)))
    bucket = F.when(F.col("_p.turn") == 0, F.struct(F.col("_p.bucket"), F.lit(0).cast("long").alias("tie"), F.col("_p.turn")))
    bucket = bucket.otherwise(F.struct(F.col("_p.bucket"), F.col("_tie").alias("tie"), F.col("_p.turn")))
    out = dealt.select("doc_id", "text", "_order", "_tie", F.explode(places).alias("_p"))
    out = out.select("doc_id", "text", "_order", bucket.alias("_bucket"), F.col("_p.copy").alias("_copy"), "_tie")
    return out.withColumn("next_text", F.coalesce(F.lead("text").over(neighbours()), F.when(F.col("_bucket.turn") > 0, F.col("text"))))


def neighbours():
    return Window.partitionBy("_bucket").orderBy("_copy", "_order", "_tie")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir).select("doc_id", "text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    # A copy only lends its text and fingerprint to the row before it.
    rows = rows.select("doc_id", "_bucket", "_copy", "_order", "_tie", n.cast("long").alias("n_chars"), "text", F.when(F.col("_copy") == 0, edited).otherwise("").alias("edited"))
    rows = rows.select("doc_id", "_bucket", "_copy", "_order", "_tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("own"), fingerprint(F.col("edited")).alias("other"))
    rows = rows.withColumn("following", F.coalesce(F.lead("own").over(neighbours()), "own")).where("_copy = 0")
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
