"""Benchmark decontamination by template canonicalisation (DataFrame functions
only).

A text becomes a row of tokens (letter runs and numbers).  Numbers, names
(capitalised words inside a sentence) and units after a number become typed
placeholders; other words are lower-cased.  Windows of consecutive template
tokens are hashed and joined with the windows of the benchmark, whose items
are also entered without placeholders for names, so that a copy that lost its
capitals is found as well.  A capital that opens a sentence (or follows a line
break, quote or bracket) may be a name or not, so windows that hold such a word
have a second form, in which it is a name too; an item is judged by the first
forms alone and by all forms together.  An item counts as contained when windows covering
at least COVER of it match, and the slots agree: over all matching windows
each name in a slot of the item stands for one name in the document and the
other way round, and so do units, unless enough windows match with unchanged
units.  Numbers are free: a question asked again may give two equal numbers
for two that differ.  An unchanged copy agrees with itself; a question asked
again with other names agrees by renaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Tokens in a window; shorter items are one window.
WINDOW = 8
#: Items with fewer tokens are too common to be told from chance.
LEAST = 5
#: Part of an item's windows that must match.
COVER = 0.6
#: Benchmark windows are broadcast up to this many rows (about 32 bytes each);
#: a larger benchmark is joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
# fixed values: unit words that may follow a number
UNITS = ["mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "min", "h", "hours", "hour", "minutes",
         "minute", "seconds", "second", "days", "day", "weeks", "week", "years", "year", "meters", "metres",
         "miles", "feet", "inches", "pounds", "dollars", "euros", "cents", "percent", "kmh", "mph"]
_UNIT = "|".join(sorted(UNITS, key=len, reverse=True))
#: Slots of the filter that windows pass before anything else is made of them
#: (a byte each; a larger benchmark only lets more windows through).
FILTER = 1 << 17
#: Bits of a hash from which its slots are taken.
SHIFTS = (0, 24)


def _marked(text: Column, names: bool) -> Column:
    """The words of a text, in order: letter runs and numbers, the latter behind
    a NUMBER mark, names inside a sentence behind NAME, and units after a number
    behind UNIT (null: none)."""
    text = F.coalesce(text, F.lit(""))
    for mark in (NAME, NUMBER, UNIT):  # the marks themselves are no part of any word
        text = F.when(text.contains(mark), F.regexp_replace(text, mark, " ")).otherwise(text)
    if names:  # a capital after a lower-case letter or a comma, in the same sentence
        text = F.regexp_replace(text, r"([\p{Ll}\p{Nd},;:]\x20)(?=\p{Lu})", "$1" + NAME)
    text = F.regexp_replace(text, rf"(?i)(\p{{Nd}}\x20?)(?=(?:{_UNIT})(?![\p{{L}}\p{{M}}]))", "$1" + UNIT)
    text = F.regexp_replace(text, r"\p{Nd}+(?:[.,]\p{Nd}+)*", NUMBER + "$0")
    return F.regexp_extract_all(text, F.lit(
        r"[\x01\x03]?[\p{L}\p{M}]+|\x02\p{Nd}+(?:[.,]\p{Nd}+)*"), F.lit(0))


def _tokenised(df: DataFrame, names: bool = True) -> DataFrame:
    """``df`` with ``raw`` (its marked words) and, from that one pass, tokens
    (placeholders for the marked ones) with their hashes, openers (the places of
    capitals that may be names), and the hashes with names there
    (``hashes_o``, the second form)."""
    def slot(x):
        return F.substring(x, 1, 1).isin(NAME, NUMBER, UNIT)

    out = df.withColumn("raw", _marked(F.col("text"), names))
    out = out.withColumn("tokens", F.transform("raw", lambda x: F.when(
        slot(x), F.substring(x, 1, 1)).otherwise(F.lower(x))))
    out = out.withColumn("hashes", F.transform("tokens", lambda t: F.xxhash64(t)))
    if not names:
        return out.withColumns({"openers": F.array().cast("array<int>"), "hashes_o": F.col("hashes")})
    opens = F.transform("raw", lambda x: x.rlike(r"^\p{Lu}"))
    out = out.withColumn("opens", opens)
    return out.withColumns({
        "hashes_o": F.zip_with("hashes", "opens", lambda h, o: F.when(o, F.xxhash64(F.lit(NAME))).otherwise(h)),
        "openers": F.filter(F.transform("opens", lambda o, i: F.when(o, i)), lambda i: i.isNotNull())}).drop("opens")


def words(text: Column) -> Column:
    """Letter runs and numbers of a text, in order (null: none)."""
    return F.transform(_marked(text, False), lambda x: F.regexp_replace(x, r"^[\x01-\x03]", ""))


def _mark_at(i: Column, second: bool) -> Column:
    """The word in the slot at ``i`` behind its type, null where there is none."""
    x = F.get(F.col("raw"), i)
    own = F.when(F.substring(x, 1, 1).isin(NAME, NUMBER, UNIT), F.lower(x))
    return F.coalesce(own, F.when(F.array_contains("openers", i), F.concat(F.lit(NAME), F.lower(x)))) if second else own


def _windows(width: int, slots_used: bytes | None = None) -> Column:
    """array<struct<at, h, v, form, width>> over the columns of ``_tokenised``:
    of every ``width`` tokens their start, their hash, and the words in their
    slots (null elsewhere); form 1 is the second form, of windows that have
    one.  ``slots_used``: only windows whose hash passes this filter."""
    n = F.size("tokens")
    offsets = [F.lit(k) for k in range(width)]

    def built(starts, second, form):
        def hashed(i):
            return F.xxhash64(F.slice("hashes_o" if second else "hashes", i + 1, width))

        if slots_used is not None:
            def used(i, shift):
                slot = F.shiftrightunsigned(hashed(i), shift).bitwiseAND(FILTER - 1).cast("int")
                return F.substring(F.lit(slots_used), slot + 1, F.lit(1)) == F.lit(b"\x01")

            starts = F.filter(F.filter(starts, lambda i: used(i, SHIFTS[0])), lambda i: used(i, SHIFTS[1]))
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), hashed(i).alias("h"), slots(i, second).alias("v"), F.lit(form).alias("form"),
            F.lit(width).alias("width")))

    def slots(i, second):
        return F.transform(F.array(*offsets), lambda k: _mark_at(i + k, second))

    first = built(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), False, 0)
    around = F.array_distinct(F.flatten(F.transform("openers", lambda i: F.sequence(
        F.greatest(i - width + 1, F.lit(0)), F.least(i, n - width)))))
    second = built(around, True, 1)
    none = F.array().cast("array<struct<at:int,h:bigint,v:array<string>,form:int,width:int>>")
    return F.when(n < width, none).otherwise(F.concat(first, second))  # without openers the second is empty


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per window and form of each distinct item text: h, width,
    item_id (the smallest of equal items), n_items, b_at (start), n_windows,
    b_v (the words in its slots) and b_form."""
    items = (benchmark.where(F.col("text").isNotNull()).groupBy("text")
             .agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items")))
    forms = _tokenised(items).unionByName(_tokenised(items, names=False))
    forms = forms.where(F.size("tokens") >= LEAST).withColumn(
        "width", F.least(F.lit(WINDOW), F.size("tokens")))
    out = None
    for width in range(LEAST, WINDOW + 1):
        own = forms.where(F.col("width") == width).select(
            "item_id", "n_items", "width", (F.size("tokens") - F.col("width") + 1).alias("n_windows"),
            F.explode(_windows(width)).alias("w"))
        out = own if out is None else out.unionByName(own)
    return out.select("w.h", "width", "item_id", "n_items", F.col("w.at").alias("b_at"), "n_windows",
                      F.col("w.v").alias("b_v"), F.col("w.form").alias("b_form")).dropDuplicates(
                          ["item_id", "b_at", "h"])


def contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER,
                 broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, item_id) pairs, one row each, with key_a, key_b (two hashes that
    name the row's doc_id and text), n_items (benchmark items with that very
    text, item_id being the smallest), n_windows, n_matched and renamed (slot
    values that differ between item and document).

    Documents without a hit give no row, so do null and empty texts, empty
    tables, and items of fewer than LEAST tokens.  Repeated rows give one
    row; ties do not matter.  Extra columns are ignored.
    """
    known = common.written(benchmark_windows(benchmark), "benchmark-windows")
    sizes = known.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()  # at most WINDOW rows
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, key_a long, key_b long, "
                                                 "n_items long, n_windows int, n_matched long, renamed long")
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key_a"),
                        F.xxhash64(F.lit(1), "text", "doc_id").alias("key_b"), "doc_id", "text")
    hashes = F.broadcast(known) if sum(r["n"] for r in sizes) <= broadcast_windows else known
    slots_used = bytearray(FILTER)
    used = F.explode(F.array(*[F.shiftrightunsigned("h", k).bitwiseAND(FILTER - 1) for k in SHIFTS])).alias("slot")
    for row in known.select(used).distinct().toLocalIterator():  # FILTER at most
        slots_used[row["slot"]] = 1
    windows = F.concat(*[_windows(r["width"], bytes(slots_used)) for r in sizes])
    hits = (_tokenised(keyed).select("key_a", "key_b", "doc_id", F.explode(windows).alias("w"))
            .select("key_a", "key_b", "doc_id", "w.*").join(hashes, ["h", "width"]).drop("h", "width"))
    key = ["key_a", "key_b", "item_id"]
    # a window of slots alone says nothing, unless they are unchanged or name
    # slots of the first form, which must agree
    hits = hits.withColumn("form", F.greatest("form", "b_form")).drop("b_form").where(
        F.col("v").isNull() | F.exists("v", lambda x: x.isNull()) | (F.col("v") == F.col("b_v"))
        | ((F.col("form") == 0) & F.exists("v", lambda x: x.startswith(NAME))))
    hits = common.written(hits, "benchmark-hits")
    # a copy is judged by the first forms and by all, each as a whole and, in
    # case a document holds several that differ, by its offset from the item
    hits = hits.withColumn("forms", F.explode(F.sequence("form", F.lit(1))))
    hits = hits.withColumn("offset", F.explode(F.array(F.lit(None).cast("int"), F.col("at") - F.col("b_at"))))
    hits = hits.withColumn("offset", F.coalesce("offset", F.lit(1 << 31)).cast("long"))
    one = [*key, "forms", "offset"]
    # each slot value of the item against the document's
    pairs = (hits.where("b_v IS NOT NULL").select(*one, F.explode(F.arrays_zip("b_v", "v")).alias("p"))
             .select(*one, F.col("p.b_v").alias("b"), F.col("p.v").alias("d")).where("b IS NOT NULL").distinct())

    def consistent(slot):
        own = F.col("b").startswith(slot)
        n, nb, nd = F.count(F.when(own, 1)), F.countDistinct(F.when(own, F.col("b"))), F.countDistinct(
            F.when(own, F.col("d")))
        return (n == nb) & (n == nd)

    agreed = pairs.groupBy(*one).agg(
        consistent(NAME).alias("names"), consistent(UNIT).alias("units"),
        F.count(F.when(F.col("b") != F.col("d"), 1)).alias("renamed"))

    def of_type(values, slot):
        return F.filter(values, lambda x: x.startswith(slot))

    same = F.col("v").isNull() | (of_type(F.col("v"), UNIT) == of_type(F.col("b_v"), UNIT))
    covered = hits.groupBy(*one).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_items").alias("n_items"),
        F.max("n_windows").alias("n_windows"), F.countDistinct("b_at").alias("n_matched"),
        F.countDistinct(F.when(same, F.col("b_at"))).alias("n_same"))
    least = cover * F.col("n_windows")
    accepted = covered.where(F.col("n_matched") >= least).join(agreed, one, "left").where(
        F.coalesce(F.col("names"), F.lit(True)) & (F.coalesce(F.col("units"), F.lit(True)) | (F.col("n_same") >= least)))
    return accepted.groupBy(*key).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_items").alias("n_items"), F.max("n_windows").alias("n_windows"),
        F.max("n_matched").alias("n_matched"), F.min(F.coalesce(F.col("renamed"), F.lit(0))).alias("renamed")).select(
            "doc_id", "item_id", "key_a", "key_b", "n_items", "n_windows", "n_matched",
            F.col("renamed").cast("long").alias("renamed"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item."""
    a, b = common.free_name(docs, "key_a"), common.free_name(docs, "key_b")
    found = contaminated(docs, benchmark).select(F.col("key_a").alias(a), F.col("key_b").alias(b)).distinct()
    marked = docs.withColumns({a: F.xxhash64("doc_id", "text"), b: F.xxhash64(F.lit(1), "text", "doc_id")})
    return marked.join(found, [a, b], "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(common.documents(spark, sf_dir), common.documents(spark, sf_dir, "benchmark")).drop(
        "key_a", "key_b")
