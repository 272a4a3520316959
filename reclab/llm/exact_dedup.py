"""Exact deduplication by content-defined chunk recipes.

A text is normalised (white space [\\x20\\x09-\\x0D] deleted), cut where a
rolling hash of the last bytes meets a fixed pattern, and described by its
recipe: the ordered list of its chunks' identifiers.  Chunks are deduplicated
first: each distinct chunk travels once, with its bytes, and the reducer
compares the bytes behind every identifier.  If two different chunks share
one, identifiers are made wider and the check repeats, so that in the end equal
recipes mean equal texts.  From then on only recipes are grouped and joined;
long documents do not move again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BLANK = b" \t\n\x0b\x0c\r"
#: Bytes the cut decision looks at; least, usual and greatest chunk length.
WINDOW, LEAST, USUAL, GREATEST = 32, 1024, 4096, 65536
#: Bytes of an identifier at first.
IDENTIFIER = 16
#: Distinct chunk bytes that a mapper remembers before it starts afresh.
REMEMBER = 16 << 20

_HASH = common.RollingHash(9)


def chunks(text: bytes) -> list[bytes]:
    """Content-defined chunks of a normalised text (none for an empty one)."""
    n = len(text)
    if n <= LEAST:
        return [text] if n else []
    marks = _HASH.windows(_HASH.prefix(np.frombuffer(text, np.uint8)), WINDOW)
    ends = np.flatnonzero(marks % np.uint64(USUAL) == 0) + WINDOW
    out, at = [], 0
    while n - at > LEAST:
        i = int(np.searchsorted(ends, at + LEAST))
        end = min(int(ends[i]) if i < len(ends) else n, at + GREATEST, n)
        out.append(text[at:end])
        at = end
    if at < n:
        out.append(text[at:])
    return out


def _identifier(chunk: bytes, width: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=width).digest()


def _normalised(array):
    for value in array.cast(pa.large_binary()):
        raw = value.as_buffer()
        yield b"" if raw is None else raw.to_pybytes().translate(None, BLANK)


def chunk_table(docs: DataFrame, width: int) -> DataFrame:
    """(identifier, chunk): each distinct chunk once per mapper's memory."""
    def run(batches):
        seen: dict[bytes, bytes] = {}
        size = 0
        for batch in batches:
            ids, data = [], []
            for text in _normalised(batch.column(0)):
                for chunk in chunks(text):
                    key = _identifier(chunk, width)
                    if seen.get(key) != chunk:
                        seen[key] = chunk
                        size += len(chunk)
                        ids.append(key)
                        data.append(chunk)
                if size > REMEMBER:
                    seen, size = {}, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(data, pa.binary())], names=["id", "chunk"])

    return docs.select("text").mapInArrow(run, "id binary, chunk binary")


def collisions(table: DataFrame) -> int:
    """Chunks that share their identifier with a different chunk, found by
    comparing bytes where Spark has brought equal identifiers together."""
    def run(batches):
        held, size, bad = {}, 0, 0
        for batch in batches:
            for key, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = held.get(key)
                if first is None:
                    if size > 4 * REMEMBER:  # rows are sorted by id: only the last id can come again
                        held, size = {}, 0
                    held[key] = chunk
                    size += len(chunk)
                else:
                    bad += first != chunk
        yield pa.RecordBatch.from_arrays([pa.array([bad], pa.int64())], names=["bad"])

    together = table.repartition("id").sortWithinPartitions("id")
    return together.mapInArrow(run, "bad long").agg(F.sum("bad")).first()[0] or 0


def verified_width(docs: DataFrame, width: int = IDENTIFIER) -> int:
    """The least width (doubling, up to 64 bytes) at which no two different
    chunks of ``docs`` share an identifier."""
    while collisions(chunk_table(docs, width)):
        if width >= 64:
            raise ValueError("two chunks share a 64-byte identifier")
        width = min(64, 2 * width)
    return width


def with_recipes(docs: DataFrame, width: int, names=("recipe", "text_sha256", "n_points"),
                 ) -> DataFrame:
    """``docs`` with its recipe (binary), the SHA-256 of the normalised text
    (lowercase hex) and the code points of the original text (long)."""
    def make(array):
        recipes, shas = [], []
        for text in _normalised(array):
            recipes.append(b"".join(_identifier(c, width) for c in chunks(text)))
            shas.append(hashlib.sha256(text).hexdigest())
        points = pa.compute.utf8_length(array).cast(pa.int64()).fill_null(0)
        return [pa.array(recipes, pa.binary()), pa.array(shas, pa.string()), points]

    return common.append_columns(docs, make, list(zip(
        names, (T.BinaryType(), T.StringType(), T.LongType()), strict=True)))


def groups(recipes: DataFrame) -> DataFrame:
    """One row per distinct text: recipe, group_size, keep_id, keep_points,
    keep_rows (rows that carry keep_id with that length: over 1 only for
    repeated rows)."""
    per_row = recipes.groupBy("recipe", "doc_id", "n_points").agg(F.count(F.lit(1)).alias("rows"))
    best = F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"),
                    F.col("doc_id").alias("i"), F.col("rows").alias("r"))
    return per_row.groupBy("recipe").agg(F.sum("rows").alias("group_size"), F.min(best).alias("k")).select(
        "recipe", "group_size", F.col("k.i").alias("keep_id"), (-F.col("k.p")).alias("keep_points"),
        F.col("k.r").alias("keep_rows"))


def exact_duplicates(docs: DataFrame, width: int = IDENTIFIER) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text needed): doc_id, keep_id,
    group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty, and
    empty texts are equal to each other.  Of equal texts the row with the most
    code points, then the smallest doc_id (null last), stays.  Repeated rows
    (same doc_id and length) count in group_size and are all marked kept if
    theirs is the kept id; ``deduplicate`` leaves one of them.  Empty table:
    empty result.  Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    rows = common.written(with_recipes(docs, verified_width(docs, width)).drop("text"), "recipes")
    # written first, so that the join's two sides are plain exchanges: a hot
    # recipe's rows all meet one group row, and Spark may split them
    found = common.written(groups(rows), "recipe-groups")
    return rows.join(found, "recipe").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))).alias("kept"),
        "text_sha256")


def deduplicate(docs: DataFrame, width: int = IDENTIFIER) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept;
    the rule of ``exact_duplicates``, and of repeated rows any one stays."""
    names = [common.free_name(docs, n) for n in ("recipe", "text_sha256", "n_points")]
    width = verified_width(docs.select("doc_id", "text"), width)
    narrow = with_recipes(docs.select("doc_id", "text"), width).drop("text")
    kept_names = {c: common.free_name(docs, f"dedup_{c}") for c in ("recipe", "keep_id", "keep_points", "keep_rows")}
    found = common.written(groups(narrow), "recipe-groups").select(
        *[F.col(c).alias(own) for c, own in kept_names.items()])
    recipe, keep_id, keep_points, keep_rows = (F.col(own) for own in kept_names.values())
    rows = with_recipes(docs, width, names)
    kept = rows.join(found, (F.col(names[0]) == recipe) & F.col("doc_id").eqNullSafe(keep_id)
                     & (F.col(names[2]) == keep_points))
    once = kept.where(keep_rows == 1).select(*docs.columns)
    repeated = kept.where(keep_rows > 1).dropDuplicates([names[0]]).select(*docs.columns)
    return once.unionByName(repeated)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(common.documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
