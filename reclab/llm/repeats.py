"""Suffix-array deduplication of long repeats by prefix-free parsing.

A byte is removed if a MATCH-byte string that covers it also starts earlier in
the corpus (smaller doc_id, or the same document and an earlier start).

Rolling-hash triggers: in a string of MATCH bytes, the trigger is the
WIDTH-gram of least hash among its first SPAN ones (the rightmost of equals).
It depends on the string alone, so equal strings have equal triggers, and as
starts move on, triggers only move on.  The starts that share a trigger form a
phrase; with the bytes their strings cover it reads the same wherever it
occurs.

Dictionary and parse: a document becomes its list of phrases, and each phrase
has two names, that of its kernel (the bytes after the trigger that all its
strings hold) and that of its whole content (over 120 bits together).
Occurrences of a content after its first in corpus order are repeats
as a whole; this settles highly repetitive text one phrase at a time, and
where a map task sees several occurrences it settles them before any exchange.

Suffix order: only where one kernel has several contents can some strings of
different phrases be equal.  There the suffixes of the dictionary's phrases
(one occurrence of each content, one suffix per start) are brought into corpus
order by their first MATCH bytes (named by 128-bit hashes) and position; of
equal ones the first stays.  A full suffix array is not needed, since order
beyond MATCH bytes decides nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MATCH = 100
#: Bytes of a trigger, and candidates among which the least hash wins (a power of two).
WIDTH, SPAN = 12, 64

_A, _B = common.RollingHash(81), common.RollingHash(82)
_LOW = np.uint64(0xFFFFFFFF)
_STARTS = np.uint64(2 * SPAN - 1)


def phrases(data: np.ndarray, offsets: np.ndarray, match: int = MATCH):
    """Phrases of consecutive documents: (document, first start in it, number
    of starts, kernel name, content name).  A content's name holds the number
    of its starts in the lowest bits; with the kernel's it has over 120 bits."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < match:
        return none, none, none, *(np.zeros(0, np.uint64),) * 2
    a, b = _A.prefix(data), _B.prefix(data)
    gram = _A.windows(a, WIDTH)
    # least hash, rightmost of equals: the position counts downwards below the hash
    least = (gram & ~_LOW) | (_LOW - np.arange(len(gram), dtype=np.uint64))
    step = 1
    while step < SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    trigger = (_LOW - (least & _LOW)).astype(np.int64)
    # starts whose string lies in one document
    lengths = np.diff(offsets)
    has = lengths >= match
    first, last = offsets[:-1][has], offsets[1:][has] - match  # inclusive
    size = last - first + 1
    doc = np.repeat(np.flatnonzero(has), size)
    start = np.arange(size.sum()) + np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) if len(size) else none
    at = trigger[start]
    cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]) if len(start) else none
    lo, anchor, doc = start[cut], at[cut], doc[cut]
    count = np.diff(np.r_[cut, len(start)])  # at most SPAN
    kernel = _A.spans(a, anchor, anchor + match - SPAN + 1)
    # a content is its bytes and where the trigger stands in them
    content = _B.spans(b, lo, lo + count - 1 + match) ^ common.mix((anchor - lo).astype(np.uint64) + np.uint64(1))
    return doc, lo - offsets[doc], count, kernel, (content & ~_STARTS) | count.astype(np.uint64)


#: One row of the two exchanges: where it goes, its name, and its place: the
#: hash of the text, the start, and whether it is settled.  What is settled
#: goes anywhere; what is not goes to the kernel (or first half of its name).
ROWS = "route long, name long, doc_id long, place long"


def _place(text: np.ndarray, start: np.ndarray, settled: np.ndarray) -> np.ndarray:
    return (text.astype(np.int64) << 32) | (start.astype(np.int64) << 1) | settled


def _unplace(place: np.ndarray):
    return (place >> 32).astype(np.int32), ((place >> 1) & 0x7FFFFFFF).astype(np.int32), (place & 1).astype(bool)


def _first_places(keys: list[np.ndarray], doc_id: np.ndarray, start: np.ndarray):
    """Rows in the order of their keys, then place; which of them begin a new
    key; and which stand later than the first of theirs (an equal position is
    the same place of a repeated row, not a later one)."""
    by = np.lexsort([start, doc_id, *keys[::-1]])
    new = np.zeros(len(by), bool)
    new[:1] = True
    for k in keys:
        k = k[by]
        new[1:] |= k[1:] != k[:-1]
    lead = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))] if len(by) else by
    return by, new, (doc_id[by] != doc_id[lead]) | (start[by] != start[lead])


def _local(kernel, name, doc_id, text, start):
    """A step's rows, settled where an equal one stands earlier in the step."""
    by, _, later = _first_places([kernel, name], doc_id, start)
    settled = np.zeros(len(by), np.int64)
    settled[by] = later
    route = np.where(settled == 1, common.mix(name + start.astype(np.uint64)), kernel)
    return pa.RecordBatch.from_arrays(
        [pa.array(route.view(np.int64)), pa.array(name.view(np.int64)), pa.array(doc_id),
         pa.array(_place(text, start, settled))], names=["route", "name", "doc_id", "place"])


def _parse(docs: DataFrame, match: int) -> DataFrame:
    """Phrases of all documents (ROWS)."""
    def run(batches):
        for batch in batches:
            data, offsets = common.buffers(batch.column(2))
            ids, text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j in common.steps(offsets):
                marks = offsets[i:j + 1] - offsets[i]
                doc, start, _, kernel, name = phrases(data[offsets[i]:offsets[j]], marks, match)
                if len(doc):
                    yield _local(kernel, name, ids[i + doc], text[i + doc], start)

    return docs.mapInArrow(run, ROWS)


def _columns(batches):
    table = pa.Table.from_batches([b for b in batches if b.num_rows], schema=None)
    route, name, doc_id, place = (table.column(n).to_numpy() for n in ("route", "name", "doc_id", "place"))
    return route, name, doc_id, *_unplace(place)


_FLAGS = "doc_id long, text int, start int, n int, open boolean"


def _flags(doc_id, text, start, n, opened):
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id), pa.array(text), pa.array(start), pa.array(n.astype(np.int32)), pa.array(opened)],
        names=["doc_id", "text", "start", "n", "open"])


def _settle(parsed: DataFrame) -> DataFrame:
    """Repeated phrases, and the first occurrence of each content whose kernel
    has several contents (open)."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        route, name, doc_id, text, start, settled = _columns(batches)
        n = (name & int(_STARTS)).astype(np.int32)
        yield _flags(doc_id[settled], text[settled], start[settled], n[settled], np.zeros(settled.sum(), bool))
        rest = np.flatnonzero(~settled)
        if not len(rest):
            return
        by, new, later = _first_places([route[rest], name[rest]], doc_id[rest], start[rest])
        by = rest[by]
        kernel = route[by]
        edge = np.flatnonzero(np.r_[True, kernel[1:] != kernel[:-1]])
        several = np.repeat(np.add.reduceat(new.astype(np.int64), edge) > 1, np.diff(np.r_[edge, len(by)]))
        for mark, flag in ((later, False), (~later & several, True)):
            at = by[mark]
            yield _flags(doc_id[at], text[at], start[at], n[at], np.full(len(at), flag))

    return parsed.repartition("route").mapInArrow(run, _FLAGS)


def _suffixes(opened: DataFrame, match: int) -> DataFrame:
    """Names (ROWS) of the strings at every start of the open phrases."""
    def run(batches):
        for batch in batches:
            data, offsets = common.buffers(batch.column(2))
            ids, text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spans = batch.column(3)
            for i, j in common.steps(offsets):
                own = data[offsets[i]:offsets[j]]
                part = spans.slice(i, j - i)
                flat = part.flatten()
                doc = np.repeat(np.arange(i, j), pa.compute.list_value_length(part).to_numpy())
                first, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
                doc = np.repeat(doc, n)
                at = start + offsets[doc] - offsets[i]
                yield _local(_A.spans(_A.prefix(own), at, at + match), _B.spans(_B.prefix(own), at, at + match),
                             ids[doc], text[doc], start)

    return opened.mapInArrow(run, ROWS)


def _order(suffixes: DataFrame) -> DataFrame:
    """Starts whose string stands earlier too, consecutive ones joined."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        route, name, doc_id, text, start, settled = _columns(batches)
        by, _, later = _first_places([route, name], doc_id, start)
        at = by[later | settled[by]]
        doc, text, start = doc_id[at], text[at], start[at]
        order = np.lexsort([start, text, doc])
        doc, text, start = doc[order], text[order], start[order]
        if len(doc):
            cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
                                       | (start[1:] != start[:-1] + 1)])
            n = np.diff(np.r_[cut, len(doc)])
            yield _flags(doc[cut], text[cut], start[cut], n, np.zeros(len(cut), bool))

    return suffixes.repartition("route").mapInArrow(run, _FLAGS)


def _removal(match: int, keep_text: bool):
    fields = "doc_key long, text_key int, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches):
        for batch in batches:
            data, offsets = common.buffers(batch.column(2))
            rows, kept = [], []
            spans = batch.column(3).to_pylist()
            for i, own in enumerate(spans):
                text = data[offsets[i]:offsets[i + 1]]
                removed = pieces = 0
                if own:
                    gone = np.zeros(len(text) + 1, np.int32)
                    at = np.array([(s["start"], s["start"] + s["n"] - 1 + match) for s in own])
                    np.add.at(gone, at[:, 0], 1)
                    np.add.at(gone, at[:, 1], -1)
                    stays = np.cumsum(gone[:-1]) == 0
                    removed = int(len(text) - stays.sum())
                    pieces = int((~stays[:1]).sum() + (stays[:-1] & ~stays[1:]).sum())
                    text = text[stays]
                raw = text.tobytes()
                rows.append((len(offsets) and int(offsets[i + 1] - offsets[i]), removed, pieces,
                             hashlib.sha256(raw).hexdigest()))
                kept.append(raw)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            out = [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:3]),
                   pa.array(columns[3], pa.string())]
            names = ["doc_key", "text_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                out.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run, fields + (", kept binary" if keep_text else "")


#: Stands for a null doc_id, which sorts last.
_NULL = (1 << 63) - 1


def remove_repeats(docs: DataFrame, match: int = MATCH, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, n_bytes,
    n_removed, n_spans, kept_sha256 and, with ``keep_text``, kept (the
    remaining bytes).

    Null texts count as empty; texts shorter than ``match`` bytes lose nothing.
    A null doc_id comes after all others.  Rows that share a doc_id count as
    one document (their texts told apart by 32 bits): positions in them compare
    by start only, and repeated rows (same doc_id and text) are not copies of
    each other, they lose the same bytes.  Empty table: empty result.  Extra columns are ignored.
    """
    if match < SPAN + WIDTH:
        raise ValueError(f"match must be at least {SPAN + WIDTH}")
    keyed = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(_NULL)).cast("long").alias("doc_id"),
        F.hash("text").alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    long_ = keyed.where(F.octet_length("text") >= match)
    flags = common.written(_settle(_parse(long_, match)), "repeat-phrases")
    span = F.struct("start", "n").alias("span")

    def per_document(frame):
        return frame.select(F.col("doc_id").alias("d"), F.col("text").alias("k"), span).groupBy("d", "k").agg(
            F.collect_list("span").alias("spans"))

    opened = long_.join(per_document(flags.where("open")),
                        (F.col("doc_id") == F.col("d")) & (F.col("key") == F.col("k"))).drop("d", "k")
    # repeated rows name the same places: one of them is enough
    late = common.written(_order(_suffixes(opened, match)), "repeat-suffixes")
    all_ = per_document(flags.where("NOT open").unionByName(late))
    both = keyed.join(all_, (F.col("doc_id") == F.col("d")) & (F.col("key") == F.col("k")), "left").drop("d", "k")
    run, schema = _removal(match, keep_text)
    return both.mapInArrow(run, schema).withColumn(
        "doc_id", F.when(F.col("doc_key") != _NULL, F.col("doc_key"))).select(
            "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else []))


#: The query's rows by grouping every 100-byte string (hexadecimal, by md5).
ORACLE_SQL = r"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 99)) AS p, h FROM raw WHERE len(h) >= 200),
keyed AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM starts),
late AS (SELECT doc_id, p FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
steps AS (SELECT doc_id, p, lag(p) OVER d AS before, lead(p) OVER d AS after FROM late
  WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
edges AS (SELECT doc_id, CAST(sum(least(100, coalesce(after - p, 100))) AS BIGINT) AS n_removed,
  CAST(count(*) FILTER (before IS NULL OR p - before > 100) AS BIGINT) AS n_spans FROM steps GROUP BY doc_id),
kept AS (SELECT doc_id, p + 100 AS lo, after AS hi FROM steps WHERE after IS NULL OR after > p + 100
  UNION ALL SELECT doc_id, 0, p FROM steps WHERE before IS NULL),
texts AS (SELECT doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (coalesce(hi, len(h) // 2) - lo)), '' ORDER BY lo) AS left_over
  FROM kept JOIN raw USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM raw LEFT JOIN edges USING (doc_id) LEFT JOIN texts USING (doc_id)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.documents(spark, sf_dir), keep_text=False)
