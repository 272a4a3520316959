"""N-gram Jaccard self-join with a token-group matrix.

Every text is its set of distinct word shingles.  Equal sets are one node.
Tokens are ordered from rare to frequent and a node is indexed by its first
tokens only: two sets that are similar enough must share one of these, so a
token held by one node needs no further thought.  Any order gives the same
links, so an approximate one will do: a counting sketch over all documents
tells the most frequent tokens, and a first index tells the tokens that it
finds at several nodes; the second index, made with both, is the one in use.

Groups: the nodes that share an indexed token are compared with the one among
them that shares most (the centre); nodes similar to a centre form its group.
Token-group matrix: per token, the groups whose members hold it.  A node is a
query to a group if they meet in the matrix and are not yet known to be
connected.

Bounds come before any set is moved.  A fixed quarter of the token space is
kept for every node as a short sketch; what two sketches share, plus what lies
outside them, bounds the overlap of the sets.  A query is bounded against a
group's centre: since 1 - Jaccard is a distance, a member within 1 - t of its
centre can only be within 1 - t of a query if the centre is within 2 (1 - t).
Groups that qualify are opened in blocks of bounded size; a block stores the
union of its members' tokens, which bounds the overlap of a query with each of
them once more, and only then are exact overlaps counted.  Nodes that are
similar to no centre are pooled by the centre they share most with, and once
more by each token that many of them hold; a pool's
blocks are compared sketch by sketch first, and only nodes that could link
bring their sets.  Copies and near
copies meet at their centre instead of in pairs, and no link between
different components is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SHINGLE, PERCENT = 5, 80
#: Cells of the counting sketch (its size on the driver and in each task is fixed).
SKETCH = 1 << 18
_PARTS = 64
#: A token that the first index finds at so many nodes is frequent; frequent
#: tokens are marked in a table of so many bits (two tokens may share one).
FREQUENT, MARKS = 8, 1 << 24
#: Members in a block of a group.
BLOCK = 400
#: A token that so many nodes outside groups hold has them compared in blocks
#: instead of in pairs; the links found are the same either way.
BUSY = 16
#: Tokens of queries that a task holds before it answers them.
HELD = 2_000_000
#: Sets remembered by a task so that copies are indexed once.
REMEMBER = 100_000

_HASH = common.RollingHash(10)
#: Longer words (bytes) are hashed whole: a polynomial modulo 2^64 loses bits on
#: long words of a regular build, whatever its base.
LONG_WORD = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_NOT_SPACE = (~common.SPACE).astype(np.uint8)
_ORDER = [np.uint64(c) for c in np.random.RandomState(4).randint(1, 1 << 62, 64, dtype=np.uint64) * 2 + 1]
_SIZE = np.uint64((1 << 24) - 1)
#: Documents whose sets are wanted are named to every task up to this many
#: (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_IDS = 200_000


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back.  Its joins shuffle both sides: the driver
    would hold every side that Spark finds small enough to broadcast, and one
    thread for each, through some sixty joins of which none stays small."""
    return common.written(df, name, common.SHUFFLED_JOINS)


def shingle_sets(array, width: int):
    """For each step of texts: (number of texts, sorted distinct shingle hashes
    of all, number of them per text)."""
    data, offsets = common.buffers(array)
    for i, j in common.steps(offsets):
        own = _LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, doc = common.runs(_NOT_SPACE[own], offsets[i:j + 1] - offsets[i])
        word = _HASH.spans(_HASH.prefix(own), starts, ends)
        for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            word[k] = int.from_bytes(hashlib.blake2b(own[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "big")
        words = np.bincount(doc, minlength=j - i)
        first = np.r_[0, np.cumsum(words)[:-1]]
        total = np.zeros(max(0, len(word) - width + 1), np.uint64)
        for k in range(width):
            total += word[k:k + len(total)] * _ORDER[k]
        inside = doc[:len(total)] == doc[width - 1:width - 1 + len(total)]
        full, owner = common.mix(total[inside]), doc[:len(total)][inside]
        short = np.flatnonzero((words > 0) & (words < width))
        if len(short):  # the whole sequence is the only shingle
            lone = common.mix(words[short].astype(np.uint64) * _ORDER[-1])
            for k in range(width - 1):
                has = words[short] > k
                lone[has] += word[first[short[has]] + k] * _ORDER[k]
            full, owner = np.r_[full, common.mix(lone)], np.r_[owner, short]
            by = np.argsort(owner, kind="stable")
            full, owner = full[by], owner[by]
        cuts = np.searchsorted(owner, np.arange(j - i + 1))
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            full[s:e].sort()
        new = np.ones(len(full), bool)
        new[1:] = (full[1:] != full[:-1]) | (owner[1:] != owner[:-1])
        yield j - i, full[new], np.bincount(owner[new], minlength=j - i)


def _name(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name of each set: 64 bits, and 40 more with the size (saturated) below."""
    full = np.flatnonzero(counts)
    a = np.zeros(len(counts), np.uint64)
    b = np.zeros(len(counts), np.uint64)
    if len(full):
        at = np.r_[0, np.cumsum(counts)[:-1]][full]
        a[full] = np.add.reduceat(common.mix(hashes ^ _ORDER[60]), at)
        b[full] = np.add.reduceat(common.mix(hashes ^ _ORDER[61]), at)
    size = np.minimum(counts.astype(np.uint64), _SIZE)
    return a.view(np.int64), ((b & ~_SIZE) | size).view(np.int64)


def _sketches(hashes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Of each sorted set: 16 bits of every token in the lowest quarter of the
    token space, in order."""
    low = hashes < np.uint64(1 << 62)
    value = ((hashes >> np.uint64(46)) & np.uint64(0xFFFF)).astype("<u2")
    ends = np.cumsum(counts)
    upto = np.r_[0, np.cumsum(low)]
    starts = ends - counts
    return [value[s:s + n].tobytes() for s, n in zip(
        starts.tolist(), (upto[ends] - upto[starts]).tolist(), strict=True)]


def _size(node: str):
    return F.col(f"{node}.c").bitwiseAND((1 << 24) - 1)


def _needed(n, percent):
    """Least overlap of a set of ``n`` tokens with a similar one."""
    return -(-n * percent // 100)


def _survey(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (doc_id, n, a, c, its sketch as data) and, from every
    task, the parts of its counting sketch."""
    def run(batches):
        counts = np.zeros(SKETCH, np.int64)
        for batch in batches:
            got = [(h, c) for _, h, c in shingle_sets(batch.column(1), width)]
            for h, _ in got:
                counts += np.bincount((h >> np.uint64(64 - 18)).astype(np.int64), minlength=SKETCH)
            names = [_name(h, c) for h, c in got]
            n = batch.num_rows
            a, c = (np.concatenate([x[k] for x in names]) if names else np.zeros(0, np.int64) for k in (0, 1))
            sizes = np.concatenate([x[1] for x in got]) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes.astype(np.int64)), pa.array(a), pa.array(c),
                pa.nulls(n, pa.int32()),
                pa.array([x for h, k in got for x in _sketches(h, k)], pa.binary())],
                names=["doc_id", "n", "a", "c", "part", "data"])
        parts = counts.reshape(_PARTS, -1)
        none = pa.nulls(_PARTS, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(range(_PARTS), pa.int32()),
             pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["doc_id", "n", "a", "c", "part", "data"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, a long, c long, part int, data binary")


def _tiers(survey: DataFrame) -> np.ndarray:
    """Frequency class of each sketch cell: 0 unless it clearly holds a frequent
    token.  A fixed number of cells reaches the driver."""
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.int64)
                sums[part] = sums[part] + own if part in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["part", "counts"])

    rows = (survey.where("part IS NOT NULL").select("part", "data").repartition("part")
            .mapInArrow(add, "part int, counts binary").collect())
    counts = np.zeros((_PARTS, SKETCH // _PARTS))
    for r in rows:
        counts[r["part"]] += np.frombuffer(r["counts"], np.int64)
    counts = counts.ravel()
    usual = np.median(counts)
    excess = counts - usual - 6 * np.sqrt(usual) - 8
    return np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)), 0).astype(np.uint8)


def _gather_bits(rows: DataFrame, part: str, data: str, size: int) -> np.ndarray:
    """The union of bit tables that arrive in numbered slices; ``size`` bytes
    reach the driver."""
    def union(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.uint8)
                held[k] = held[k] | own if k in held else own
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())],
                names=["part", "data"])

    out = np.zeros((_PARTS, size // _PARTS), np.uint8)
    for r in rows.select(F.col(part).alias("part"), F.col(data).alias("data")).repartition("part").mapInArrow(
            union, "part int, data binary").collect():
        out[r["part"]] |= np.frombuffer(r["data"], np.uint8)
    return out.ravel()


def _frequent(index: DataFrame) -> np.ndarray:
    """Bit table of the tokens that at least FREQUENT nodes of an index hold."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        token, a = table.column("token").to_numpy(), table.column("a").to_numpy()
        by = np.lexsort([a, token])
        token, a = token[by], a[by]
        new = np.r_[True, (token[1:] != token[:-1]) | (a[1:] != a[:-1])]
        token = token[new]
        edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
        often = token[edge[:-1]][np.diff(edge) >= FREQUENT] & (MARKS - 1)
        bits = np.zeros(MARKS // 8, np.uint8)
        np.bitwise_or.at(bits, often >> 3, np.left_shift(1, often & 7).astype(np.uint8))
        slices = bits.reshape(_PARTS, -1)
        used = np.flatnonzero(slices.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([slices[k].tobytes() for k in used], pa.binary())],
            names=["part", "data"])

    rows = index.select("token", "a").repartition("token").mapInArrow(run, "part int, data binary")
    return _gather_bits(rows, "part", "data", MARKS // 8)


def _index(docs: DataFrame, tiers: np.ndarray, marks: np.ndarray | None, width: int, percent: int) -> DataFrame:
    """(token, node) for the indexed tokens of every distinct set of a task."""
    shared = docs.sparkSession.sparkContext.broadcast((tiers, marks))  # SKETCH and MARKS / 8 bytes

    def run(batches):
        (tier, often), seen = shared.value, set()
        for batch in batches:
            for _, hashes, counts in shingle_sets(batch.column(0), width):
                a, c = _name(hashes, counts)
                rank = tier[(hashes >> np.uint64(64 - 18)).astype(np.int64)]
                if often is not None:
                    bit = (hashes & np.uint64(MARKS - 1)).astype(np.int64)
                    rank = np.maximum(rank, (often[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                ends = np.cumsum(counts)
                tokens, owners, sizes = [], [], []
                if len(seen) > REMEMBER:
                    seen = set()
                for k in np.flatnonzero(counts).tolist():
                    if (name := (int(a[k]), int(c[k]))) in seen:
                        continue
                    seen.add(name)
                    n = int(counts[k])
                    own, cls = hashes[ends[k] - n:ends[k]], rank[ends[k] - n:ends[k]]
                    if cls.any():
                        own = own[np.argsort(cls, kind="stable")]
                    tokens.append(own[:n - _needed(n, percent) + 1])
                    owners.append(k)
                    sizes.append(len(tokens[-1]))
                if tokens:
                    at = np.repeat(owners, sizes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(a[at]), pa.array(c[at])],
                        names=["token", "a", "c"])

    return docs.select("text").mapInArrow(run, "token long, a long, c long")


def _postings(index: DataFrame) -> DataFrame:
    """(token, node) of the tokens that at least two nodes hold."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        token, a, c = (table.column(k).to_numpy() for k in ("token", "a", "c"))
        once = np.argsort(token, kind="stable")
        token = token[once]
        edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
        many = np.repeat(np.diff(edge) > 1, np.diff(edge))
        token, a, c = token[many], a[once][many], c[once][many]
        by = np.lexsort([c, a, token])
        token, a, c = token[by], a[by], c[by]
        head = np.r_[True, token[1:] != token[:-1]] if len(token) else np.zeros(0, bool)
        new = head | np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(token) else head
        token, a, c = token[new], a[new], c[new]
        edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True]) if len(token) else np.zeros(1, int)
        many = np.repeat(np.diff(edge) > 1, np.diff(edge))
        yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (token, a, c)], names=["token", "a", "c"])

    return index.repartition("token").mapInArrow(run, "token long, a long, c long").select(
        "token", F.struct("a", "c").alias("node"))


def _chosen(survey: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, z, i): the least document of each wanted node, i its id (z: null)."""
    known = survey.where("part IS NULL AND n > 0").select("doc_id", F.struct("a", "c").alias("node"))
    return known.groupBy("node").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(-1)).alias("i"))).alias("k")).join(
            nodes, "node", "left_semi").select("node", "k.z", "k.i")


def _sketch_table(survey: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, sketch) of the wanted nodes."""
    rows = survey.where("part IS NULL AND n > 0").select(
        F.struct("a", "c").alias("node"), F.col("doc_id").isNull().alias("z"),
        F.coalesce("doc_id", F.lit(-1)).alias("i"), F.col("data").alias("sketch"))
    return rows.join(_chosen(survey, nodes), ["node", "z", "i"], "left_semi").dropDuplicates(["node"]).select(
        "node", "sketch")


def _bounded(pairs: DataFrame, sketches: DataFrame, left: str, right: str) -> DataFrame:
    """The rows of ``pairs`` (two node columns, ``least`` percent) whose sketches
    allow a Jaccard similarity of at least ``least``."""
    columns = pairs.columns
    joined = pairs.join(sketches.select(F.col("node").alias(left), F.col("sketch").alias("sketch_l")), left).join(
        sketches.select(F.col("node").alias(right), F.col("sketch").alias("sketch_r")), right)
    joined = joined.select(*columns, _size(left).alias("size_l"), _size(right).alias("size_r"),
                           "sketch_l", "sketch_r")
    at = {n: k for k, n in enumerate(joined.columns)}
    full = int(_SIZE)

    def run(batches):
        for batch in batches:
            x, y = batch.column(at["size_l"]).to_numpy(), batch.column(at["size_r"]).to_numpy()
            least = batch.column(at["least"]).to_numpy()
            keep = (x >= full) | (y >= full) | (least <= 0)
            a, b = batch.column(at["sketch_l"]), batch.column(at["sketch_r"])
            needed = -(-(least * (x + y)) // (100 + least))
            for k in np.flatnonzero(~keep).tolist():
                p, q = (np.frombuffer(v[k].as_buffer(), "<u2") for v in (a, b))
                rest = min(x[k] - len(p), y[k] - len(q))
                if rest + min(len(p), len(q)) < needed[k]:
                    continue
                if len(p) and len(q):  # tokens of a value in both, as often as in either
                    value, n = np.unique(p, return_counts=True)
                    rest += int(np.minimum(n, np.searchsorted(q, value, "right") - np.searchsorted(q, value)).sum())
                keep[k] = rest >= needed[k]
            yield batch.filter(pa.array(keep)).select(columns)

    return joined.mapInArrow(run, pairs.schema)


def _texts(docs: DataFrame, survey: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, text) of the wanted nodes, from one document of each.  A text is
    moved instead of its set, whose hashes take several times its space; the
    task that compares sets makes them again."""
    ids = _written(_chosen(survey, nodes).select("z", "i").distinct(), "set-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("i"),
                        F.col("doc_id").isNull().alias("z"), "text").join(ids, ["i", "z"], "left_semi")

    def run(batches):
        seen = set()
        for batch in batches:
            at = 0
            for n, hashes, counts in shingle_sets(batch.column(0), width):
                a, c = _name(hashes, counts)
                if len(seen) > REMEMBER:
                    seen = set()
                keep = []
                for k in np.flatnonzero(counts).tolist():
                    if (name := (int(a[k]), int(c[k]))) not in seen:
                        seen.add(name)
                        keep.append(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[keep]), pa.array(c[keep]),
                     batch.column(0).take(pa.array([at + k for k in keep], pa.int64()))],
                    names=["a", "c", "text"])
                at += n

    return texts.select("text").mapInArrow(run, "a long, c long, text string").select(
        F.struct("a", "c").alias("node"), "text")


def _each_set(texts, width: int):
    """The sorted shingle hashes of every text of a column, one after another."""
    for _, hashes, counts in shingle_sets(texts, width):
        ends = np.cumsum(counts)
        for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            yield hashes[start:end].copy()  # of its own: a member outlives its step


_OPENED = "qa long, qc long, ma long, mc long"


def _open(held_by: DataFrame, roles: DataFrame, percent: int, width: int, sketched: bool = False) -> DataFrame:
    """Links (u, v) between the queries and members of each block.  ``held_by``:
    node and its text; ``roles``: node, home, block, query (boolean; null: both
    a query and a member); members are bounded in number.  Every query is
    compared with every member; of the links of a query, one to each set of
    members that the links before it do not connect yet is returned, so a
    block gives no more links than it has queries and members, and connects
    what all its links would.

    ``sketched``: sketches come instead of texts, and the result is (node, home)
    of the nodes whose sketch allows a link with another of their block."""
    kind = "<u2" if sketched else np.uint64

    def links(members, queries):
        names = np.array([m[0] for m in members])
        held = np.array([len(m[1]) for m in members])
        sizes = names[:, 1] & int(_SIZE) if sketched else held
        tokens = np.concatenate([m[1] for m in members])
        owner = np.repeat(np.arange(len(members)), held)
        if not len(tokens):
            tokens, owner = np.zeros(1, kind), np.zeros(1, np.int64)  # counts too much, which a bound may
        by = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[by], owner[by]
        edge = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1], True])
        union = tokens[edge[:-1]]
        tied = np.arange(len(members))  # members with the same number are connected
        for name, own in queries:
            at = np.minimum(np.searchsorted(union, own), len(union) - 1)
            at = at[union[at] == own]
            if not sketched and len(at) < _needed(len(own), percent):  # no member can overlap enough
                continue
            n = edge[at + 1] - edge[at]
            spot = np.repeat(edge[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(owner[spot], minlength=len(members))
            n_own = len(own)
            if sketched:  # what lies outside the sketches may all be shared
                n_own = name[1] & int(_SIZE)
                both = np.minimum(both + np.minimum(n_own - len(own), sizes - held), np.minimum(n_own, sizes))
            fits = 100 * both >= percent * (sizes + n_own - both)
            if sketched:
                fits |= (sizes >= int(_SIZE)) | (n_own >= int(_SIZE))
            near = np.flatnonzero(fits & (names != name).any(1))
            if sketched:
                near = near[:1]
            elif len(near):
                sets, first = np.unique(tied[near], return_index=True)
                tied[np.isin(tied, sets)] = sets[0]
                near = near[first]
            for k in near.tolist():
                yield (*name, *names[k].tolist())

    def run(batches):
        key, members, waiting, held = None, [], [], 0

        def flush():
            if not members or not waiting:
                return None
            rows = list(links(members, waiting))
            if not rows:
                return None
            if sketched:
                rows = [(*r[:2], key[0], key[1]) for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["qa", "qc", "ma", "mc"])

        for batch in batches:
            col = [batch.column(i).to_pylist() for i in range(6)]
            sets = ((np.frombuffer(v.as_buffer(), kind) for v in batch.column(6)) if sketched
                    else _each_set(batch.column(6), width))
            for i, own in enumerate(sets):
                here = (col[0][i], col[1][i], col[2][i])
                if here != key:
                    out = flush()
                    if out is not None:
                        yield out
                    key, members, waiting, held = here, [], [], 0
                entry = ((col[4][i], col[5][i]), own)
                if not col[3][i]:
                    if not members or members[-1][0] != entry[0]:  # a repeated row gives its set again
                        members.append(entry)
                        if col[3][i] is None:
                            waiting.append(entry)
                elif not waiting or waiting[-1][0] != entry[0]:
                    waiting.append(entry)
                    held += len(entry[1])
                    if held >= HELD:
                        out = flush()
                        if out is not None:
                            yield out
                        waiting, held = [], 0
        out = flush()
        if out is not None:
            yield out

    placed = roles.join(held_by, "node").select(
        F.col("home.a").alias("ha"), F.col("home.c").alias("hc"), "block", "query",
        F.col("node.a").alias("a"), F.col("node.c").alias("c"), "sketch" if sketched else "text")
    found = placed.repartition("ha", "hc", "block").sortWithinPartitions(
        "ha", "hc", "block", "query", "a", "c").mapInArrow(run, _OPENED)
    if sketched:
        return found.select(F.struct(F.col("qa").alias("a"), F.col("qc").alias("c")).alias("node"),
                            F.struct(F.col("ma").alias("a"), F.col("mc").alias("c")).alias("home")).distinct()
    return found.select(F.struct(F.col("qa").alias("a"), F.col("qc").alias("c")).alias("u"),
                        F.struct(F.col("ma").alias("a"), F.col("mc").alias("c")).alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (u, v) that is not the least of
    its connected component; comp is that least node.

    Alternates large-star and small-star steps: every node hands its
    neighbours to the least of them, until only stars are left (a number of
    rounds that grows with the logarithm of the component's size).
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = _written(links.where("u != v").select(high.alias("u"), low.alias("v")).distinct(), "edges")

    def summary():
        return edges.agg(F.count(F.lit(1)).alias("n"),
                         F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()

    state = summary()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select(
            "e.u", "e.v").where("u != v").distinct()
        edges = _written(small, "edges")
        now = summary()
        if now == state:  # stars only
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = now


def _compatible(percent, a, b):
    """Sizes that allow a link; saturated sizes always do."""
    full = F.lit((1 << 24) - 1)
    return (a >= full) | (b >= full) | ((100 * a >= percent * b) & (100 * b >= percent * a))


def _distinct_groups(groups: DataFrame) -> DataFrame:
    """Rows (node, home) without the groups that hold the same nodes as another:
    documents with several passages in common meet at tokens of each."""
    held = groups.groupBy("home").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.xxhash64(F.lit(k), "node").cast("decimal(38,0)")).alias(f"s{k}") for k in (0, 1)])
    kept = held.groupBy("n", "s0", "s1").agg(F.min("home").alias("home")).select("home")
    return groups.join(kept, "home", "left_semi")


def _self_roles(groups: DataFrame) -> DataFrame:
    """Roles that compare the nodes of each group (node, home) with each other:
    in a group of one block a row stands for both roles (``query`` is null); of
    a larger one, members are dealt to blocks and every node is a query to all
    of them."""
    sized = groups.join(groups.groupBy("home").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"), "home")
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")

    def role(block, query):
        return F.struct(block.cast("int").alias("block"), F.lit(query).cast("boolean").alias("query"))

    dealt = F.concat(F.array(role(F.pmod(F.xxhash64("node"), blocks), False)),
                     F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: role(b, True)))
    return sized.select("node", "home", F.explode(
        F.when(F.col("crowd") <= BLOCK, F.array(role(F.lit(0), None))).otherwise(dealt)).alias("r")).select(
            "node", "home", "r.block", "r.query")


def node_links(docs: DataFrame, survey: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) that connect the nodes as all links between different sets
    would."""
    tiers = _tiers(survey)
    marks = _frequent(_index(docs, tiers, None, width, percent))
    posts = _written(_postings(_index(docs, tiers, marks, width, percent)), "postings")
    # the centre of a token: the node that shares the largest part of its index
    size = _size("node")
    indexed = size - F.ceil(size * percent / 100) + 1
    share = posts.groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    rated = share.select("node", F.floor(F.least(F.lit(1000), 1000 * F.col("shared") / indexed)).alias("rate"))
    centre = posts.join(rated, "node").groupBy("token").agg(
        F.max(F.struct("rate", "node")).alias("m")).select("token", F.col("m.node").alias("centre"))
    stars = _written(posts.join(centre, "token").groupBy("node", "centre").agg(
        F.count(F.lit(1)).alias("common")), "stars")
    sketches = _written(_sketch_table(survey, share.select("node")), "sketches")
    tries = stars.select("node", "centre").where((F.col("node") != F.col("centre")) & _compatible(percent, _size("node"), _size("centre")))
    tries = _written(_bounded(
        tries.withColumn("least", F.lit(percent).cast("long")), sketches, "node", "centre"), "tries")
    block = F.lit(0).alias("block")
    roles = tries.select("node", F.col("centre").alias("home"), block, F.lit(True).alias("query")).unionByName(
        tries.select(F.col("centre").alias("node"), F.col("centre").alias("home"), block,
                     F.lit(False).alias("query")).distinct())
    roles = _written(roles, "roles")
    first = _written(_open(_texts(docs, survey, roles.select("node"), width), roles, percent, width), "links")
    comps = components(first)
    # a node's group: itself if a centre, else the least centre it is similar to,
    # else itself; its pool: the centre it shares most with
    centres = stars.where("node = centre").select("node").distinct().withColumn("is_centre", F.lit(True))
    joined = first.select(F.col("u").alias("node"), F.col("v").alias("home")).groupBy("node").agg(
        F.min("home").alias("near"))
    pools = stars.groupBy("node").agg(F.max(F.struct("common", F.col("centre").alias("pool"))).alias("p")).select(
        "node", F.col("p.pool").alias("pool"))
    homes = _written(
        pools.join(centres, "node", "left").join(joined, "node", "left").join(comps, "node", "left")
        .select("node", "pool",
                F.when(F.col("is_centre"), F.col("node")).otherwise(F.coalesce("near", "node")).alias("home"),
                F.coalesce("comp", "node").alias("comp")), "homes")
    crowd = _written(homes.groupBy("home").agg(
        F.count(F.lit(1)).alias("crowd"), F.min(_size("node")).alias("n0"), F.max(_size("node")).alias("n1"),
        F.min("pool").alias("group_pool")), "groups")
    alone = homes.join(crowd.where("crowd = 1").select("home"), "home", "left_semi").select(
        "node", F.col("pool").alias("home"))
    # the token-group matrix (members of a group are one component), only where
    # a token still sees two components
    held = posts.join(homes, "node")
    split = held.groupBy("token").agg(F.min("comp").alias("t0"), F.max("comp").alias("t1")).where(
        "t0 != t1").select("token")
    matrix = held.join(split, "token", "left_semi")
    # a node and a group meet in a run of tokens (a passage that both hold) once, at
    # its first: where the token before is the same on both sides they met there
    matrix = _written(matrix.withColumn("before", F.lag("token").over(
        Window.partitionBy("node").orderBy("token"))), "matrix")
    # nodes that are groups of their own and hold a common token are compared in
    # blocks, like a pool; not where all of them met at the token before
    singles = matrix.join(alone.select("node"), "node", "left_semi")
    busy = _written(singles.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.count("before").alias("n_before"), F.min("before").alias("b0"),
        F.max("before").alias("b1")).where(F.col("n") > BUSY), "busy-tokens")
    opened = busy.where(~F.coalesce((F.col("n_before") == F.col("n")) & (F.col("b0") == F.col("b1")), F.lit(False)))
    # each step here reads its input several times: written in between, else the
    # plan of the last would hold that of the first some twenty times over
    alone = _written(alone.unionByName(singles.join(opened.select("token"), "token").select(
        "node", F.struct(F.col("token").alias("a"), F.lit(-1).cast("long").alias("c")).alias("home"))), "alone")
    pools = _written(_self_roles(_written(_distinct_groups(alone), "pools")), "roles")
    could = _written(_open(sketches, pools, percent, width, sketched=True), "could-link")
    roles = _written(_self_roles(_written(_distinct_groups(could), "pooled")), "roles")
    pooled = _open(_texts(docs, survey, roles.select("node"), width), roles, percent, width)
    cells = matrix.groupBy("token", "home", F.col("comp").alias("group_comp")).agg(F.when(
        (F.count("before") == F.count(F.lit(1))) & (F.min("before") == F.max("before")), F.min("before")).alias(
            "group_before")).join(crowd, "home")
    # where a token is busy its cells of one node have been compared: they go before the join
    cells = cells.join(busy.select("token", F.lit(True).alias("busy")), "token", "left").where(
        (F.col("crowd") > 1) | F.col("busy").isNull()).drop("busy")
    asking = matrix.select("token", "before", "node", "comp", "pool", F.col("home").alias("from")).join(
        crowd.select(F.col("home").alias("from"), F.col("crowd").alias("mine")), "from")
    full = F.lit(int(_SIZE))
    n = _size("node")
    meets = (100 * F.col("n1") >= percent * n) & (100 * n >= percent * F.col("n0"))
    smaller = (F.struct(F.col("mine").alias("m"), F.col("from").alias("h"))
               < F.struct(F.col("crowd").alias("m"), F.col("home").alias("h")))
    queries = asking.join(cells, "token").where(
        (F.col("comp") != F.col("group_comp")) & smaller
        & ~F.coalesce(F.col("before") == F.col("group_before"), F.lit(False))
        & ~((F.col("mine") == 1) & (F.col("crowd") == 1) & (F.col("pool") == F.col("group_pool"))) & (meets | (n >= full) | (F.col("n1") >= full))).select(
            "node", "home", "crowd").distinct()
    # a group of one is its centre; members of a larger one are near theirs
    queries = queries.withColumn("least", F.when(F.col("crowd") == 1, percent).otherwise(
        max(0, 2 * percent - 100)).cast("long"))
    queries = _written(_bounded(queries, sketches, "node", "home"), "queries")
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    asked = queries.select("home", "crowd").distinct()
    members = homes.join(asked, "home").select(
        "node", "home", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), F.lit(False).alias("query"))
    callers = queries.select("node", "home", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
                             F.lit(True).alias("query"))
    roles = _written(members.unionByName(callers), "roles")
    second = _open(_texts(docs, survey, roles.select("node"), width), roles, percent, width)
    return first.unionByName(_written(pooled.unionByName(second), "links"))


def linked_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text): doc_id, n_shingles,
    component_id, a, c (the two words that name its set).

    Words are maximal runs of characters other than [\\x20\\x09-\\x0D], with A-Z
    lower-cased; a text with fewer than ``width`` words has one shingle, its
    whole sequence; one without words (or null) has none, links with nothing
    and is its own component.  Two documents link when 100 * shared >= percent
    * united; component_id is the least doc_id reachable (null ids last).
    Repeated rows and equal texts have equal sets and so one component.  Empty
    table: empty result.  Extra columns are ignored.
    """
    if not 1 <= percent <= 100 or not 1 <= width <= 32:
        raise ValueError("percent must be from 1 to 100, width from 1 to 32")
    survey = _written(_survey(docs, width), "shingle-sets")
    comps = components(node_links(docs, survey, width, percent))
    rows = survey.where("part IS NULL").select("doc_id", "n", "a", "c", F.struct("a", "c").alias("node"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"))).alias("k")
    nodes = rows.where("n > 0").groupBy("node").agg(best)
    placed = _written(nodes.join(comps, "node", "left").select(
        "node", "k", F.coalesce("comp", "node").alias("comp")), "components")
    least = placed.groupBy("comp").agg(F.min("k").alias("least"))
    ids = placed.join(least, "comp").select("node", F.col("least.i").alias("component"), F.lit(True).alias("known"))
    return rows.join(ids, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("known") & (F.col("n") > 0), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        "a", "c")


def one_per_component(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one whose
    doc_id is the component's (of several such rows, one with the least set
    name).  Rows without words all stay."""
    names = [common.free_name(docs, n) for n in ("set_a", "set_c")]
    keep_id, keep_a, keep_c, copies = (common.free_name(docs, n) for n in ("keep_id", "keep_a", "keep_c", "keep_rows"))
    found = linked_components(docs, width, percent).where("n_shingles > 0")
    least = found.groupBy("component_id").agg(
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.struct("a", "c"))).alias("s")).select(
            "component_id", F.col("s.a").alias("least_a"), F.col("s.c").alias("least_c"))
    counted = found.groupBy("doc_id", "a", "c").agg(F.count(F.lit(1)).alias("rows"))
    keep = least.join(counted, F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("least_a") == F.col("a"))
                      & (F.col("least_c") == F.col("c"))).select(
        F.col("component_id").alias(keep_id), F.col("a").alias(keep_a), F.col("c").alias(keep_c),
        F.col("rows").alias(copies))
    keep = _written(keep, "kept-sets")

    def make(array):
        got = [_name(h, c) for _, h, c in shingle_sets(array, width)]
        return [pa.array(np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64)) for k in (0, 1)]

    from pyspark.sql import types as T

    rows = common.append_columns(docs, make, [(n, T.LongType()) for n in names])
    empty = rows.where(F.col(names[1]).bitwiseAND((1 << 24) - 1) == 0).select(*docs.columns)
    kept = rows.join(keep, F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(names[0]) == F.col(keep_a))
                     & (F.col(names[1]) == F.col(keep_c)))
    once = kept.where(F.col(copies) == 1).select(*docs.columns)
    repeated = kept.where(F.col(copies) > 1).dropDuplicates(names).select(*docs.columns)
    return once.unionByName(repeated).unionByName(empty)


#: The query's rows by an inverted list of shingles and the closure of the links.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s FROM words),
held AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS shingle FROM sets),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b FROM held x JOIN held y USING (shingle) WHERE x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON r.b = p.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce((SELECT min(b) FROM reached WHERE a = doc_id), doc_id)) AS component_id FROM sets
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(common.documents(spark, sf_dir), 4, 85).drop("a", "c")
