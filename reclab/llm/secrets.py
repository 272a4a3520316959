"""Secret scans by multipart credential linking (DataFrame functions only).

Base kinds are found in every text and always reported.  Credentials often come
in parts that mean nothing alone, so three weak kinds are looked for as well:
an identifier (``user = ...``), a bare secret (a long mixed token) and an
endpoint (a URL or ``host = ...``).  Candidates are joined as intervals within
a scope of code points: a weak candidate is reported only when parts of all
the other roles that make up a credential (identifier + secret, or endpoint +
secret) lie within its scope, measured between the nearer ends; base findings take part as secrets (assign,
hex) and identifiers (access).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Code points on either side within which parts belong together.
SCOPE = 240
#: Matches of a text that are placed one after another at a time.
WALK = 256

_ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
           r"([A-Za-z0-9+/_.=-]+)")
_URL = r"""(?:jdbc:)?[a-z][a-z0-9+]{1,31}+://[^\s"'<>]{3,}"""
#: name, pattern, group whose length counts, least length, role, always reported.
#: A maximal run that is too short cannot hold a long one, so for access and hex
#: the least length is part of the pattern; a short assign match still uses up
#: its text and is dropped afterwards.
BASE = [
    ("assign", _ASSIGN, 2, 12, "secret"),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18, "identifier"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, "secret"),
]
WEAK = [
    ("user", r"""(?i)\b(?:user(?:name|_?id)?|login|account|client_?id)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9@._-]{3,}""",
     0, 0, "identifier"),
    ("bare", r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])(?=[a-z0-9+/]*+[A-Z])(?=[A-Z0-9+/]*+[a-z])"
     r"[A-Za-z0-9+/]{20,}+",
     0, 0, "secret"),
    ("endpoint", rf"""(?i){_URL}|(?<![a-z0-9])(?:host(?:_?name)?|server(?:_?name)?|endpoint)["']?\x20{{0,4}}[:=]\x20{{0,4}}["']?"""
     rf"""(?:{_URL}|[a-z0-9\[][a-z0-9._:\]-]{{2,}})""", 0, 0, "endpoint"),
]
KINDS = [k[0] for k in BASE + WEAK]


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, m>> (code points,
    end exclusive; the matched string).  The text splits into the gaps between
    matches, so lengths of gaps and matches add up to positions."""
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")
    # one element per match, evaluated once: the gap before it and the match
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, found: F.struct(gap.alias("gap"), found.alias("m")))

    steps = F.filter(steps, lambda x: x["m"].isNotNull())

    def place(state, step):
        start = state["at"] + F.length(step["gap"])
        end = start + F.length(step["m"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(
            start.alias("s"), end.alias("e"), step["m"].alias("m")))).alias("out"))

    def walked(some, at):
        return F.aggregate(some, F.struct(at.alias("at"), empty.alias("out")), place, lambda st: st["out"])

    # a growing array is copied at each step, so many matches are walked in
    # blocks, each from the sum of the lengths before it
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(steps) / WALK).cast("int") - 1),
                         lambda i: F.slice(steps, i * WALK + 1, WALK))

    def add(state, block):
        size = F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["m"]))
        return F.struct((state["at"] + size).alias("at"), F.concat(
            state["out"], F.array(F.struct(state["at"].alias("at"), block.alias("block")))).alias("out"))

    def many(dealt):
        starts = F.aggregate(dealt, F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<at:int,block:array<struct<gap:string,m:string>>>>").alias("out")), add, lambda st: st["out"])
        return F.flatten(F.transform(starts, lambda x: walked(x["block"], x["at"])))

    return F.when(~text.rlike(pattern), empty).when(F.size(steps) <= WALK, walked(steps, F.lit(0))).otherwise(
        many(blocks))


def _long_enough(found: Column, pattern: str, group: int, least: int) -> Column:
    return F.filter(found, lambda m: F.length(F.regexp_extract(m["m"], pattern, group)) >= least)


def _typed(found: Column, kind: int, role: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["s"].alias("s"), m["e"].alias("e"), F.lit(kind).alias("kind"), F.lit(role).alias("role")))


def candidates(text: Column) -> Column:
    """All candidates of a text as array<struct<s, e, kind, role>>; kind counts
    the order in KINDS."""
    out = []
    for i, (_, pattern, group, least, role) in enumerate(BASE + WEAK):
        found = matches(text, pattern)
        if group:
            found = _long_enough(found, pattern, group, least)
        out.append(_typed(found, i, role))
    return reduce(lambda a, b: F.concat(a, b), out)


def _spans(items: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text needed, others ignored):
    doc_id, n_assign, n_access, n_hex, n_linked (weak candidates reported),
    base (array of kind, start, end), found (the same with linked weak ones).

    Null text counts as empty; a text without findings gets zeros and empty
    arrays.  Repeated rows and null ids are scanned each for itself.  Ties
    (several candidates at one start) go by kind.  Empty table: empty result.
    """
    numbered = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", candidates(F.col("text")).alias("c"))
    rows = numbered.select("row", "doc_id", F.explode_outer("c").alias("c")).select(
        "row", "doc_id", "c.s", "c.e", "c.kind", "c.role")
    # the gap to earlier candidates (greatest end so far) and to later ones (least start)
    earlier = Window.partitionBy("row").orderBy("s").rangeBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("row").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, 0)

    def close(role):
        own = F.col("role") == role
        before = F.col("s") - F.max(F.when(own, F.col("e"))).over(earlier) <= scope
        after = F.min(F.when(own, F.col("s"))).over(later) - F.col("e") <= scope
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    rows = rows.withColumns({"i": close("identifier"), "x": close("secret"), "p": close("endpoint")})
    base = F.col("kind") < len(BASE)
    linked = F.when(F.col("role") == "secret", F.col("i") | F.col("p")).otherwise(F.col("x"))
    item = F.struct("s", "kind", "e")
    return rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS[:len(BASE)])],
        F.count(F.when(~base & linked, 1)).alias("n_linked"),
        F.collect_list(F.when(base, item)).alias("base"),
        F.collect_list(F.when(base | linked, item)).alias("found")).drop("row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _spans(F.col("found")).alias("spans"), "n_linked")
