import random
import re

import pytest

from reclab.llm import ngram_join as nj

from .helpers import awkward, clashing, empty, frame


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute(rows, width, percent):
    """By row number: (size, component id)."""
    sets = [shingles(t, width) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        k = find(i)
        least[k] = min(least.get(k, (2, 0)), (d is None, d or 0))
    return sorted(repr((d, len(sets[i]), None if least[find(i)][0] else least[find(i)][1]))
                  for i, (d, *_) in enumerate(rows))


def got(df):
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (1, 50)])
def test_awkward_rows(spark, width, percent):
    rows = awkward()
    df = nj.linked_components(clashing(spark, rows, "node", "a", "tokens"), width, percent)
    assert got(df) == brute(rows, width, percent)


@pytest.mark.parametrize("seed", range(2))
def test_chains_stars_and_strangers(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(nj, "BLOCK", 5)
    words = [f"w{i}" for i in range(400)]
    rows, at = [], 0
    for _ in range(4):  # chains: each text is a small step from the one before
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(12):
            rows.append((at, " ".join(text), None, None, 1))
            at += 1
            text[rng.randrange(60)] = rng.choice(words)
    base = [rng.choice(words) for _ in range(80)]
    for _ in range(30):  # a star: each text is a step from one base, some a longer one
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(80)] = rng.choice(words)
        rows.append((at, " ".join(text), None, None, 1))
        at += 1
    for _ in range(20):  # strangers that share a passage
        rows.append((at, " ".join(base[:20] + [rng.choice(words) for _ in range(rng.randint(5, 60))]), None, None, 1))
        at += 1
    rng.shuffle(rows)
    assert got(nj.linked_components(frame(spark, rows, 4), 4, 85)) == brute(rows, 4, 85)


def test_one_row_of_each_component_stays(spark):
    rows = awkward()
    docs = clashing(spark, rows, "set_a", "node")
    kept = nj.one_per_component(docs, 4, 85)
    assert kept.columns == docs.columns
    want = brute(rows, 4, 85)
    comps = {eval(w)[2] for w in want if eval(w)[1] > 0}
    empties = sum(eval(w)[1] == 0 for w in want)
    assert kept.count() == len(comps) + empties


def test_empty_table_and_no_shared_tokens(spark):
    assert nj.linked_components(empty(spark)).count() == 0
    assert nj.one_per_component(empty(spark)).count() == 0
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}", None, None, 1) for i in range(5)]
    assert got(nj.linked_components(frame(spark, rows))) == brute(rows, 5, 80)


def test_components_of_a_long_path(spark):
    from pyspark.sql import functions as F

    links = spark.range(60).select(
        F.struct(F.col("id").alias("a"), F.lit(0).cast("long").alias("c")).alias("u"),
        F.struct((F.col("id") + 1).alias("a"), F.lit(0).cast("long").alias("c")).alias("v"))
    rows = nj.components(links).collect()
    assert len(rows) == 60 and {r["comp"]["a"] for r in rows} == {0}


def test_long_regular_words_do_not_collide(spark):
    """A Thue-Morse word and its complement share nothing, at any length."""
    rows, want = [], {}
    for n in (64, 1024, 8192):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        word = "".join("ab"[b] for b in bits)
        other = "".join("ba"[b] for b in bits)
        rows += [(n, word, None, None, 1), (n + 1, other, None, None, 1), (n + 2, word.upper(), None, None, 1)]
        want |= {n: n, n + 1: n + 1, n + 2: n}
    found = {r.doc_id: r.component_id for r in nj.linked_components(frame(spark, rows)).collect()}
    assert found == want


def test_a_passage_in_unlike_documents_makes_few_pairs(spark):
    """Documents that share one passage, but are not similar, and some that are."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(60):
        own = [f"d{i}x{j}" for j in range(rng.choice([12, 14, 20]))]
        rows.append((i, " ".join(own[:6] + passage + own[6:]), None, None, 1))
        if i % 7 == 0:
            rows.append((100 + i, " ".join(own[:6] + passage + own[6:-1]), None, None, 1))
    assert got(nj.linked_components(frame(spark, rows))) == brute(rows, 5, 80)


@pytest.mark.parametrize("busy", [1, 6, 1000])
def test_common_tokens_in_blocks_or_in_pairs_give_the_same_links(spark, monkeypatch, busy):
    """Passages of several lengths over unlike texts, some of which are similar."""
    monkeypatch.setattr(nj, "BLOCK", 7)
    monkeypatch.setattr(nj, "BUSY", busy)
    rng = random.Random(busy)
    passages = [[f"p{k}x{i}" for i in range(n)] for k, n in enumerate((6, 12, 25))]
    rows = []
    for i in range(70):
        own = [f"d{i}x{j}" for j in range(rng.choice([4, 9, 16]))]
        for p in rng.sample(passages, rng.randint(1, 3)):
            own = own[:3] + p + own[3:]
        rows.append((i, " ".join(own), None, None, 1))
        if i % 5 == 0:
            own[rng.randrange(len(own))] = "other"
            rows.append((100 + i, " ".join(own), None, None, 1))
    want = brute(rows, 5, 60)
    assert len({eval(w)[2] for w in want}) < len(rows)
    assert got(nj.linked_components(frame(spark, rows), 5, 60)) == want


def test_own_names_do_not_clash(spark):
    docs = clashing(spark, awkward(), "_keep_id", "keep_id", "component_id", "rows")
    got = nj.one_per_component(docs, 4, 85)
    assert got.columns == docs.columns and got.count() == nj.one_per_component(frame(spark, awkward()), 4, 85).count()


def test_pools_move_each_node_once(spark):
    """Groups of the same nodes are compared once, and a node of a small group
    is sent once as text, not once a role as hashes."""
    from pyspark.sql import functions as F

    rows = [(n, home) for home in (1, 2, 3) for n in range(4)] + [(n, 4) for n in range(3)]
    groups = spark.createDataFrame(rows, "n long, h long").select(
        F.struct(F.col("n").alias("a"), F.col("n").alias("c")).alias("node"),
        F.struct(F.col("h").alias("a"), F.col("h").alias("c")).alias("home"))
    once = nj._distinct_groups(groups)
    assert sorted(r["h"] for r in once.select(F.col("home.a").alias("h")).collect()) == [1] * 4 + [4] * 3
    assert nj._self_roles(once).count() == 7
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words + ["x"]))], "doc_id long, text string")
    survey = nj._survey(docs, 4)
    nodes = survey.where("n > 0").select(F.struct("a", "c").alias("node"))
    assert {r["text"] for r in nj._texts(docs, survey, nodes, 4).collect()} == {
        r["text"] for r in docs.collect()}


def test_finished_steps_leave_no_shuffle_files(spark):
    from reclab.llm import common

    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    common.written(spark.range(1000).repartition(7, "id"), "step")
    assert tracker.shuffleStatuses().size() <= before
    assert spark.conf.get(common._CLEANUP) == "false"


def test_links_of_a_block_grow_with_its_nodes(spark):
    """Of 60 texts that all link with each other, no more links come than there
    are queries and members; they connect what all links would."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:i], "x", *words[i + 1:]]) for i in range(50)]
    apart = [" ".join(f"v{k}_{i}" for i in range(40)) for k in range(10)]
    rows = [(k, k + 1, 0, t) for k, t in enumerate(texts + apart)]
    df = spark.createDataFrame(rows, "a long, c long, block int, text string").selectExpr(
        "struct(a, c) AS node", "struct(0L AS a, 0L AS c) AS home", "block", "CAST(NULL AS BOOLEAN) AS query", "text")
    pairs = [(r.u.a, r.v.a) for r in nj._open(df.select("node", "text"), df.drop("text"), 60, 4).collect()]
    assert len(pairs) <= 2 * len(rows)
    reached, more = {0}, True
    while more:
        more = {x for p in pairs if set(p) & reached for x in p} - reached
        reached |= more
    assert reached == set(range(50)) and all(u < 50 and v < 50 for u, v in pairs)


def test_written_keeps_the_settings_of_the_session(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    assert nj._written(spark.range(3).toDF("u"), "three").count() == 3
    assert spark.conf.get(key) == before


def test_no_step_repeats_the_plan_of_another(spark, monkeypatch):
    """Every written step has the joins of its own work only: the plan of the
    last pools had 117 of them, which the driver held with all their stages."""
    joins = {}

    def written(df, name):
        joins[name] = max(joins.get(name, 0), df._jdf.queryExecution().analyzed().toString().count("Join "))
        return first(df, name)

    first = nj._written
    monkeypatch.setattr(nj, "_written", written)
    assert got(nj.linked_components(frame(spark, awkward()), 4, 85)) == brute(awkward(), 4, 85)
    assert max(joins.values()) <= 12, joins
