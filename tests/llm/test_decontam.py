import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cairnflow.llm.decontam import Automaton, decontaminate, drop_contaminated, words_of


def brute(words, items, window):
    hit, found = set(), set()
    for key, iw in items:
        wins = [iw[i : i + window] for i in range(len(iw) - window + 1)] if len(iw) >= window else [iw] if iw else []
        for w in wins:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(key)
    return hit, found


word = st.sampled_from([b"a", b"b", b"c"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(word, max_size=9), max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c", b"z"]), max_size=30), st.integers(1, 5))
def test_automaton(items, words, window):
    items = [(str(i), w) for i, w in enumerate(items)]
    spans, found = Automaton(items, window).matches(words)
    hit = {i for s, e in spans for i in range(s, e)}
    assert (hit, found) == brute(words, items, window)


def test_query_against_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(40)] + ["É", "naïve"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 12, 13, 30])))) for i in range(12)] + [(50, None), (51, "?!"), (2, "again w1 w2 w3")]
    docs = []
    for d in range(80):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 200))]
        if d % 3 == 0:
            iw = rng.choice(items)[1]
            w[len(w) // 2 : len(w) // 2] = (iw or "").upper().split()[: rng.choice([5, 14, 40])]
        docs.append((d, ", ".join(w), 0))
    docs += [(100, None, 1), (101, "", 1), (102, "...", 1), (103, items[4][1], 1), (103, items[4][1], 1), (None, "w1", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words int").repartition(4)
    it = spark.createDataFrame(items, "item_id long, text string")
    sets = [(str(k), words_of(t.encode() if t else None)) for k, t in items]
    for block, ship in ((400_000, 1 << 25), (20, 1 << 25), (20, 200)):
        rows = decontaminate(df, it, block_words=block, ship_bytes=ship).collect()
        assert len(rows) == len(docs)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
        for d, t, _ in docs:
            w = words_of(t.encode() if t else None)
            hit, found = brute(w, sets, 13)
            assert got[d] == (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)), d
    clean = {r.doc_id: r.clean for r in rows}
    assert not words_of(bytes(clean[103])) if len(words_of(items[4][1].encode())) else True


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate(docs.limit(0), items).count() == 0
    r = decontaminate(docs, items.limit(0)).first()
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)
    assert decontaminate(docs, items).first().contaminated


def test_twenty_blocks_are_one_map(spark):
    items = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(20))) for i in range(20)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x i{i}w3 " + " ".join(f"i{i % 20}w{k}" for k in range(i % 17))) for i in range(60)], "doc_id long, text string").selectExpr("*", "'mine' as __spans", "1 as spans", "2 as items", "3 as __k")
    nodes = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    one, many = decontaminate(docs, items), decontaminate(docs, items, block_words=20)
    assert nodes(one) == nodes(many) == 2
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    one, many = drop_contaminated(docs, items), drop_contaminated(docs, items, block_words=20)
    assert nodes(one) == nodes(many) == 2 and one.columns == docs.columns
    kept = sorted(r.doc_id for r in one.collect())
    assert kept == sorted(r.doc_id for r in many.collect()) == sorted(r.doc_id for r in drop_contaminated(docs, items, block_words=20, ship_bytes=100).collect())
    assert kept == [i for i in range(60) if i % 17 < 13] and {r["__spans"] for r in many.collect()} == {"mine"}


def test_very_long_text(spark):
    item = " ".join(f"w{k}" for k in range(13))
    docs = spark.createDataFrame([(1, "a " * 200_000 + item), (2, (item + " ") * 5000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {1: (200_013, 13, False), 2: (65_000, 65_000, True)}
