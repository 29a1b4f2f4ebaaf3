import random
from itertools import permutations

from cairnflow.llm.common import pieces
from cairnflow.llm.filter_audit import document_masks, filter_audit, mask_cells, plain_changes, text_mask

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def fails(rows):
    """The failed filters of every row, told letter by letter."""
    import re

    out = []
    for d, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        f |= {"E"} if any(o is not None and d is not None and o < d and (x or "") == t for o, x, _ in rows) else set()
        out.append(f)
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    every = list(zip(rows, fails(rows)))
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(r, f) for r, f in every if (r[2] or "") == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(r, f) for r, f in left if x in f]
                left = [(r, f) for r, f in left if x not in f]
                shares[x] += len(gone)
                n = sum(x in f for _, f in own)
                out[part, "".join(order), step] = [len(left), len(gone), n - len(gone), sum(f == {x} for _, f in own), sum(r[0] in good for r, _ in gone), sum(r[0] in toxic for r, _ in gone)]
        for (p, o, s), v in out.items():
            if p == part:
                v.append(shares[o[s - 1]])
    return out


def make_rows():
    rng = random.Random(11)
    words = [f"wörd{i}" for i in range(400)] + ["Big", "SHOUT", "a#b", "c|d", "é\xa0x", "\x85"]
    rows = []
    for d in range(120):
        n = rng.choice([0, 5, 199, 200, 260])
        pool = words[: rng.choice([20, 120, 400])] if rng.random() < 0.7 else words
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(rng.choice(pool) for _ in range(n)), rng.choice(["en", "de", None, ""])))
    copied = [(200 + k, rows[rng.randrange(60)][1], rng.choice(["en", "de"])) for k in range(60)]
    edge = [(300, None, "en"), (301, "", None), (None, rows[3][1], "en"), (None, None, "en"), (5, rows[5][1], "en"), (5, rows[7][1], "de"), (302, "x " * 300_000 + "END", "xx"), (303, "y" * 3_000_000, "xx")]
    return rows + copied + edge


def test_against_brute_force(spark):
    rows = make_rows()
    labels = [(d, d % 3 % 2, 1 if d % 7 == 0 else 0) for d in range(0, 260, 2)] + [(4, None, None), (6, 1, 1), (6, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7).selectExpr("*", "1 as part", "2 as mask", "3 as key", "4 as n", "5 as good", "6 as toxic")
    got = filter_audit(docs, spark.createDataFrame(labels, LABELS))
    assert [t for _, t in got.dtypes] == ["string", "string", "int"] + ["bigint"] * 7
    want = brute(rows, labels)
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got.collect()}
    assert found == want and len(found) == 600 * len({p or "" for _, _, p in rows})


def test_cells_count_every_row_once_and_hot_copies(spark):
    rows = [(d, "same text", "en") for d in range(3000)] + [(d, "same text", "de") for d in range(0, 10)] + [(None, "same text", "en")] * 5
    labels = spark.createDataFrame([], LABELS)
    cells = mask_cells(document_masks(spark.createDataFrame(rows, DOCS).repartition(9), labels))
    got = {(r.part, r.mask): r.n for r in cells.collect() if r.n}
    # doc_id 0 is there twice, in both parts: neither has a strictly smaller one
    assert got == {("en", 1): 1 + 5, ("en", 17): 2999, ("de", 1): 1, ("de", 17): 9}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit(spark.createDataFrame([], DOCS), labels).count() == 0
    one = filter_audit(spark.createDataFrame([(None, None, None)], DOCS), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}
    assert {(r.removed, r.kept) for r in one if r.filter_order[r.step - 1] == "A"} == {(1, 0)}


def test_orders_differ_by_one_swap_and_cover_all():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(permutations(range(n))))


def test_pieces_keep_words_whole():
    rng = random.Random(2)
    for _ in range(200):
        text = b"".join(rng.choice([b"ab", b"c", b" ", b"\n", b"\t", "é".encode()]) for _ in range(rng.randrange(60)))
        cut = list(pieces(text, rng.randrange(1, 9)))
        assert b"".join(cut) == text and [w for c in cut for w in c.split()] == text.split()
    assert text_mask(b"word " * 400_000) == 2
