import hashlib
import random

from cairnflow.llm.lines import apply_bitmaps, drop_common_lines, line_bitmaps, line_digest

SCHEMA = "doc_id long, text string, n_dropped string"
BLANK = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    def key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(BLANK))

    held = {}
    for d, t, _ in rows:
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(d)
    out = {}
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and d != max(held[key(x)]))]
        out[d] = (len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest())
    return out


def make_rows():
    rng = random.Random(4)
    pool = [f"Line É {i} " + "x" * rng.randrange(20, 50) for i in range(12)]
    rows = []
    for d in range(80):
        lines = []
        for _ in range(rng.randrange(0, 9)):
            x = rng.choice(pool)
            lines.append(rng.choice([x, x.upper(), "\t" + x + " \r", x, "own " + str(rng.random())]))
        rows.append((d, "\n".join(lines), "c"))
    same = "s" * 45
    return rows + [(100, None, None), (101, "", ""), (102, "\n\n", ""), (103, "\n".join([same] * 4), ""), (104, same, ""), (105, same + "\n", ""), (106, same, ""), (107, same + "\n" + same, "")]


def test_against_brute_force(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for min_chars, min_docs in ((40, 5), (1, 2)):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_digest(df, min_chars=min_chars, min_docs=min_docs).collect()}
        assert got == brute(rows, min_chars, min_docs)


def test_bitmaps_and_edge_cases(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    bits = {r.doc_id: r for r in line_bitmaps(df).collect()}
    assert 107 not in bits and bits[103].keep_runs == [] and bits[103].n_dropped == 4
    kept, names = apply_bitmaps(df, line_bitmaps(df))
    assert kept.columns == df.columns + names and kept.count() == len(rows)
    assert line_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = [(1, "q" * 50, ""), (1, "q" * 50, ""), (None, "q" * 50, ""), *((d, "q" * 50, "") for d in range(2, 6))]
    got = sorted(((r.doc_id or 0), r.n_dropped) for r in line_digest(spark.createDataFrame(twice, SCHEMA)).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 0)]


def test_repeated_ids_clashing_columns_and_long_texts(spark):
    common = "c" * 50
    rows = [(1, "other 0\n" + common), (1, "unique first line\nsecond\n" + common + "\nlast"), (1, "unique first line\nsecond\n" + common + "\nlast"), *((d, common) for d in range(2, 7)), (8, ("z" * 60 + "\n") * 20_000 + "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as __before", "1 as __id", "2 as __t", "3 as __n", "4 as __runs", "5 as __split", "6 as __lines", "7 as __dropped", "8 as __kept", "9 as t", "10 as n_chars")
    out = drop_common_lines(df, length_col="n_chars")
    assert out.dtypes == df.dtypes
    got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect())
    assert got[:3] == [(1, "other 0", 7), (1, "unique first line\nsecond\nlast", 29), (1, "unique first line\nsecond\nlast", 29)]
    assert [x[1] for x in got[3:8]] == [""] * 4 + [common] and got[-1][1:] == (rows[-1][1], 10)
    assert {r["__before"] for r in out.collect()} == {"mine"}
