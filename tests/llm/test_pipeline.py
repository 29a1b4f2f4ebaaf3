import duckdb

import corpus_pipeline
from cairnflow.llm import mixing, toxicity
from cairnflow.llm.decontam import words_of

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def key(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(BLANK))


def plain_lines(docs):
    held = {}
    for d, r in docs.items():
        for x in (r["text"] or "").split("\n"):
            held.setdefault(key(x), set()).add(d)
    out = {}
    for d, r in docs.items():
        keep = [x for x in (r["text"] or "").split("\n") if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and d != max(held[key(x)]))]
        text = "\n".join(keep)
        out[d] = {**r, "text": text, "n_chars": len(text)} if text != (r["text"] or "") else r
    return out


def plain_near(docs):
    ids = sorted(docs)
    sets = {}
    for d in ids:
        w = key(docs[d]["text"] or "").split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    by_shingle = {}
    for d in ids:
        for x in sets[d]:
            by_shingle.setdefault(x, []).append(d)
    shared = {}
    for v in by_shingle.values():
        for i in range(len(v)):
            for j in range(i):
                shared[v[j], v[i]] = shared.get((v[j], v[i]), 0) + 1
    near = [p for p, n in shared.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    near += [(a, b) for a in ids for b in ids if a < b and not sets[a] and not sets[b]]
    least = {d: d for d in ids}
    while True:
        before = dict(least)
        for a, b in near:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return {d: docs[d] for d in ids if least[d] == d}


def plain_clean(docs, items):
    windows = set()
    for t in items:
        w = words_of(t.encode())
        windows |= {tuple(w[i : i + 13]) for i in range(len(w) - 12)} if len(w) >= 13 else {tuple(w)} if w else set()
    sizes = {len(w) for w in windows}
    out = {}
    for d, r in docs.items():
        w = words_of((r["text"] or "").encode())
        hit = {j for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for j in range(i, i + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out[d] = r
    return out


def test_each_stage_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    as_dict = lambda df: {r.doc_id: r.asDict() for r in df.collect()}

    def step(name, df):
        path = str(tmp_path / name)
        stages[name](spark, df, SF).write.parquet(path)
        return spark.read.parquet(path)

    a = step("toxicity", docs)
    assert a.columns == docs.columns and a.dtypes == docs.dtypes
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, labels).collect() if r.predicted}
    assert set(as_dict(a)) == set(as_dict(docs)) - bad
    b = step("line_dedup", a)
    assert b.dtypes == docs.dtypes and as_dict(b) == plain_lines(as_dict(a))
    c = step("simhash_near_dedup", b)
    assert c.dtypes == docs.dtypes and as_dict(c) == plain_near(as_dict(b))
    d = step("benchmark_decontamination", c)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert d.dtypes == docs.dtypes and as_dict(d) == plain_clean(as_dict(c), items)
    e = step("source_mixing", d)
    want = duckdb.sql(mixing.oracle(f"(SELECT * FROM '{tmp_path}/benchmark_decontamination/*.parquet')")).fetchall()
    assert sorted(map(tuple, e.collect())) == sorted(want)


def test_nulls_clashing_columns_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "text here", "en", "src1", 9), (3, "", "de", "src2", 0), (4, "z " * 50_000, "fr", "src0", 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' as component_id", "1 as n_dropped", "array(1) as keep_runs", "'mine' as __before", "1 as __id", "2 as __keep", "3 as __spans")
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            n = out.count()
            if name != "source_mixing":
                assert out.columns == df.columns
                assert {r["__before"] for r in out.collect()} <= {"mine"}
            assert n <= len(rows)
            assert n == 0 if df is not docs else True


def test_there_are_five_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
