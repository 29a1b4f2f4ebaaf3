"""Queries over whole tables and whole texts against plain Python."""

import re
import unicodedata

import pyarrow.parquet as pq

from cairnflow import queries as core
from cairnflow.operators import mesh
from cairnflow.queries import geometry

SF = "/root/testdata/sf0.001"


def table(name, *cols):
    return pq.read_table(f"{SF}/{name}.parquet", columns=list(cols)).to_pylist()


def edges():
    return [(r["c_custkey"], r["c_custkey"] * 7 % 400) for r in table("customer", "c_custkey")]


def spread(start, links):
    seen, stack = {start}, [start]
    while stack:
        for y in links.get(stack.pop(), ()):
            if y not in seen:
                seen.add(y)
                stack.append(y)
    return seen


def test_components_of_all_customers(spark):
    links = {}
    for a, b in edges():
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    got = {(r.node, r.component) for r in core.queries()["q_components"](spark, SF).collect()}
    assert got == {(x, min(spread(x, links))) for x in links}


def test_reach_from_all_customers(spark):
    links = {}
    for a, b in edges():
        links.setdefault(a, set()).add(b)
    got = {(r.source, r.reached, r.routable) for r in core.queries()["q_reach"](spark, SF).collect()}
    assert got == {(a, len(spread(a, links)), any(x % 9 == 0 for x in spread(a, links))) for a in links}


def test_every_edge_has_buffer_cells(spark):
    got = {r.edge for r in core.queries()["q_buffer_cells"](spark, SF).collect()}
    last = {}
    for r in sorted(table("embeddings", "vec_id", "label"), key=lambda r: r["vec_id"]):
        last.setdefault(r["label"], []).append(r["vec_id"])
    known = {x for v in last.values() for x in v[:-1]}
    assert got <= known and any(x % 10 for x in got)


def test_files_hold_every_ring(spark):
    buckets = {}
    for r in geometry._ring3(spark, SF).collect():
        pts = [(p.x, p.y, p.z) for p in r.pts]
        buckets.setdefault(r.ring % 3, []).append({"name": f"ring{r.ring}", "material": "room", "vertices": pts, "triangles": mesh.triangulate([(x, z) for x, _, z in pts])})
    want = {k: len(mesh.glb(sorted(v, key=lambda m: m["name"]))) for k, v in buckets.items()}
    assert {r.bucket: r.bytes for r in core.queries()["q_glb_bytes"](spark, SF).collect()} == want


def test_whole_texts(spark):
    docs = {r["doc_id"]: r for r in table("documents", "doc_id", "text", "source")}
    assert any(len(r["text"] or "") > 400 for r in docs.values())
    for r in core.queries()["q_ascii_fold"](spark, SF).collect():
        t = unicodedata.normalize("NFKD", docs[r.doc_id]["text"]).encode("ascii", "ignore").decode()
        t = re.sub(r"[\x00-\x1f:]+", " ", t.translate(str.maketrans('/\\"', "--'")))
        assert r.folded == re.sub(r"\s+", " ", t).strip(" ")
    for r in core.queries()["q_normalised_key"](spark, SF).collect():
        t = re.sub(r"[^ -~\n]", "x", docs[r.doc_id]["text"])
        assert r.key == re.sub(r"\s+", " ", t).lower().strip(" ")
    rules = core.scalars.text.CATEGORY_RULES
    for r in core.queries()["q_keyword_category"](spark, SF).collect():
        t = f"{docs[r.doc_id]['text']} {docs[r.doc_id]['source']}".lower()
        assert r.category == next((name for name, words in rules if any(w in t for w in words)), "other")
