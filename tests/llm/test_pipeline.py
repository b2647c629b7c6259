import os
import re

import pytest

import corpus_pipeline as P
from inkmill.llm import exact_dedup, packing, pii, quality
from inkmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    words = quality.Words()
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect() if quality.scored(r.text or "", words, *model) >= quality.THRESHOLD]
    first: dict = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    rows = list(first.values())
    sets = [slow_set(t or "") for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    rows = [rows[g] for g in sorted(set(group))]
    tagger = pii.Tagger(pii.field())
    texts = [pii.redacted(t or "", every) for (_, t), (_, every) in zip(rows, pii.all_spans([t or "" for _, t in rows], tagger))]

    now = docs
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
    assert {(r.doc_id, r.text) for r in now.collect()} == {(i, t) for (i, _), t in zip(rows, texts)}
    c = packing.codec(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    sizes: dict = {}
    for r in P.run(spark, SF).collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(c.ids(t)) for (i, _), t in zip(rows, texts)}


@pytest.mark.parametrize("kind", ["odd", "empty", "no labels"])
def test_odd_tables(spark, make, odd, tmp_path, kind):
    """Nulls, ties, repeats, long texts and columns of the stages' own names; no rows at all; no label."""
    rows = [] if kind == "empty" else odd
    docs = make(rows).selectExpr("*", "1 AS mark", "'x' AS none", "2.5 AS at", "'s' AS sha", "doc_id AS node", "text AS ids", "7 AS key")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i, _ in rows if i is not None] if kind == "odd" else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        found = now.collect()
        assert all((r.mark, r.none, float(r.at), r.sha, r.key) == (1, "x", 2.5, "s", 7) and r.node == r.doc_id for r in found)
        if kind == "odd" and name == "quality":
            assert len(found) == len(odd)
        now = spark.createDataFrame(found, docs.schema)
    pieces = P.run(spark, str(tmp_path)).collect()
    assert bool(pieces) == (kind == "odd")
    sizes: dict = {}
    for r in pieces:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert kind != "odd" or set(sizes) == {r.doc_id for r in found}


def test_names():
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert exact_dedup.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_comes_out(spark, name):
    out = QUERIES[name](spark, SF)
    key = "page_id" if name.startswith("op5") else "doc_id"
    table = "pages" if key == "page_id" else "documents"
    wanted = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in out.select(key).collect()} == wanted


CONTRACT = {
    "op1": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature", "op2": "doc_id keep_id group_size kept text_sha256",
    "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op4": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op5": "page_id url text n_chars",
    "op6": "doc_id held_out score predicted", "op7": "doc_id held_out lang_pred score", "op8": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "doc_id fingerprint component_id",
}
TAKEN = "ids key bucket n mark fp anchor piece spans kept low hash score lang_pred run digest at none sha id y order host path shared part copy root u v".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_and_taken_names(spark, make, odd, tmp_path, name):
    """Every query over nulls, ties, repeats and long texts, beside columns that have the names it uses itself."""
    docs = make(odd).selectExpr("*", *[f"'{c}' AS `{c}`" for c in TAKEN])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    pages = docs.selectExpr("doc_id AS page_id", "concat('http://a.x/', doc_id) AS url", "text AS html", *[f"`{c}`" for c in TAKEN])
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(5, 1, 0), (6, 0, None)], "doc_id long, quality int, toxic int").selectExpr("*", "1 AS id", "2 AS y").write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES[name](spark, str(tmp_path))
    first = CONTRACT[name.split("_")[0]].split()
    assert out.columns[: len(first)] == first
    rows = out.collect()
    ids = sorted((r[0] if r[0] is not None else -1) for r in rows)
    wanted = sorted((i if i is not None else -1) for i, _ in odd)
    assert ids == wanted if not name.startswith("op4") else set(ids) == set(wanted)
