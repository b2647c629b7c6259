import hashlib
import random
import re

import pytest

from inkmill.llm import near_copies, simhash
from inkmill.llm.exact_dedup import drop_copies, exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        sha, once = hashlib.sha256(text.encode()).hexdigest(), True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, least, len(ids), once and i == least, sha))
            once = once and i != least
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [0, 1, 5, 6])
def test_against_brute_force(make, odd, rows_of, bits):
    r = random.Random(bits)
    rows = odd + [(100 + i, r.choice(["a b", "a  b", "a\tb", "c", "d" * r.randint(1, 3)])) for i in range(200)]
    assert rows_of(exact_dedup(make(rows), bits), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute(rows)


def test_kept_rows(make, odd, spark):
    docs = make(odd + [(i, "one group of copies") for i in range(50, 300)])
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in odd}) + 1


def test_empty_and_clashing(make, spark):
    assert exact_dedup(make([])).count() == 0
    docs = spark.createDataFrame([(1, "a", 9), (2, "a", 9)], "doc_id long, text string, digest int").withColumnsRenamed({})
    assert drop_copies(docs.selectExpr("*", "1 AS run", "2 AS keep_id", "3 AS norm", "4 AS mark")).count() == 1


def test_no_python_in_the_plan(make):
    plan = exact_dedup(make([(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("drop", [drop_copies, near_copies.drop_near_copies, simhash.drop_near_copies])
def test_columns_of_any_name(make, drop):
    docs = make([(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, "x y z"), (None, None)]).selectExpr("*", "doc_id AS none", "text AS at", "7 AS sha", "8 AS mark", "'k' AS `__sha`", "doc_id AS NONE_")
    kept = drop(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 1, 3]
    for r in found:
        assert (r["none"], r["at"], r["sha"], r["mark"], r["__sha"], r["NONE_"]) == (r.doc_id, r.text, 7, 8, "k", r.doc_id)


def test_repeated_rows_are_spread(make):
    out = exact_dedup(make([(5, "same")] * 400), 5).collect()
    assert len(out) == 400 and sum(r.kept for r in out) == 1 and {(r.keep_id, r.group_size) for r in out} == {(5, 400)}
