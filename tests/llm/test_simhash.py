import random

import numpy as np
import xxhash

from inkmill.llm import simhash as S


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", text.encode("utf-8").lower()) if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(odd):
    for _, t in odd:
        assert S.fingerprint(t or "") == slow_fingerprint(t or "")
    assert S.fingerprint("  \t") == 0 and S.fingerprint("A b") == S.fingerprint("a  B") and S.fingerprint("É") != S.fingerprint("é")


def brute(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 2) + i + 1:
            parent[find(int(j))] = find(i)
    return [find(i) for i in range(len(a))]


def linked(spark, fps, **options):
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), **options)
    roots = {r.node: r.root for r in S.components(edges).collect()}
    return [roots.get(f, f) for f in signed]


def same(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_links_in_full_and_small_buckets(spark):
    r = random.Random(4)
    seeds = [r.getrandbits(64) for _ in range(40)]
    # chains and dense clusters: many fingerprints within few bits of one another
    fps = {*seeds, 0, 2**64 - 1}
    for s in seeds[:6]:
        x = s
        for _ in range(30):
            x ^= 1 << r.randrange(64) | 1 << r.randrange(64)
            fps.add(x)
    fps |= {seeds[0] ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(0, 64, 5)}
    fps = sorted(fps)
    for bucket in (1, 4, 32, 10**6):
        assert same(linked(spark, fps, bucket=bucket), brute(fps)), bucket


def test_allocation():
    assert S.allocated([[0, 5, 50, 500]] * 3, 2) == [0, 0, 0]
    assert S.allocated([[0, 1, 2, 500], [0, 900, 990, 999], [0, 5, 60, 500]], 2) in ([1, -1, 0], [1, 0, -1], [0, -1, 1], [2, -1, -1])
    groups = S.grouped_bits(np.eye(64) * 5, 10, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and sorted(map(len, groups)) == [21, 21, 22]


def test_components(make, odd, rows_of, spark):
    base = " ".join(f"từ{i}" for i in range(400))
    rows = odd + [(200 + i, base.replace(f"từ{i * 7}", "khác", 1)) for i in range(30)] + [(500 + i, base) for i in range(40)]
    fps = [slow_fingerprint(t or "") for _, t in rows]
    root = brute(fps)
    least = {}
    for (i, _), k in zip(rows, root):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    expected = sorted(((i, f"{f:016x}", least.get(k)) for (i, _), f, k in zip(rows, fps, root)), key=repr)
    docs = make(rows)
    assert rows_of(S.simhash_components(docs), "doc_id", "fingerprint", "component_id") == expected
    kept = S.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert S.simhash_components(make([])).count() == 0
    assert S.drop_near_copies(make([])).count() == 0
