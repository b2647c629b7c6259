import random

import corpus_pipeline as P
import pytest

from inkmill.llm import components as C
from inkmill.llm import near_copies as S


def slow_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """Smallest ids of the groups, by comparing every two texts."""
    sets = [slow_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if group[a] != group[b] and (not union or 5 * len(sets[a] & sets[b]) >= 4 * union):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    return [rows[g][0] for g in sorted(set(group))]


def corpus(seed=7):
    """Singles, copies with more and more changed words on both sides of the limit, a large group of near copies, a line that
    many texts share, and short texts that are hardly more than this line."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(5000)}"
    out = []
    line = [word() for _ in range(25)]
    for k in range(24):
        base = [word() for _ in range(120)]
        out.append(base)
        for changes in (1, 2, 3):
            copy = list(base)
            for at in r.sample(range(120), changes):
                copy[at] = word()
            out.append(copy)
    base = [word() for _ in range(150)]
    for _ in range(60):
        copy = list(base)
        for at in r.sample(range(150), 2):
            copy[at] = word()
        out.append(copy)
    out += [line + [word() for _ in range(60)] for _ in range(30)]
    out += [line + [word() for _ in range(r.randrange(1, 12))] for _ in range(30)]
    r.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)] + [(900, ""), (901, " "), (902, "one"), (903, "ONE")]


@pytest.mark.parametrize("bucket, heavy", [(S.BUCKET, S.HEAVY), (3, S.HEAVY), (3, 0), (3, 5), (10**6, 0)])
def test_against_every_pair(make, bucket, heavy):
    rows = corpus()
    kept = S.drop_near_copies(make(rows), bucket, heavy)
    assert sorted(r.doc_id for r in kept.collect()) == slow_kept(rows)


def test_stage_takes_what_two_bits_leave(spark, make):
    base = [f"t{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join("x" if i in (50, 90, 130) else w for i, w in enumerate(base))), (3, " ".join(base[:100]))]
    assert slow_kept(rows) == [1, 3]
    stage = dict(P.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, make(rows), "").collect()) == [1, 3]


def test_odd_rows(make, odd):
    kept = S.drop_near_copies(make(odd))
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(found) == len({frozenset(slow_set(t or "")) for _, t in odd})
    assert (1, None) in found and (None, "không có số") in found
    assert S.drop_near_copies(make([])).count() == 0


def test_bounds_never_lose_a_pair():
    """Parity bitmaps and the upper bits of hashes tell apart only what is not similar."""
    import numpy as np

    r = random.Random(5)
    kept = other = 0
    for _ in range(400):
        n = r.randrange(1, 400)
        a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        b = np.unique(np.concatenate([a[r.randrange(0, max(1, n // 4)) :], np.array([r.getrandbits(64) for _ in range(r.randrange(0, n // 8 + 2))], np.uint64)]))
        x, y = S.parity(a), S.parity(b)
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(S.folded(x, size) ^ S.folded(y, size)).sum())
        if S.similar(a, b):
            kept += 1
            assert 9 * apart <= len(a) + len(b) and S.maybe_similar(S.rough(a), S.rough(b))
        else:
            other += 9 * apart > len(a) + len(b)
    assert kept > 100 and other > 20


@pytest.mark.parametrize("cell", [5, 1024])
def test_hardly_similar_group(make, monkeypatch, cell):
    """A group whose texts all share most shingles, but few of which are similar."""
    monkeypatch.setattr(S, "CELL", cell)
    r = random.Random(cell)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        for at in r.sample(range(120), r.randrange(0, 6)):
            copy[at] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    kept = S.drop_near_copies(make(rows), 4, 1000)
    assert 1 < len(slow_kept(rows)) < 60 and sorted(x.doc_id for x in kept.collect()) == slow_kept(rows)


def test_fingerprints_decide_first(make, monkeypatch):
    """The pairs that the search of fingerprints finds, no bucket full, against every pair; the exact way gets only the rest."""
    rows, seen = corpus(), {}
    by_fingerprint, similar_pairs = S.by_fingerprint, S._similar_pairs

    def first(nodes, *more):
        seen["fp"] = {r.node: (r.fp, r.e.doc_id) for r in nodes.collect()}
        out = by_fingerprint(nodes, *more)
        seen["root"] = {r.node: r.root for r in out.collect()}
        return out

    def rest(pairs, *more):
        seen["rest"] = [tuple(r) for r in pairs.collect()]
        return similar_pairs(pairs, *more)

    monkeypatch.setattr(S, "by_fingerprint", first)
    monkeypatch.setattr(S, "_similar_pairs", rest)
    assert sorted(r.doc_id for r in S.drop_near_copies(make(rows), 1000).collect()) == slow_kept(rows)
    texts, fp, root = dict(rows), seen["fp"], seen["root"]
    sets = {n: S.shingles(texts[i]) for n, (_, i) in fp.items()}
    group = {n: n for n in fp}
    for a in fp:
        for b in fp:
            if group[a] != group[b] and ((fp[a][0] ^ fp[b][0]) & (2**64 - 1)).bit_count() <= S.RADIUS and S.similar(sets[a], sets[b]):
                group = {n: group[a] if g == group[b] else g for n, g in group.items()}
    pairs = {(group[n], root.get(n, n)) for n in fp}
    assert len(pairs) == len(set(group.values())) == len({r for _, r in pairs}) < len(fp) - 20
    assert seen["rest"] and all(root.get(u, u) != root.get(v, v) for u, v in seen["rest"])


def test_fingerprints_in_full_buckets(make):
    """A group of copies with one word changed in 2,000, and of texts that only share most words, one bucket all."""
    base = [f"t{i}" for i in range(2000)]
    rows = [(i, " ".join("x%d" % i if k == 40 * i else w for k, w in enumerate(base))) for i in range(40)]
    rows += [(100 + i, " ".join(w for k, w in enumerate(base) if k % 4 or i % 3 == k % 3)) for i in range(6)]
    assert sorted(r.doc_id for r in S.drop_near_copies(make(rows), 4).collect()) == slow_kept(rows)


def linked(edges):
    """Smallest node of each node's component, edge after edge."""
    root = {x: x for e in edges for x in e}
    for a, b in edges:
        if root[a] != root[b]:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {x: new if y == old else y for x, y in root.items()}
    return root


@pytest.mark.parametrize("few", [0, 60, C.FEW])
def test_components_by_rounds_and_by_one_task(spark, few):
    """Chains, stars, repeated edges and loops; at 60 edges rounds come first."""
    r = random.Random(few)
    edges = [(i, i + 1) for i in range(0, 90)] + [(-5, -7 - i) for i in range(20)] + [(1000 + r.randrange(60), 1000 + r.randrange(60)) for _ in range(40)]
    edges = [e if r.random() < 0.5 else e[::-1] for e in edges + edges[:9]]
    r.shuffle(edges)
    found = C.components(spark.createDataFrame(edges, "u long, v long").repartition(3), few=few).collect()
    assert len(found) == len({x.node for x in found}) and {x.node: x.root for x in found} == linked([e for e in edges if e[0] != e[1]])
    assert C.components(spark.createDataFrame([(3, 3)], "u long, v long"), few=few).count() == 0


def test_one_task_links_any_graph():
    import numpy as np

    r = random.Random(11)
    for k in range(300):
        n = r.randrange(1, 50)
        edges = [(r.randrange(-30, n), r.randrange(-30, n)) for _ in range(r.randrange(1, 70))] if k % 4 else [(i, i + 1) for i in r.sample(range(n), n)]
        node, root = C.rooted(*(np.array(x, np.int64) for x in zip(*edges)))
        assert dict(zip(node.tolist(), root.tolist())) == linked(edges)


def test_few_jobs(spark, make):
    """The driver holds the plans of every job; rounds for a few edges were most of them."""

    def last():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))

    docs = make(corpus())
    docs.count()
    before = last()
    assert S.drop_near_copies(docs, 3).count() == len(slow_kept(corpus()))
    assert last() - before < 180
