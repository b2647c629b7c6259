import hashlib
import random

import numpy as np
import pytest

from inkmill.llm import suffix_dedup as S


def test_suffix_arrays():
    r = random.Random(2)
    for _ in range(300):
        t = bytes(r.choices(b"abc\x00z"[: r.randint(1, 5)], k=r.randint(0, 100)))
        order = sorted(range(len(t)), key=lambda i: t[i:])
        sa = S.suffix_array(t)
        assert sa.tolist() == order
        for a, b, n in zip(order, order[1:], S.adjacent_prefixes(t, sa, 64)[1:]):
            m = 0
            while a + m < len(t) and b + m < len(t) and t[a + m] == t[b + m]:
                m += 1
            assert m == n


def test_anchors_in_chunks(monkeypatch, make, rows_of):
    r = random.Random(1)
    text = "".join(r.choices("abcdef ", k=5000))
    docs = make([(1, text + "z" * 900), (2, text[700:3300]), (3, text[:390])])
    whole = rows_of(S.remove_repeats(docs), "doc_id", "n_removed", "kept_sha256")
    x = np.frombuffer(text.encode(), np.uint8)
    at, _, low, high = S.anchors(x, np.full(len(x), len(x)), len(x))
    assert low[0] == 0 and high[-1] == len(x) - S.SPAN and (low[1:] == high[:-1] + 1).all()
    assert ((at >= high) & (at <= low + S.REACH)).all()
    assert whole[1][1] == 2600


def brute(rows):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 399):
            seen[b[p : p + 400]] = seen.get(b[p : p + 400], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 399):
            if seen[b[p : p + 400]] > 1:
                gone[p : p + 400] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)])) == 1
        out.append((i, len(b), int(gone.sum()), int(edges.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [1, 24, 10**6])
def test_against_brute_force(make, rows_of, monkeypatch, group):
    monkeypatch.setattr(S, "GROUP", group)
    r = random.Random(5)
    base = "".join(r.choices("abcdefgh ij", k=1300))

    def edited(s):
        s = list(s)
        for _ in range(r.randint(0, 3)):
            s[r.randrange(len(s))] = "Z"
        return "".join(s)

    noise = lambda: "".join(r.choices("xyz ", k=300))
    rows = [(i, edited(base)) for i in range(60)]
    rows += [(1000 + i, noise() + base[100 : 100 + r.randint(230, 430)] + noise()) for i in range(60)]
    rows += [(2000, "And " * 300), (2001, "é" * 500), (2002, None), (2003, ""), (2004, base), (2004, base), (2005, "a" * 399), (2006, "a" * 401), (2007, "a" * 400), (None, base[:600]), (None, None)]
    r.shuffle(rows)
    assert rows_of(S.remove_repeats(make(rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute(rows)


def test_outputs(make):
    text = "".join(random.Random(3).choices("abcdef", k=900))
    got = {r.doc_id: r for r in S.remove_repeats(make([(1, "x" + text + "y"), (2, text), (3, "own")]), keep=True).collect()}
    assert bytes(got[1].kept) == b"xy" and got[1].removed == [[1, 901]] and bytes(got[3].kept) == b"own"
    assert S.remove_repeats(make([])).count() == 0
