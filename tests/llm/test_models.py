"""Operators that learn or rank: quality, language, packing; and pages and the pipeline."""

import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from inkmill.llm import language_id as L
from inkmill.llm import packing as K
from inkmill.llm import page_diff as D
from inkmill.llm import quality as Q

PATH = public_tokenizers.path("byte_bpe_50k.json")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


# --- quality


def prose(r):
    return " ".join("".join(r.choices(["the", "re", "an", "ou"], k=r.randint(1, 4))) for _ in range(r.randint(20, 80)))


def test_quality_is_learned(make, odd, spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        good = i % 5 > 0
        t = prose(r)
        rows.append((i, t if good else r.choice([t.upper().replace(" ", "!! "), " ".join([t.split()[0]] * 60), t.replace(" ", "*** ")])))
        labels.append((i, int(good), None))
    labels += [(None, 1, 0), (7, None, 0)]
    docs, known = make(rows + [(i, t) for i, t in odd if i is None or i > 500]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = Q.fit(docs, known)
    got = [r for r in Q.score(docs, model).collect() if r.doc_id is not None]
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    out = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 5 > 0) for r in out]) > 0.95
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect() if r.doc_id is not None} == {r.doc_id for r in got if r.predicted}
    assert np.array_equal(Q.fit(docs, known)[0], model[0])


def test_quality_without_labels(make, odd, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit(make(odd), none)
    assert {r.score for r in Q.score(make(odd), model).collect()} == {0.5}
    assert Q.score(make([]), model).count() == 0


def test_quality_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 7}!" for i in range(50))
    whole = Q.features(text, Q.Words())
    monkeypatch.setattr(Q, "BLOCK", 3)
    again = Q.features(text, Q.Words())
    assert np.array_equal(whole[0], again[0]) and np.allclose(whole[1], again[1])


# --- language

SAMPLE = {"en": ["the", "of", "and", "that", "with"], "vi": ["của", "những", "được", "không", "người"], "ru": ["это", "было", "что", "она", "как"]}


@pytest.fixture(scope="module")
def tongues(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choices(SAMPLE[lang], k=30)), lang) for i, lang in enumerate(list(SAMPLE) * 60)]
    return spark.createDataFrame([*rows, (900, None, "en"), (901, "x", None), (None, "the of", "en")], "doc_id long, text string, lang string")


def test_languages(tongues, make, odd):
    model = L.fit(tongues)
    assert model.langs == sorted(SAMPLE)
    rows = L.identify(tongues, model).collect()
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    out = [r for r in rows if r.held_out and r.doc_id < 900]
    assert out and all(held(r.doc_id) for r in out) and np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.98
    got = {r.doc_id: r for r in L.identify(make([*odd, (70, "123 !!"), (71, "the of and " * 20 + "это было что " * 20)]), model, spans=True).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[70].lang_pred == "und" and got[70].score == 0
    assert [s.lang for s in got[71].spans] == ["en", "ru"] and got[71].spans[0]["last"] == 59 and 0 < got[71].score < 1
    assert L.identify(make([]), model).count() == 0


def test_no_language(make, odd, spark):
    model = L.fit(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in L.identify(make(odd), model, spans=True).collect()} == {"und"}


def test_language_viterbi():
    r = np.random.default_rng(1)
    given = [r.normal(size=(n, 3)) * 4 for n in (5, 0, 1, 9, 5)]

    def slow(e):
        best, back = e[0].copy(), []
        for row in e[1:]:
            step = best[:, None] - L.SWITCH * (1 - np.eye(3))
            back.append(step.argmax(0))
            best = step.max(0) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    for e, got in zip(given, L.viterbi(given)):
        assert got.tolist() == (slow(e) if len(e) else [])


# --- packing


def check_pieces(rows, docs, ids_of):
    left = {}
    for i, t in docs:
        left.setdefault(i, []).append(ids_of(t))
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        ids = next(x for x in left[r.doc_id] if len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32)
        assert len(ids[r.start : r.start + r.length]) == r.length > 0
    assert sum(r.length for r in rows) == sum(len(x) for v in left.values() for x in v)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= K.WINDOW
    return by_seq


def test_packing(make, odd):
    t = Tokenizer.from_file(PATH)
    r = random.Random(3)
    docs = odd + [(100 + i, prose(r)) for i in range(300)]
    ids_of = lambda x: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
    rows = K.pack(make(docs), PATH).collect()
    by_seq = check_pieces(rows, docs, ids_of)
    full = sum(sum(p.length for p in v) == K.WINDOW for v in by_seq.values())
    assert len(by_seq) - full <= 4  # one for each partition at most
    assert K.pack(make([]), PATH).count() == 0


def test_codec():
    t, c = Tokenizer.from_file(PATH), K.ByteCodec(PATH)
    r = random.Random(4)
    parts = [*"ab \n\tñé́ﬁ中ü  '0,.　\x00\x85😀", "'st", "<|endoftext|>", " the", "ll"]
    for text in ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(3000)] + [" " * 50_000 + "a"]:
        assert c.ids(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]


def test_codec_over_all_characters():
    """Both tokenizers split alike whatever the character, in six surroundings."""
    c = K.codec(public_tokenizers.path("byte_bpe_50k.json"))
    around = ("a{0}b", " {0}", "1{0}2", "{0}{0} x", "\n{0} \n", "'{0}s.{0}")
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for at in range(0, len(points), 2000):
        text = "|".join(f.format(chr(i)) for i in points[at : at + 2000] for f in around)
        assert c.fast.encode_ordinary(text) == c.slow.encode(text, add_special_tokens=False).ids, hex(points[at])


def split_ids(c, given):
    ids, ends = c.all_ids(pa.array(given, pa.string()))
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def test_codec_of_a_slice():
    """Texts together get the ids that the library gives each; white space of all kinds anywhere, special tokens, nulls."""
    t, c = Tokenizer.from_file(PATH), K.codec(PATH)
    r = random.Random(5)
    white = [chr(i) for i in range(0x3001) if re.fullmatch(r"\s", chr(i))]
    forms = ["a {0}b", "a{0} b", "{0}", " {0}", "a{0}", "a {0}", "{0} a", "a {0}{1}b c", "a b{0}{1} c", "{0}a {1}a"]
    texts = [None, "", " ", "a", " a", "a ", *(f.format(a, b) for f in forms for a in white for b in white)]
    texts += ["".join(r.choices(["a", "b ", " c", "'s", " '", "中", " é", ".\n", "\x00", " 12", *white[:6], "<|endoftext|>"], [9] * 10 + [1] * 7, k=r.randint(0, 25))) for _ in range(5000)]
    r.shuffle(texts)
    for at in range(0, len(texts), 700):
        got = split_ids(c, texts[at : at + 700])
        assert got == [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts[at : at + 700]]
    assert split_ids(c, [None]) == split_ids(c, [""]) == [[1]]


def test_codec_of_a_slice_over_all_characters():
    c = K.codec(PATH)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and not re.fullmatch(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", chr(i))]
    texts = ["|".join(f.format(p) for p in points[at : at + 2000] for f in ("a {0}b", "{0} 1{0}", " '{0}\n{0}'s {0} x")) for at in range(0, len(points), 2000)]
    assert split_ids(c, texts) == [[*c.slow.encode(x, add_special_tokens=False).ids, 1] for x in texts]


def test_codec_encodes_a_word_once(monkeypatch):
    """Of a slice's texts only the different words are encoded, whatever the number of texts."""
    c = K.ByteCodec(PATH)
    seen, fast = [], c.fast

    class Counted:
        def encode_to_numpy(self, text, **how):
            seen.append(len(text))
            return fast.encode_to_numpy(text, **how)

    monkeypatch.setattr(c, "fast", Counted())
    r = random.Random(6)
    words = [prose(r).split()[0] + str(i) for i in range(50)]
    texts = [" ".join(["a", *r.choices(words, k=100)]) for _ in range(400)]
    got = split_ids(c, texts)
    assert sum(seen) < 2000 + sum(len(w) + 1 for w in words)
    assert got == [[*fast.encode_ordinary(x), 1] for x in texts]


def test_bm25(monkeypatch):
    c = K.ByteCodec(PATH)
    texts = ["red green blue", "red green blue sky", "one two three", "one two red", "zebra"]
    docs = [(i, c.ids(" " + t)) for i, t in enumerate(texts)]
    idf = np.full(1 << K.BITS, 2.0)
    for dense in (0, 16, 10**6):
        monkeypatch.setattr(K, "DENSE", dense)
        s = K.Shard(docs, c, idf, 4.0)
        sets = [set(t.split()) for t in texts]
        for i in range(5):
            for j in range(5):
                norm = K.K1 * (1 - K.B + K.B * len(docs[j][1]) / 4.0)
                assert abs(s.scores(i)[j] - len(sets[i] & sets[j]) * 2.0 * (K.K1 + 1) / (1 + norm)) < 1e-4
        order = [k for _, k, *_ in s.packed()]
        assert order[:2] == [0, 1] and sorted(order) == list(range(5))


# --- whole queries on rows that nothing was learned from

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@tables
def test_quality_query(spark):
    """Held-out accuracy, and each score against the definition: weights of the features times their shares."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in Q.op6_quality(spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert set(rows) == set(texts)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for i, r in rows.items())
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and rows[r.doc_id].held_out}
    assert len(known) > 50 and sum(rows[i].predicted == y for i, y in known.items()) >= 0.97 * len(known)
    w, bias = Q.fit(docs, labels)
    words = Q.Words()
    for i, t in list(texts.items())[:150]:
        at, x = Q.features(t, words)
        assert abs(rows[i].score - 1 / (1 + np.exp(-(bias + float(w[at].astype(float) @ x))))) < 1e-4


@tables
def test_language_query(spark):
    """Held-out accuracy, and labels against a Viterbi written out word by word."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in L.op7_language_id(spark, SF).collect()}
    given = {r.doc_id: (r.text or "", r.lang) for r in docs.collect()}
    assert set(rows) == set(given)
    held = [(r.lang_pred, given[i][1]) for i, r in rows.items() if r.held_out and any(map(str.isalpha, given[i][0]))]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.98 * len(held)
    model = L.fit(docs)
    for i, (text, _) in sorted(given.items())[:40]:
        words = text.split()[:400] if len(text.split()) <= 400 else []
        if not words:
            continue
        scores, n = model.scores(words)
        best = [(float(s), [k]) for k, s in enumerate(scores[0])]
        for row in scores[1:]:
            top = max(range(len(best)), key=lambda k: best[k][0])
            best = [((b, p) if b >= best[top][0] - L.SWITCH else (best[top][0] - L.SWITCH, best[top][1])) for b, p in best]
            best = [(b + float(s), [*p, k]) for k, ((b, p), s) in enumerate(zip(best, row))]
        path = max(best, key=lambda x: x[0])[1]
        by = np.bincount(path, n, minlength=len(model.langs))
        assert rows[i].lang_pred == model.langs[int(by.argmax())] and abs(rows[i].score - by.max() / by.sum()) < 1e-6


# --- pages


def test_common_lines(monkeypatch):
    r = random.Random(1)

    def size(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for k in range(1500):
        monkeypatch.setattr(D, "TRACE_BITS", 1 << 26 if k % 2 else 4)
        a, b = ([r.randrange(5) for _ in range(r.randrange(14))] for _ in range(2))
        c = D.common(a, b)
        assert len(c) == size(a, b) and all(a[i] == b[j] for i, j in c) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(c, c[1:]))


ARTICLE = "<html><head><title>x</title><style>p{}</style></head><body><nav><li>Menu</nav><div class='ad'>Buy</div><article><h1>T &amp; x</h1><p><b>One\n two<br><p>Three&nbsp;&#233;<aside>side</aside></article><div id='comments'><p>bad</div><footer>f</footer><script>var a='</p>'</script>"
PLAIN = "<body><div>Top of site</div><p>Own text number {n} of this very page, long enough</p><p>Subscribe now</p></body>"


def test_extraction(spark):
    rows = [(1, "http://a.x/en/1", ARTICLE), (2, None, None), (3, "http://p.x/1", PLAIN.format(n=1)), (4, "http://p.x/2", PLAIN.format(n=2)), (5, "bad url", "<p>a<p>b"), (5, "bad url", "<p>a<p>b")]
    rows += [(6, "http://c.x/1", "<p>one two three four</p><p>z</p>"), (7, "http://c.x/2", "<p>one two three four</p><p>z</p>"), (8, "http://e.x", "")]
    got = {}
    for r in D.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect():
        got.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    assert got[1][0].text == "T & x\nOne two\nThree é"
    assert got[2][0].text == "" and got[8][0].text == "" and [r.text for r in got[5]] == ["a\nb"] * 2
    assert got[6][0].text == got[7][0].text == "one two three four\nz"  # copies are no template
    assert got[3][0].text == "Own text number 1 of this very page, long enough"
    assert D.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_in_doubt(spark):
    """A name that only in part is that of an advert or the like is decided by differencing, inside articles too."""
    page = "<article><h1>T{n}</h1><p class=share-price>Price {n}</p><p class=share-price>Price today</p><p id=related-work>Other works</p><div class=social-share>Tell all</div><p>Body number {n} is the longest line here</p></article>"
    rows = [(n, f"http://a.x/news/{n}", page.format(n=n)) for n in range(4)]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {n: f"T{n}\nPrice {n}\nBody number {n} is the longest line here" for n in range(4)}
    one = D.extract(spark.createDataFrame(rows[:1], "page_id long, url string, html string")).first().text
    assert one == "T0\nPrice 0\nPrice today\nOther works\nBody number 0 is the longest line here"


def site(seed):
    """Pages of a few hosts in which templates, copies and near copies stand side by side; most without an article."""
    r = random.Random(seed)
    said = lambda k: " ".join(f"w{r.randrange(300)}" for _ in range(k))
    rows = []
    for h in range(3):
        top, foot = [said(3), said(2), said(20)], [said(4)]
        n = 0
        for _ in range(r.randrange(8, 25)):
            body = [said(r.randrange(3, 15)) for _ in range(r.randrange(1, 9))]
            for copy in range(r.choice([1, 1, 1, 2, 5, 14])):
                if copy and r.random() < 0.5:
                    body[0] = said(4)
                html = "".join(f"<p>{x}</p>" for x in (top + body + foot))
                rows.append((len(rows), f"http://h{h}.x/p/{n}", html if r.random() < 0.9 else f"<article>{html}</article>"))
                n += 1
    r.shuffle(rows)
    return rows + rows[:2] + [(900, None, "<p>x</p>"), (901, "http://h0.x/q", None), (902, "http://h0.x/p", "")]


def slow_pairs(rows):
    """Shared lines of each page, by looking through the whole sorted list for its pair."""
    pages = []
    for i, u, h in rows:
        m = re.match(r"[a-z][a-z0-9+.-]*://([^/?#:]*)[^/?#]*([^?#]*)", (u or "").lower())
        path = re.sub(r"[0-9]+", lambda d: d[0].zfill(9), m[2]) if m else ""
        pages.append((m[1] if m else "", path, u or "", i, [x.text for x in D.lines(h or "")]))
    pages.sort(key=lambda p: p[:4])
    longest = lambda p: max(p[4], key=len, default="")
    out = {}
    for k, p in enumerate(pages):
        near = []
        for side, some in enumerate((pages[:k][::-1], pages[k + 1 :])):
            some = [q for q in some if q[0] == p[0] and p[0]]
            if not side:  # behind, a run of equal pages is one
                some = [q for j, q in enumerate(some) if not j or some[j - 1][4] != q[4]]
            picked, seen = [], [p[4]]
            for q in some[: D.LOOK]:
                if q[4] not in seen and len(picked) < D.REACH:
                    picked.append(q)
                    seen.append(q[4])
            other = next((q for q in some if longest(q) != longest(p)), None)
            if other and other[4] not in seen:
                picked.append(other)
            near += [(-D._affinity(q[1], p[1]), d, side, q) for d, q in enumerate(picked)]
        best, whole = None, sum(map(len, p[4]))
        for *_, q in sorted(near, key=lambda x: x[:3]):
            found = [i for i, _ in D.common(p[4], q[4])]
            size = sum(len(p[4][i]) for i in found)
            if best is None or size < best[0]:
                best = (size, found)
            if 2 * size <= whole:
                best = (size, found)
                break
        out[p[3]] = set(best[1]) if best and best[0] < whole else set()
    return out


@pytest.mark.parametrize("seed, part_rows", [(1, 10**6), (1, 60), (2, 30), (3, 45)])
def test_pages_against_the_whole_list(spark, seed, part_rows):
    rows = site(seed)
    pairs = slow_pairs(rows)
    wanted = {i: D.main_text(D.lines(h or ""), s) for (i, _, h), s in ((row, pairs[row[0]]) for row in rows)}
    got = D.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), part_rows).collect()
    assert len(got) == len(rows) and {r.page_id: r.text for r in got} == wanted
    assert sum(len(t.split("\n")) < len(D.lines(h or "")) for (i, _, h), t in ((row, wanted[row[0]]) for row in rows)) > len(rows) // 2


def test_broken_markup():
    for html in ("<" * 20_000, "<a b='" * 3000, "<p" * 5000, "<!--" * 5000, "<script>" * 3000, "<div>" * 3000 + "x", "</p>" * 3000):
        D.lines(html)
    assert [x.text for x in D.lines("a<b>c</b>d<![CDATA[<e>]]>")] == ["acd<e>"]
