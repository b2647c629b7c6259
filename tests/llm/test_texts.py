"""Operators that look at one text at a time: audio, personal data, SentencePiece."""

import hashlib
import io
import os
import random
import re
import wave as wavelib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from inkmill.llm import audio as A
from inkmill.llm import pii
from inkmill.llm.piece_codec import PieceCodec, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- audio


def test_media_round_trip(make, odd):
    rows = {}
    for r in A.audio_features(make(odd), keep=True).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for i, t in odd:
        raw = (t or "").encode()
        data = raw + bytes(-len(raw) % 64 if raw else 64)
        r = next(x for x in rows[i] if x.payload_sha256 == hashlib.sha256(data).hexdigest())
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(raw), len(data), zlib.crc32(data[-64:]))
        with wavelib.open(io.BytesIO(bytes(r.media))) as w:
            assert (w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())) == (1, 1, A.RATE, data)
        assert hashlib.sha256(bytes(r.media)).hexdigest() == r.media_sha256 and r.media_bytes == len(r.media)
        table = pa.ipc.open_stream(bytes(r.tensors)).read_all()
        assert table.schema.field("log_mel").type == A.TENSOR and table.num_rows == r.n_windows
        assert table["start_s"][0].as_py() == 0 and len(r.segments) == r.n_segments
    assert len({x.feature for x in rows[5] if x.n_bytes == 20}) <= 1
    assert A.audio_features(make([])).count() == 0


def test_resampling():
    x = np.random.default_rng(1).normal(size=500).astype(np.float32)
    h = A.lowpass(3, 2)
    y = A.resampled(x, 0, 750, h, 3, 2)
    for m in (0, 7, 100, 749):
        k = (m * 2) // 3 + h.shape[1] // 2 - np.arange(h.shape[1])
        good = (k >= 0) & (k < 500)
        assert abs(y[m] - (h[m * 2 % 3][good] * x[k[good]]).sum()) < 1e-4
    assert np.allclose(np.concatenate([A.resampled(x, a, a + 250, h, 3, 2) for a in (0, 250, 500)]), y, atol=1e-5)
    t = np.arange(4000) / A.RATE
    tone = np.round(128 + 100 * np.sin(2 * np.pi * 500 * t)).astype(np.uint8)
    mel, energy = A.log_mel(tone)
    assert abs(A._BANK[:, mel[20].argmax()].argmax() * A.RATE * A.UP / A.DOWN / A.FFT - 500) < 80


def test_features_by_definition():
    """Log-mel values and energies of the query's own setting, from the definitions: sums of taps, cosines, triangles."""
    x = np.random.default_rng(6).integers(0, 256, 64 * 9).astype(np.uint8)
    n, taps = -(-len(x) * A.UP // A.DOWN), A.TAPS
    proto = np.sinc((np.arange(taps * A.UP) - (taps * A.UP - 1) / 2) / max(A.UP, A.DOWN)) * np.hamming(taps * A.UP)
    y = []
    for m in range(n + 2 * A.FRAME):
        pos = m * A.DOWN
        phase = proto[pos % A.UP :: A.UP]
        at = [pos // A.UP + taps // 2 - k for k in range(taps)]
        y.append(sum(f * (float(x[i]) - 128) / 128 for f, i in zip(phase / phase.sum(), at) if 0 <= i < len(x)))
    assert len({(m * A.DOWN) % A.UP for m in range(9)}) == A.UP > 1
    mel, energy = A.log_mel(x)
    frames = 1 + max(0, -(-(n - A.FRAME) // A.HOP))
    assert mel.shape == (frames, A.MELS)
    to_mel = lambda f: 2595 * np.log10(1 + f / 700)
    rate = A.RATE * A.UP / A.DOWN
    edges = 700 * (10 ** (np.linspace(to_mel(20), to_mel(rate / 2), A.MELS + 2) / 2595) - 1)
    for t in (0, 1, frames - 1):
        cut = np.array(y[t * A.HOP : t * A.HOP + A.FRAME])
        assert abs(energy[t] - 10 * np.log10((cut**2).mean() + 1e-10)) < 0.02
        shown = cut * np.hanning(A.FRAME)
        power = [abs(sum(v * np.exp(-2j * np.pi * b * k / A.FFT) for k, v in enumerate(shown))) ** 2 for b in range(A.FFT // 2 + 1)]
        for j in range(A.MELS):
            lo, mid, hi = edges[j : j + 3]
            total = sum(p * max(0, min((b * rate / A.FFT - lo) / (mid - lo), (hi - b * rate / A.FFT) / (hi - mid))) for b, p in enumerate(power))
            assert abs(mel[t, j] - 10 * np.log10(total + 1e-10)) < 0.05, (t, j)


def test_segments():
    e = np.full(100, -50.0)
    e[10:20] = e[40:60] = 0
    e[45] = -50  # shorter than the hang
    assert A.segments(e) == [(10, 20), (40, 60)]
    assert A.segments(np.zeros(5)) == [(0, 5)]


def test_features_in_blocks(monkeypatch):
    x = np.random.default_rng(2).integers(0, 256, 9000).astype(np.uint8)
    whole = A.log_mel(x)
    monkeypatch.setattr(A, "BLOCK", 7)
    for a, b in zip(whole, A.log_mel(x)):
        assert np.allclose(a, b, atol=0.011)


# --- personal data

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")) or k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d)) or k == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_base_spans():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choices("1234 -.+()@ab_é", k=r.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("1" * 200_000 + "@" * 100_000 + "a" * 200_000) == []


@pytest.fixture(scope="module")
def field():
    return pii.field()


def test_field_on_fresh_sentences(field):
    good = total = 0
    tagger = pii.Tagger(field)
    for row in pii.labelled_table(200, seed=99):
        text = " ".join(t for t, _ in row)
        bounds, at = [], 0
        for t, label in row:
            bounds.append((at, at + len(t), label))
            at += len(t) + 1
        wanted = sum(label[0] == "B" for _, _, label in bounds)
        total += wanted
        found = tagger.spans([text])[0]
        good += sum(any(a <= s and e <= max(x[1] for x in bounds) and a <= s < b and label[2:] == pii.KINDS[k] for a, b, label in bounds) for k, s, e in found)
    assert good / total > 0.9


def test_viterbi_and_stretches(field, monkeypatch):
    import itertools

    r = np.random.default_rng(3)
    for n in (1, 2, 3, 4):
        e = r.normal(size=(n, len(pii.LABELS))) * 3
        best = max(itertools.product(range(len(pii.LABELS)), repeat=n), key=lambda p: sum(e[i, y] for i, y in enumerate(p)) + sum(field.t[a, b] for a, b in zip((0, *p), (*p, 0))))
        assert tuple(field.viterbi(e, np.array([n]))) == best
    texts = [[t for t, _ in row] for row in pii.labelled_table(150, seed=5)] + [[], ["plain", "words"], ["1"], ["a=b"], ["key"] * 50, ["+1", "(555)", "111-2222"] * 20]
    tagger = pii.Tagger(field)
    whole = []
    for t in texts:  # each token by the trained weights, each text in one run
        e = np.zeros((len(t), len(pii.LABELS)))
        for i, w in enumerate(t):
            e[i] += field.scores(w)[0]
            e[i] += field.scores(t[i - 1])[1] if i else tagger.edge[1]
            e[i] += field.scores(t[i + 1])[2] if i + 1 < len(t) else tagger.edge[2]
        whole += field.viterbi(e, np.array([len(t)])).tolist() if t else []
    for block, table in ((pii.BLOCK, pii.TABLE), (7, 50)):
        monkeypatch.setattr(pii, "BLOCK", block)
        monkeypatch.setattr(pii, "TABLE", table)
        tagger = pii.Tagger(field)
        assert tagger.labels(texts).tolist() == whole and any(whole)
        assert np.concatenate([tagger.labels(texts[i : i + 9]) for i in range(0, len(texts), 9)]).tolist() == whole


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_field_on_a_second_source(field):
    """Secrets of documents the field was not trained on: what a pattern finds there, the field finds, and hardly more."""
    import pyarrow.parquet as pq

    docs = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    secret = re.compile(r"(?i)(?:key|token|secret|password)\s*[=:]\s*[\"']?([A-Za-z0-9_-]{16,})")
    wanted = good = more = 0
    for text, (_, every) in zip(docs, pii.all_spans(docs, pii.Tagger(field))):
        places = [m.span(1) for m in secret.finditer(text)]
        wanted += len(places)
        good += sum((4, a, b) in every for a, b in places)
        more += sum(k == 4 and (a, b) not in places for k, a, b in every)
    assert wanted > 5 and good >= 0.95 * wanted and more <= 0.05 * wanted


def test_find_and_redact(make, odd, rows_of):
    text = "Ask und.34@mail7.example.com or 97.51.17.173, card 4417744280351547 and +1 (017) 555-7713.\ntoken = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
    docs = make([*odd, (50, text)])
    rows = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert len(rows) < pii.find_pii(docs).count() == len(odd) + 1
    r = rows[50]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, int(pii.luhn("4417744280351547")), 1)
    base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(text))
    assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base) and "secret:" in r.spans
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    new = {r.doc_id: r for r in clean.collect()}
    assert new[50].text.startswith("Ask <EMAIL> or <IP>") and "<SECRET>" in new[50].text and new[50].n_chars == len(new[50].text)
    assert new[1].text is None and new[6].text == "x " * 70_000
    assert pii.redacted("abcdef", [(0, 1, 3), (1, 2, 5)]) == "a<EMAIL>f"
    assert pii.find_pii(make([])).count() == 0 and pii.redact(make([])).count() == 0


# --- SentencePiece


def test_codec_is_the_library():
    sp, c = sentencepiece.SentencePieceProcessor(model_file=MODEL), PieceCodec(MODEL)
    assert c.splits
    r = random.Random(1)
    parts = [*"ab \n\tñ▁é́ﬁ中ü  0,.　\x00😀", "<s>", "</s>", "<0x41>", "xin chào", "the"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(8000)]
    for t, (ids, exact) in zip(texts, c.encode(texts)):
        full = sp.encode(t, add_bos=True, add_eos=True)
        assert ids.tolist() == full, t
        assert not exact or sp.decode(full) == t


def test_encode_decode(make, odd):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {}
    for r in encode_decode(make(odd), MODEL, keep=True).collect():
        rows.setdefault((r.doc_id, r.ids_sha256), r)
    for i, t in odd:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        r = rows[i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()]
        assert r.n_tokens == len(ids) and list(r.ids) == ids and r.decoded == sp.decode(ids)
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert encode_decode(make([]), MODEL).count() == 0


def test_small_table(monkeypatch):
    from inkmill.llm import word_table

    monkeypatch.setattr(word_table, "LIMIT", 5)
    sp, c = sentencepiece.SentencePieceProcessor(model_file=MODEL), PieceCodec(MODEL)
    for k in range(5):
        texts = [" ".join(f"w{k * 7 + j}" for j in range(9)), "a b c"]
        assert [i.tolist() for i, _ in c.encode(texts)] == sp.encode(texts, add_bos=True, add_eos=True)
