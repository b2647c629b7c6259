"""Language identification of mixed-language text.

Each distinct word gets a score per language, the log-probabilities of its letter n-grams; the scripts of its
letters, told by ranges of code points, leave only the languages that were learned with that script as candidates.
Viterbi over a text's words with a penalty for each switch labels spans; the prediction is the language with the
most letters, its score that language's share of the letters.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, held_out, slices, texts
from inkmill.llm.word_table import WordTable

#: Documents of each language that the fit uses, in expectation, at most: those with the smallest hash of doc_id.
FIT_DOCS = 1500
#: Languages that the fit learns at most: those of most documents, ties by name. A dirty column has more values.
FIT_LANGUAGES = 128
BITS, ORDERS = 16, (1, 2, 3, 4)
#: Weight of an n-gram's log-probability (n-grams overlap) and the cost of a switch between languages.
WEIGHT, SWITCH = 0.35, 6.0
#: A language has a script if this share of its letters is in it.
SHARE = 0.01
BLOCK = 1 << 17
UNKNOWN = "und"
#: First code points of script ranges, fixed by the Unicode blocks, and the script from there on.
RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"),
    (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB07, "other"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
    (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
]
SCRIPTS = sorted({s for _, s in RANGES})
_STARTS = np.array([a for a, _ in RANGES], np.uint32)
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in RANGES], np.int64)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters of all words, each word between two zeros; where words start; letters in each."""
    kept = ["".join(filter(str.isalpha, w.lower())) if not w.isalpha() else w.lower() for w in words]
    code = np.frombuffer(("\0" + "\0\0".join(kept) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.array([len(w) for w in kept], np.int64)
    return code, np.cumsum(n + 2) - (n + 2), n


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, the word it is from, letters of each word, letters of each word by script)."""
    code, start, n = _codes(words)
    owner = np.repeat(np.arange(len(words)), n + 2)
    buckets, owners = [], []
    for k in ORDERS:
        if len(code) < k:
            continue
        h = np.full(len(code) - k + 1, k * 0x1E3779B1, np.uint32)
        for j in range(k):
            h = (h ^ code[j : len(code) - k + 1 + j]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        inside = owner[: len(code) - k + 1] == owner[k - 1 :]
        if k == 1:
            inside &= code > 0
        buckets.append((h & np.uint32((1 << BITS) - 1))[inside])
        owners.append(owner[: len(code) - k + 1][inside])
    letters = code > 0
    script = _SCRIPT[np.searchsorted(_STARTS, code[letters], "right") - 1]
    by = np.bincount(owner[letters] * len(SCRIPTS) + script, minlength=len(words) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners), n, by


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        """counts: (language, bucket) n-grams seen; scripts: (language, script) letters seen."""
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        self.log = (np.log((counts + 0.1) / (total + 0.1 * counts.shape[1])) * WEIGHT).T.astype(np.float32)
        self.has = scripts >= SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores per word and language, letters per word); a word without letters scores 0 everywhere."""
        bucket, owner, n, by = grams(words)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(len(self.langs)):
            out[:, i] = np.bincount(owner, self.log[bucket, i], minlength=len(words))
        out[n == 0] = 0
        # only the languages learned with the word's main script are candidates; where there are none, all are
        allowed = self.has.T[by.argmax(1)]
        allowed[(n == 0) | ~allowed.any(1)] = True
        out = np.where(allowed, out, -np.inf).astype(np.float32)
        return (out - out.max(1, keepdims=True) if len(self.langs) else out), n


class Labeller:
    """Labels for slices of texts, with a table of the words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()
        self.table = WordTable(self.learn, self.forget)

    def forget(self) -> None:
        self.known, self.letters, self.n = np.zeros((1 << 14, len(self.model.langs)), np.float32), np.zeros(1 << 14, np.int64), 0

    def learn(self, words: list[str]) -> None:
        for at in range(0, len(words), BLOCK):
            scores, letters = self.model.scores(words[at : at + BLOCK])
            end = self.n + len(letters)
            if end > len(self.letters):
                more = len(self.letters) + len(letters)
                self.known = np.concatenate([self.known, np.zeros((more, self.known.shape[1]), np.float32)])
                self.letters = np.concatenate([self.letters, np.zeros(more, np.int64)])
            self.known[self.n : end], self.letters[self.n : end] = scores, letters
            self.n = end

    def label(self, some: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(language of each word, letters of each word) for each text, all texts in one Viterbi run."""
        words = [t.split() for t in some]
        cuts = np.cumsum([len(w) for w in words])[:-1]
        k = self.table.numbers(list(chain.from_iterable(words)))
        del words
        path = viterbi(np.split(self.known[k], cuts))
        return list(zip(path, np.split(self.letters[k], cuts)))


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """Best label of each row in each matrix, where a change of label costs ``switch``.

    The matrices advance together, longest first, so a step costs one numpy pass over those still running."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = np.array([len(scores[i]) for i in order], np.int64)
    first = np.cumsum(sizes) - sizes
    e = np.concatenate([scores[i] for i in order]) if len(order) else np.zeros((0, 1))
    back, final = np.zeros(e.shape, np.int16), np.zeros(len(order), np.int64)
    live = int(np.searchsorted(-sizes, 0, "left"))
    now = e[first[:live]].astype(np.float64)
    for t in range(1, int(sizes[0]) + 1 if live else 0):
        on = int(np.searchsorted(-sizes, -t, "left"))  # still running at step t
        if on < live:
            final[on:live] = now[on:].argmax(1)
            now, live = now[:on], on
        if live:
            best, at = now.argmax(1), first[:live] + t
            top = now[np.arange(live), best] - switch
            stay = now >= top[:, None]
            back[at] = np.where(stay, np.arange(e.shape[1]), best[:, None])
            now = np.where(stay, now, top[:, None]) + e[at]
    out = np.zeros(len(e), np.int64)
    rows, label = np.flatnonzero(sizes > 0), final[sizes > 0]
    at = first[rows] + sizes[rows] - 1
    while len(rows):
        out[at] = label
        label = back[at, label].astype(np.int64)
        at = at - 1
        on = at >= first[rows]
        rows, label, at = rows[on], label[on], at[on]
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(order)
    for k, i in enumerate(order):
        found[i] = out[first[k] : first[k] + sizes[k]]
    return found


def fit(docs: DataFrame, per_language: int = FIT_DOCS, languages: int = FIT_LANGUAGES) -> Model:
    """Counts over a sample of about ``per_language`` documents of each of at most ``languages`` languages, none of them
    held out.

    Null lang or text teaches nothing; without any row the model knows no language. Counting is done where the
    texts are; the driver gets one row for each language and bucket, at most 2**BITS for each language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros((0, len(SCRIPTS))))
    cut = F.try_element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(1_000_000 * min(1.0, per_language / sizes[k]))))]), F.col("lang"))
    # a language that isn't learned has no cut, and its rows go
    some = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < cut)
    width = (1 << BITS) + len(SCRIPTS)

    def mapped(batches):
        total = np.zeros((len(langs), width), np.int64)
        place = {k: i for i, k in enumerate(langs)}
        for whole in batches:
            for batch in slices(whole):
                for text, lang in zip(texts(batch), batch.column("lang").to_pylist()):
                    words = text.split()
                    for at in range(0, len(words), BLOCK):
                        bucket, _, _, by = grams(words[at : at + BLOCK])
                        total[place[lang], : 1 << BITS] += np.bincount(bucket, minlength=1 << BITS)
                        total[place[lang], 1 << BITS :] += by.sum(0)
        a, b = np.nonzero(total)
        for at in range(0, len(a), 100_000):
            i, j = a[at : at + 100_000], b[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["lang", "at", "n"])

    counts = some.select("text", "lang").mapInArrow(mapped, "lang long, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    full = np.zeros((len(langs), width))
    full[counts["lang"].to_numpy(int), counts["at"].to_numpy(int)] = counts["n"]
    return Model(langs, full[:, : 1 << BITS], full[:, 1 << BITS :])


def identify(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and with spans the runs of words of one language.

    A null text or one without letters is und with score 0, as is every text where no language was learned.
    Ties between languages go to the one first by name. Texts of any length are read whole; repeated rows and null ids
    come out as they go in, equal texts with equal labels; an empty table gives no rows. Further columns, whatever their
    names, are not read. spans: array of (first word, last word, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FIT_LANGUAGES * 2**BITS floats

    def mapped(batches):
        reader = Labeller(shared.value)
        langs = reader.model.langs
        for whole in batches:
            for batch in slices(whole):
                pred, score, runs = [], [], []
                for path, n in reader.label(texts(batch)) if langs else [(np.zeros(0, int), np.zeros(0, int))] * batch.num_rows:
                    by = np.bincount(path, n, minlength=max(len(langs), 1))
                    pred.append(langs[int(by.argmax())] if by.sum() else UNKNOWN)
                    score.append(float(by.max() / by.sum()) if by.sum() else 0.0)
                    if spans:
                        edge = np.flatnonzero(np.diff(path, prepend=-1)) if len(path) else np.zeros(0, int)
                        ends = np.append(edge[1:], len(path))
                        runs.append([{"first": int(a), "last": int(b) - 1, "lang": langs[path[a]]} for a, b in zip(edge, ends)])
                cols = [batch.column("doc_id"), pa.array(pred), pa.array(score, pa.float64())]
                if spans:
                    cols.append(pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "lang_pred", "score", "spans"][: len(cols)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(mapped, "doc_id long, lang_pred string, score double" + (", spans array<struct<first: long, last: long, lang: string>>" if spans else ""))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *found.columns[1:])


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit(docs))
