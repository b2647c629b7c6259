"""Personal data: pattern spans, and further spans from a linear-chain conditional random field.

Base spans are leftmost, non-overlapping matches per kind, found in linear time. The field labels white-space
tokens from word-shape features of the token and its two neighbours; it is trained on a small labelled table that
``labelled_table`` builds by rule, and decoded by Viterbi in numpy batches.

Every token gets its scores from the trained weights. Where O outweighs every other label by more than any two
transitions can give back, O is on the best path whatever stands beside it, so the chain falls apart there; Viterbi runs
over the stretches between, all of a batch at once, and its result is that of decoding every token.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, id_and_text, slices, texts, tidied
from inkmill.llm.word_table import WordTable

KINDS = ["email", "ip", "card", "phone", "secret"]
LABELS = ["O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone", "B-secret"]
#: Characters that personal data often has, a feature; tokens are what stands between white space.
MARKS = "0123456789@=+"
_TOKEN = re.compile(r"[^ \t\n\x0b\x0c\r]+")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL_END.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind and start; offsets count code points."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not re.search("[0-9]", text):
        return out
    out += [(1, a, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def labelled_table(rows: int = 600, seed: int = 7) -> list[list[tuple[str, str]]]:
    """Sentences as (token, label), made by rule: personal data among invented words, and numbers that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["th", "er", "in", "ou", "an", "re", "ti", "ble", "sch", "que", "é", "ción", "st"]) for _ in range(r.randint(1, 4)))
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    end = lambda w: w + r.choice(["", "", "", ".", ",", ";"])

    def card():
        d = digits(r.choice([15, 15, 15, 18]))
        return d + next(c for c in "0123456789" if luhn(d + c))

    def entity():
        kind = r.randrange(9)
        if kind == 0:
            return [(end(f"{word()}{r.choice(['.', '_', ''])}{digits(2)}@{word()}{digits(1)}.{r.choice(['com', 'org', 'example.net'])}"), "B-email")]
        if kind == 1:
            return [(end(".".join(str(r.randrange(256)) for _ in range(4))), "B-ip")]
        if kind == 2:
            return [(end(card()), "B-card")]
        if kind == 3:
            c = card()[:16]
            four = [c[i : i + 4] for i in range(0, 16, 4)]
            return [(t, "B-card" if i == 0 else "I-card") for i, t in enumerate([*four[:3], end(four[3])])]
        if kind == 4:
            return [(card(), "B-card"), (end(card()), "B-card")]
        if kind == 5:
            return [(f"+{r.randint(1, 99)}", "B-phone"), (f"({digits(3)})", "I-phone"), (end(f"{digits(3)}-{digits(4)}"), "I-phone")]
        if kind == 6:
            return [(f"({digits(3)})", "B-phone"), (end(f"{digits(3)}-{digits(4)}"), "I-phone")]
        if kind == 7:
            return [(r.choice(["token", "key", "secret", "password"]), "O"), ("=", "O"), (f'"{"".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64])))}"', "B-secret")]
        return [(f"{r.choice(['api_key', 'token', 'key'])}={''.join(r.choice('0123456789abcdefABCDEFGHKLMNPQRSTUVWXYZ') for _ in range(r.choice([24, 32, 40])))}", "B-secret")]

    def other():
        kind = r.randrange(10)
        return [(end([str(r.randint(0, 99)), str(r.randint(1900, 2030)), f"{r.randint(0, 9)}.{r.randint(0, 9)}", f"{r.randint(1, 23)}:{digits(2)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"{r.randint(1, 999)},{digits(3)}", "=", f"{r.randint(1, 99)}%", "+", f"{digits(5)}"][kind]), "O")]

    out = []
    for _ in range(rows):
        row = []
        for _ in range(r.randint(1, 4)):
            for _ in range(r.randint(1, 5)):
                w = word()
                row.append((end(r.choice([w, w, w, w.capitalize(), w.upper(), "token", "key", "|", w + "***"])), "O"))
            row += entity() if r.random() < 0.6 else other()
        out.append(row + [(end(word()), "O")])
    return out


#: Words that stand before secrets.
SAID = {"token", "key", "secret", "password", "="}
#: Tokens whose scores are held at once, and distinct tokens that a task keeps.
BLOCK, TABLE = 1 << 16, 200_000


def _bucket(n: int) -> str:
    return next(str(b) for b in (0, 1, 2, 3, 4, 9, 14, 15, 16, 19, 23, 10**9) if n <= b)


def shape(token: str) -> tuple[str, ...]:
    """Word-shape features; tokens of one shape are alike to the field."""
    core = token.strip(".,;:!?\"'")
    runs = re.sub(r"[0-9]+", lambda m: "d" + _bucket(len(m.group())), re.sub(r"[^\W\d_]+", lambda m: "X" if m.group().isupper() else "x", core))
    alnum, n = sum(c.isalnum() for c in core), sum(c in "0123456789" for c in core)
    lower = core.lower()
    said = lower if lower in SAID else ""
    return (
        "r=" + (runs if len(runs) <= 24 else "long"),
        f"d={_bucket(n)}",
        f"l={_bucket(len(core))}",
        f"mix={n > 0 and alnum > n}|{alnum >= 20}",
        f"at={core.count('@')}",
        f"dots={min(core.count('.'), 4)}",
        f"first={core[:1] if not core[:1].isalnum() else 'a'}",
        f"said={said}",
        f"any={any(c in MARKS for c in token)}",
    )


class Field:
    """A linear-chain conditional random field over (own, previous, next) shape features."""

    def __init__(self, table: list[list[tuple[str, str]]], rounds: int = 80, rate: float = 0.5, ridge: float = 1e-3):
        self.index: dict[tuple[int, str], int] = {}
        n, length, k = len(table), max(map(len, table)), len(LABELS)
        rows = [[self._features([t for t, _ in row], i, grow=True) for i in range(len(row))] for row in table]
        width = max(len(f) for row in rows for f in row)
        feats = np.zeros((n, length, width), np.int64)
        gold, mask = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
        for a, row in enumerate(rows):
            for b, f in enumerate(row):
                feats[a, b, : len(f)], gold[a, b], mask[a, b] = f, LABELS.index(table[a][b][1]), True
        w, t = np.zeros((len(self.index) + 1, k)), np.zeros((k, k))
        sums = [np.full_like(w, 1e-6), np.full_like(t, 1e-6)]
        # tokens in like surroundings are scored once
        kinds, kind = np.unique(feats.reshape(-1, width), axis=0, return_inverse=True)
        kind = kind.reshape(n, length)
        for _ in range(rounds):
            e = np.where(mask[..., None], w[kinds].sum(1)[kind], 0)
            gw, gt = self._gradient(e, t, kinds, kind, gold, mask, w.shape[0])
            for x, g, s in ((w, gw / n - ridge * w, sums[0]), (t, gt / n - ridge * t, sums[1])):
                s += g * g
                x += rate * g / np.sqrt(s)
            w[0] = 0
        self.w, self.t = w, t
        # what a label can win over O by the transitions to its two neighbours
        self.gain = (t - t[:, :1]).max(0) + (t - t[:1]).max(1)

    def _features(self, tokens: list[str], i: int, grow: bool = False) -> list[int]:
        out = []
        for role, j in ((0, i), (1, i - 1), (2, i + 1)):
            for f in shape(tokens[j]) if 0 <= j < len(tokens) else ("edge",):
                if grow:
                    self.index.setdefault((role, f), len(self.index) + 1)
                out.append(self.index.get((role, f), 0))
        return out

    @staticmethod
    def _gradient(e, t, kinds, kind, gold, mask, size):
        """Of the log likelihood, by forward and backward sums; a chain starts after O and ends before O."""
        n, length, k = e.shape
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        last = mask.sum(1) - 1
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = t[0] + e[:, 0]
        for i in range(1, length):
            alpha[:, i] = lse(alpha[:, i - 1, :, None] + t, 1) + e[:, i]
        for i in range(length - 1, -1, -1):
            inner = lse(t + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2) if i + 1 < length else np.broadcast_to(t[:, 0], (n, k))
            beta[:, i] = np.where((i == last)[:, None], t[:, 0], inner)
        z = lse(alpha[np.arange(n), last] + t[:, 0], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        diff = np.eye(k)[gold] * mask[..., None] - p
        gw = np.zeros((size, k))
        by = np.stack([np.bincount(kind.ravel(), diff[..., y].ravel(), len(kinds)) for y in range(k)], axis=1)
        np.add.at(gw, kinds.ravel(), np.repeat(by, kinds.shape[1], axis=0))
        gt = np.zeros((k, k))
        for i in range(1, length):
            on = mask[:, i]
            pair = np.exp(alpha[on, i - 1, :, None] + t + (e[on, i] + beta[on, i])[:, None, :] - z[on, None, None])
            gt -= pair.sum(0)
            np.add.at(gt, (gold[on, i - 1], gold[on, i]), 1)
        gt[0] += (np.eye(k)[gold[:, 0]] - p[:, 0]).sum(0)
        ends = gold[np.arange(n), last]
        gt[:, 0] += (np.eye(k)[ends] - p[np.arange(n), last]).sum(0)
        return gw, gt

    def scores(self, token: str) -> np.ndarray:
        """(role, label) sums of a token's feature weights as itself, as its successor's and its predecessor's neighbour."""
        s = shape(token)
        return np.array([self.w[[self.index.get((role, f), 0) for f in s]].sum(0) for role in range(3)])

    def viterbi(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels for stretches laid out one after another in e; each starts after O and ends before O."""
        order = np.argsort(-lengths, kind="stable")
        n, sizes = len(lengths), lengths[order]
        first = (np.cumsum(lengths) - lengths)[order]
        back = np.zeros((len(e), len(LABELS)), np.int8)
        score = self.t[0] + e[first]
        out, final = np.zeros(len(e), np.int64), np.zeros(n, np.int64)
        live = n
        for i in range(1, int(sizes[0]) + 1 if n else 0):
            now = int(np.searchsorted(-sizes, -i, "left"))  # stretches longer than i
            if now < live:
                final[now:live] = (score[now:live] + self.t[:, 0]).argmax(1)
                live, score = now, score[:now]
            if live:
                step = score[:, :, None] + self.t
                back[first[:live] + i] = step.argmax(1)
                score = step.max(1) + e[first[:live] + i]
        at = first + sizes - 1
        now, label = np.arange(n), final
        while len(now):
            out[at[now]] = label
            label = back[at[now], label].astype(np.int64)
            at[now] -= 1
            on = at[now] >= first[now]
            now, label = now[on], label[on]
        return out


@lru_cache(1)
def field() -> Field:
    return Field(labelled_table())


_ASIDE = ".,;:!?\"'"


class Tagger:
    """Spans of the field for batches of texts."""

    def __init__(self, model: Field):
        self.model = model
        self.edge = np.array([model.w[model.index.get((role, "edge"), 0)] for role in range(3)])
        #: scores of tokens that are alike, and where those of each kind are
        self.known, self.alike = np.zeros((1 << 10, 3, len(LABELS))), {}
        self.forget()
        self.words = WordTable(self.learn, self.forget, TABLE)

    def forget(self) -> None:
        self.kind, self.n = np.zeros(TABLE, np.int32), 0

    def kind_of(self, token: str) -> int:
        """Number of the scores of a token. Tokens of letters only, but for marks around them, are alike if they agree in
        case, length and a few words, others if they agree in shape."""
        core = token.strip(_ASIDE)
        lower = core.lower()
        key = (core.isupper(), min(len(core), 24), lower if lower in SAID else "") if core.isalpha() else shape(token)
        if key not in self.alike:
            if len(self.alike) == len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.known[len(self.alike)] = self.model.scores(token)
            self.alike[key] = len(self.alike)
        return self.alike[key]

    def learn(self, words: list[str]) -> None:
        end = self.n + len(words)
        if end > len(self.kind):  # the words of one slice are always held together
            self.kind = np.concatenate([self.kind, np.zeros(end, np.int32)])
        self.kind[self.n : end] = list(map(self.kind_of, words))
        self.n = end

    def labels(self, some: list[list[str]]) -> np.ndarray:
        """The label of each token of each text, one after another."""
        sizes = np.array([len(t) for t in some], np.int64)
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        total = int(sizes.sum())
        out = np.zeros(total, np.int64)
        if not total:
            return out
        numbers = self.words.numbers(list(chain.from_iterable(some)))
        k = self.kind[numbers]  # only now: the table may have been emptied meanwhile
        last = np.append(first[1:], total) - 1
        starts, ends = np.zeros(total, bool), np.zeros(total, bool)
        starts[first], ends[last] = True, True
        open_ = np.zeros(total, bool)
        # a block at a time, for the scores of all tokens would be many times the text
        for at in range(0, total, BLOCK):
            open_[at : at + BLOCK] = ~self._closed(self._weighed(k, starts, ends, np.arange(at, min(total, at + BLOCK))))
        if not open_.any():
            return out
        heads = open_ & (starts | ~np.append(False, open_[:-1]))
        at = np.flatnonzero(open_)
        lengths = np.diff(np.append(np.flatnonzero(heads[at]), len(at)))
        # stretches of one text after another, as many at once as fit a block; a longer one goes alone
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(BLOCK, len(at) + BLOCK, BLOCK), "right")
        low = row = 0
        for high in np.unique(np.append(cuts, len(lengths))):
            if n := int(lengths[low:high].sum()):
                here = at[row : row + n]
                out[here] = self.model.viterbi(self._weighed(k, starts, ends, here), lengths[low:high])
                low, row = high, row + n
        return out

    def _weighed(self, k: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of the tokens at ``at``: as themselves and as their neighbours have it."""
        before, after = k[np.maximum(at - 1, 0)], k[np.minimum(at + 1, len(k) - 1)]
        e = self.known[k[at], 0]
        e += np.where(starts[at, None], self.edge[1], self.known[before, 1])
        e += np.where(ends[at, None], self.edge[2], self.known[after, 2])
        return e

    def _closed(self, e: np.ndarray) -> np.ndarray:
        """Where O is on every best path."""
        return (e[:, :1] - e[:, 1:] > self.model.gain[1:]).all(1)

    def spans(self, some: list[str]) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) that the field finds in each text and that keep to their kind's form."""
        tokens = [_TOKEN.findall(t) for t in some]
        labels = self.labels(tokens)
        found: list[list[tuple[int, int, int]]] = [[] for _ in some]
        ends = np.cumsum([len(t) for t in tokens])
        hit = np.flatnonzero(labels)
        for k in np.unique(np.searchsorted(ends, hit, "right")).tolist():
            mine = labels[ends[k] - len(tokens[k]) : ends[k]]
            bounds = [m.span() for m in _TOKEN.finditer(some[k])]
            for i in np.flatnonzero(mine).tolist():
                name = LABELS[mine[i]]
                if name[0] != "B":
                    continue
                j = i + 1
                while j < len(mine) and LABELS[mine[j]] == "I" + name[1:]:
                    j += 1
                kind = KINDS.index(name[2:])
                if span := _trimmed(some[k], bounds[i][0], bounds[j - 1][1], kind):
                    found[k].append((kind, *span))
        return found


def _trimmed(text: str, start: int, end: int, kind: int) -> tuple[int, int] | None:
    """The span without punctuation around it, if it has the form of its kind."""
    keep = "+(" if kind == 3 else ""
    while start < end and not (text[start].isalnum() or text[start] in keep):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    value = text[start:end]
    digits = _NOT_DIGIT.sub("", value)
    if kind == 4 and "=" in value:
        start += value.rindex("=") + 1
        while start < end and not text[start].isalnum():
            start += 1
        value = text[start:end]
    good = (
        kind == 0 and value.count("@") == 1 and "." in value.partition("@")[2]
        or kind == 1 and any(True for a, b in _ips(value) if b - a == len(value))
        or kind == 2 and 16 <= len(digits) <= 19 and luhn(digits)
        or kind == 3 and 8 <= len(digits) <= 15
        or kind == 4 and len(value) >= 16 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and value.replace("_", "a").replace("-", "a").isalnum()
    )
    return (start, end) if good else None


def all_spans(some: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base, all) spans of each text; a span of the field that touches a base span is dropped."""
    out = []
    for text, more in zip(some, tagger.spans(some)):
        base = base_spans(text)
        new = [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in base)] if more else []
        out.append((base, sorted([*base, *new])))
    return out


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    spans has the base spans and those of the field, as kind:start:end by kind (email, ip, card, phone, secret)
    and start. Null text counts as empty and has no spans; null ids and repeated rows come out as they go in;
    an empty table gives no rows. Time is linear in a text's length.
    """
    model = field()

    @tidied
    def mapped(batches):
        find = Tagger(model)
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for base, every in all_spans(texts(batch), find):
                    n = [sum(k == i for k, _, _ in base) for i in range(4)]
                    rows.append((*n, hashlib.sha256(_said(base).encode()).hexdigest(), _said(every)))
                cols = list(zip(*rows))
                names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])], names)

    return id_and_text(docs).mapInArrow(mapped, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data replaced in text and n_chars, where there, counted anew. Null stays null."""
    model = field()

    @tidied
    def new(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = Tagger(model)
        for whole in parts:
            out = []
            for some in map(pa.Array.to_pylist, slices(whole)):
                found = all_spans([t or "" for t in some], find)
                out += [t if t is None else redacted(t, every) for t, (_, every) in zip(some, found)]
            yield pa.array(out, pa.string())

    kinds = dict(docs.dtypes)
    done = docs.withColumn("text", F.arrow_udf(new, "string")(F.col("text").cast("string")))
    if "n_chars" in kinds:
        n = F.coalesce(F.length("text").cast(kinds["n_chars"]), F.col("n_chars"))
        done = done.withColumn("n_chars", n)
    return done


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))
