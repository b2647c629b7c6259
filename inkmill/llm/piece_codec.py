"""SentencePiece encoding and decoding through a table of distinct marked words.

The vocabulary has no piece in which the white-space marker follows another character, so no piece crosses the
start of a marked word (a run of markers and the characters up to the next marker). Each distinct marked word is
therefore segmented once, kept in a table that each worker has, and the ids of a slice of texts are read from
the table by position. A vocabulary with crossing pieces, and a text that holds the marker itself, go through the
library whole. Decoding uses the same table: a word's pieces decode on their own, since byte pieces of one
character never lie in two words.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkmill.llm.common import documents, id_and_text, slices, texts
from inkmill.llm.word_table import Ragged, WordTable

MARK = "▁"
WORD = re.compile(r" +[^ ]*")


class PieceCodec:
    """encode(texts) gives for each text its ids with begin and end; decode(ids) is the library's."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        sp, pieces = self.sp, [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.bos, self.eos, self.mark = np.array([sp.bos_id()], np.uint32), np.array([sp.eos_id()], np.uint32), sp.piece_to_id(MARK)
        # The shortcut needs words that no piece joins and a normaliser that changes nothing but spaces.
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces) and sp.encode("a  b c") == [*sp.encode("a"), *sp.encode(" b"), *sp.encode("c")]
        self.ids, self.exact = Ragged(np.uint32), Ragged(np.bool_)
        self.table = WordTable(self._learn, lambda: (self.ids.clear(), self.exact.clear()))

    def _learn(self, words: list[str]) -> None:
        """words as they stand after the first of their markers."""
        ids = [i or [self.mark] for i in self.sp.encode(words, num_threads=1)]
        self.ids.extend(ids)
        same = np.array([a == b for a, b in zip(self.sp.decode(ids, num_threads=1), words)], np.bool_)
        self.exact.append(same, np.ones(len(same), np.int64))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """(ids as uint32, decodes to the text itself) for each text; the flag may be False where it does."""
        words, sizes = [], []
        for text in texts:
            if not text or not self.splits or MARK in text:
                sizes.append(0)
            elif "  " in text or text[0] == " " or text[-1] == " ":
                words.append([w[1:] for w in WORD.findall(" " + text)])
                sizes.append(len(words[-1]))
            else:
                words.append(text.split(" "))
                sizes.append(len(words[-1]))
        k = self.table.numbers(list(chain.from_iterable(words)))
        del words
        ids, ends = self.ids.joined(k)
        exact = self.exact.flat[k]
        out, at, low = [], 0, 0
        for text, n in zip(texts, sizes):
            if n:
                high = int(ends[at + n - 1])
                out.append((np.concatenate([self.bos, ids[low:high], self.eos]), bool(exact[at : at + n].all())))
                at, low = at + n, high
            else:
                out.append((np.array(self.sp.encode(text, add_bos=True, add_eos=True), np.uint32), False))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.sp.decode(ids.tolist())


_codecs: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    """One codec per worker and model."""
    if model not in _codecs:
        _codecs[model] = PieceCodec(model)
    return _codecs[model]


def encode_decode(docs: DataFrame, model: str, keep: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep also ids and decoded.

    Null text counts as empty: its ids are begin and end. doc_id may be null or repeat; rows come out as they
    go in, and an empty table gives none.
    """

    def mapped(batches):
        c = codec(model)
        for whole in batches:
            for batch in slices(whole):
                some, rows = texts(batch), []
                for text, (ids, exact) in zip(some, c.encode(some)):
                    decoded = text if exact else c.decode(ids)
                    rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids, decoded))
                n, a, b, ids, decoded = zip(*rows)
                cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    cols += [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    more = ", ids array<int>, decoded string" if keep else ""
    return id_and_text(docs).mapInArrow(mapped, f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
