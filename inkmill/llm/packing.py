"""Lexical retrieval packing: documents that share words are packed into the same token windows.

Each text becomes ids once, and of a slice of texts each different word. A text's words (runs of ids from one word start
to the next) give BM25 terms, hashed into 2**BITS buckets so that corpus counts have a fixed size. Documents are sorted by
the least hash of their terms, so lexically close ones meet, and cut into shards; a shard has its own inverted index with
weights from the counts of the whole corpus. A seed document opens a window; the index returns its unused neighbours by
BM25 score, which fill the window greedily. What of the last one doesn't fit is the next seed. Only a shard's last window
is not full.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import documents, id_and_text, slices, staged, tidied

WINDOW, END = 2048, 1
BITS = 18
K1, B = 1.2, 0.75
#: A shard ends with the document that brings it to either.
SHARD_DOCS, SHARD_TOKENS = 1024, 1 << 21
#: ids that a task packs, about.
TASK_IDS = 1 << 23
#: A word in one of DENSE documents of a shard, or more, is scored by a matrix product.
DENSE = 16
#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space that white space or the end follows, as RE2 spells what PATTERN holds for white space.
LOOSE = r" ([\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|$)"
#: A run of white space longer than this goes through the tokenizers library, whose matcher has no depth limit.
LONG_WHITE = " " * 10_000


def _byte_of() -> dict[str, int]:
    """The byte each character of the vocabulary file stands for: printable ones themselves, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteCodec:
    """ids of a text by a byte-level tokenizer file, as uint16 where its vocabulary allows."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = 1 + max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])])
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        #: ids with which a word starts: all but those that begin with a letter or the rest of one
        self.starts = np.ones(size, bool)
        #: ids that begin with a space
        self.spaced = np.zeros(size, bool)
        for token, i in ranks.items():
            self.starts[i] = not (token[:1].isalpha() or token[0] >= 0x80)
            self.spaced[i] = token[0] == 0x20
        self.mixed = np.random.default_rng(11).integers(1, 1 << 32, size, dtype=np.uint32)

    def _encoded(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.kind)

    def ids(self, text: str) -> np.ndarray:
        """The text's ids and END."""
        if any(s in text for s in self.special) or LONG_WHITE in text:
            ids = np.array(self.slow.encode(text, add_special_tokens=False).ids, self.kind)
        else:
            ids = self._encoded(text)
        return np.append(ids, self.kind(END))

    def all_ids(self, given: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of all texts, null as empty, joined, and where those of each text end.

        PATTERN always cuts before a space that something other than white space follows. So the words after a text's
        first space are encoded once for each that is different, joined by spaces; no other id there begins with a space,
        which tells the words apart again. A text with other spaces, or a special token, is encoded as a whole.
        """
        given = pc.fill_null(given, "")
        whole = pc.match_substring_regex(given, LOOSE)
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(given, s))
        parts = pc.split_pattern(pc.if_else(whole, "", given), " ")
        more = pc.list_value_length(parts).to_numpy().astype(np.int64) - 1
        slot = np.cumsum(more + 2)  # a text's first word, those after it, END
        head = slot - more - 2
        words = parts.flatten()
        after = np.ones(len(words), bool)
        after[head - np.arange(len(head))] = False
        words = words.filter(pa.array(after)).dictionary_encode()
        known = words.dictionary
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), " ")[0].as_py() if len(known) else ""
        table = self._encoded(" " + joined) if len(known) else np.zeros(0, self.kind)
        low = np.flatnonzero(self.spaced[table])
        assert len(low) == len(known)
        firsts = [self.ids(t)[:-1] if w else self._encoded(f) for t, w, f in zip(given.to_pylist(), whole.to_pylist(), pc.list_element(parts, 0).to_pylist())]
        n = np.concatenate([np.diff(low, append=len(table)), np.fromiter(map(len, firsts), np.int64, len(firsts)), [1]])
        flat = np.concatenate([table, *firsts, np.array([END], self.kind)])
        low = np.cumsum(n) - n
        which = np.empty(len(after) + len(given), np.int64)
        rest = np.ones(len(which), bool)
        rest[head] = rest[slot - 1] = False
        which[head], which[slot - 1], which[rest] = len(known) + np.arange(len(given)), len(n) - 1, words.indices.to_numpy()
        n = n[which]
        ends = np.cumsum(n)
        at = np.repeat(low[which] - ends + n, n)
        at += np.arange(len(at))
        return flat[at], ends[slot - 1]

    def terms(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the words of documents, whose ids are joined: the number of each one's document, bucket, and how
        often it is there, in order of documents and buckets. The words' ids, END left out, are mixed and summed."""
        starts = self.starts[ids]
        starts[0] = starts[ends[:-1]] = starts[ends - 1] = True  # END is by itself, the last of each document
        at = np.flatnonzero(starts)
        h = np.add.reduceat(self.mixed[ids], at, dtype=np.uint32)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h >>= np.uint32(32 - BITS)
        last = np.searchsorted(at, ends) - 1
        key = np.delete(np.repeat(np.arange(len(ends)) << BITS, np.diff(last, prepend=-1)) | h, last)
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        return key[first] >> BITS, key[first] & (1 << BITS) - 1, np.diff(first, append=len(key))


@lru_cache(1)
def codec(path: str) -> ByteCodec:
    return ByteCodec(path)


def _tokenised(path: str):
    @tidied
    def mapped(batches):
        c = codec(path)
        seen = np.zeros(1 << BITS, np.int64)
        docs = length = 0
        names = ["doc_id", "ids", "key", "bucket", "n"]
        for whole in batches:
            for batch in slices(whole):
                ids, ends = c.all_ids(batch.column("text"))
                owner, term, _ = c.terms(ids, ends)
                seen += np.bincount(term, minlength=1 << BITS)
                keys = np.zeros(batch.num_rows, np.int64)
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                if len(first):
                    mixed = term.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)
                    keys[owner[first]] = np.minimum.reduceat(mixed, first).astype(np.int64)
                length += len(ids)
                offsets = pa.array(np.append(0, ends) * ids.itemsize, pa.int64())
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(ids)])
                docs += batch.num_rows
                none = pa.nulls(batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held.cast(pa.binary()), pa.array(keys), none, none], names)
        at = np.flatnonzero(seen)
        # counts end with the number of documents and of ids
        at, n = np.append(at, [-1, -2]), np.append(seen[at], [docs, length])
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(at), pa.binary()), none, pa.array(at), pa.array(n)], names)

    return mapped


class Shard:
    """An inverted index over some documents with BM25 weights, and its greedy packing."""

    def __init__(self, docs: list[tuple[object, np.ndarray]], c: ByteCodec, idf: np.ndarray, mean: float):
        self.docs = docs
        size = np.array([len(ids) for _, ids in docs])
        self.owner, term, tf = c.terms(np.concatenate([ids for _, ids in docs]), np.cumsum(size))
        norm = K1 * (1 - B + B * size / max(mean, 1))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.owner])
        # words of many documents are columns of a matrix, the others have postings
        common = np.flatnonzero(np.bincount(term, minlength=1 << BITS) * DENSE >= len(docs))
        column = np.full(1 << BITS, -1, np.int32)
        column[common] = np.arange(len(common))
        dense = column[term] >= 0
        self.matrix = np.zeros((len(docs), len(common)), np.float32)
        self.matrix[self.owner[dense], column[term[dense]]] = weight[dense]
        self.owner, term, weight = self.owner[~dense], term[~dense], weight[~dense]
        n = np.bincount(self.owner, minlength=len(docs))
        order = np.argsort(term << 32 | self.owner)  # one of a kind, so any sort will do
        self.post, self.weight = self.owner[order], weight[order]
        sorted_terms = term[order]
        head = np.flatnonzero(np.diff(sorted_terms, prepend=-1))
        self.low = np.zeros(1 << BITS, np.int32)
        self.count = np.zeros(1 << BITS, np.int32)
        self.low[sorted_terms[head]] = head
        self.count[sorted_terms[head]] = np.diff(head, append=len(term))
        ends = np.cumsum(n)
        self.terms = [term[a:b] for a, b in zip((ends - n).tolist(), ends.tolist())]

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of every document of the shard for the words of ``doc``."""
        t = self.terms[doc]
        n = self.count[t]
        at = np.repeat(self.low[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rare = np.bincount(self.post[at], self.weight[at], minlength=len(self.docs))
        return rare + self.matrix @ (self.matrix[doc] > 0).astype(np.float32)

    def packed(self):
        """(window, doc, start, length, offset) of each piece; windows count from 0 and all but the last are full."""
        free = np.ones(len(self.docs), bool)
        window = offset = 0
        nearest = None
        for first in range(len(self.docs)):
            doc = first if free[first] else None
            while doc is not None:
                free[doc] = False
                size, start = len(self.docs[doc][1]), 0
                cut = False
                while start < size:
                    n = min(size - start, WINDOW - offset)
                    yield window, doc, start, n, offset
                    start, offset = start + n, offset + n
                    if offset == WINDOW:
                        window, offset, nearest, cut = window + 1, 0, None, start < size
                if offset == 0:
                    break  # the window is full to the id: any unused document may open the next
                if nearest is None or cut:  # this document opened the window
                    nearest = self.scores(doc)
                nearest[~free] = -1
                best = int(nearest.argmax())
                doc = best if nearest[best] >= 0 else None
            if not free[first:].any():
                break


def _packed(path: str, stats, keep: bool):
    @tidied
    def mapped(batches):
        c = codec(path)
        idf, mean = stats.value
        base = TaskContext.get().partitionId() << 33
        used = 0

        def done(docs):
            nonlocal used
            rows, last = [], -1
            for window, k, start, n, offset in Shard(docs, c, idf, mean).packed():
                doc_id, ids = docs[k]
                part = ids[start : start + n].astype("<u4").tobytes()
                rows.append((doc_id, start, n, zlib.crc32(part), len(ids), base + used + window, offset, *([part] if keep else [])))
                last = window
            used += last + 1
            kinds = [pa.int64()] * 7 + [pa.binary()] * keep
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: 7 + keep])

        held, size = [], 0
        for whole in batches:
            for batch in slices(whole, "ids"):
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                    held.append((doc_id, np.frombuffer(raw, c.kind)))
                    size += len(held[-1][1])
                    if len(held) >= SHARD_DOCS or size >= SHARD_TOKENS:
                        yield done(held)
                        held, size = [], 0
        if held:
            yield done(held)

    return mapped


def pack(docs: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with keep its ids.

    path: a byte-level tokenizer file. Null text counts as empty; an empty text is the one id END. Null ids and
    repeated rows are packed like others. An empty table gives no rows. A long document fills as many windows as it
    needs; groups of copies are neighbours in the sort, and shards cut them anywhere. Rows that the sort can't tell
    apart are equal, so their order doesn't matter. Further columns, whatever their names, are not read.
    """
    rows = staged(id_and_text(docs).mapInArrow(_tokenised(path), "doc_id long, ids binary, key long, bucket long, n long"), "ids")
    counts = rows.filter("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    at, n = counts["bucket"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    total, length = (float(n[at == k].sum()) for k in (-1, -2))
    df = np.zeros(1 << BITS)
    df[at[at >= 0]] = n[at >= 0]
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    stats = docs.sparkSession.sparkContext.broadcast((idf, length / max(total, 1)))  # 2**BITS numbers
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(length) // TASK_IDS + 1)
    ranged = rows.filter("bucket is null").select("doc_id", "ids", "key").repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
    more = ", ids binary" if keep else ""
    return ranged.mapInArrow(_packed(path, stats, keep), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + more)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
