"""SentencePiece encoding and decoding with seeded merge-dropout.

The vocabulary is read from a SentencePiece BPE model file (spaces become U+2581,
one is put in front, characters outside the vocabulary fall back to bytes). The
encoder keeps an agenda of candidate merges, best score first, then leftmost.
With ``dropout`` p, a candidate taken from the agenda is skipped if a keyed hash
falls below p; a skipped candidate comes back only as part of a new pair. The
key is (seed, variant, chunk, position, merged piece): texts are cut in chunks
that no piece spans (a run of spaces with the word after it, or a line feed),
and each occurrence of a chunk is given one of ``variants`` variants by a keyed
hash of the document's id and the chunk's place. So reruns agree, equal words
are segmented differently from place to place, and a batch works out each
distinct (chunk, variant) once.

``dropout`` 0 gives the library's own encoding. Decoding returns the text
exactly; a U+2581 in the text itself is written as bytes, so it is not taken
for a space. Null texts give null ids; empty texts give no ids. Rows are
independent, so repeated rows and ties need no rule; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.batches import mix64, slices

DROPOUT = 0.1
VARIANTS = 8
SEED = 11
SPACE = "▁"
_WIDEST = 32  # longer chunks are merged one by one
_SLOTS = (1 << 20) - 1  # of the table of mergeable pairs
_SLICE = 5 << 20  # bytes of text worked on at a time
_M64 = (1 << 64) - 1


def model_file() -> str:
    """The vocabulary file of the public tokenizers on this machine."""

    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str | None = None) -> bytes:
    """The contents of a vocabulary file (by default ``model_file``)."""

    with open(path or model_file(), "rb") as f:
        return f.read()


def _slot(code: np.ndarray) -> np.ndarray:
    return ((code * np.int64(-7046029254386353131)) >> np.int64(20)) & np.int64(_SLOTS)


class Pieces:
    """The pieces of a model, and the two directions for one text."""

    def __init__(self, model: bytes, dropout: float = 0.0, variants: int = 1, seed: int = SEED):
        import re

        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        self.piece = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.byte = {i: int(p[3:5], 16) for i, p in enumerate(self.piece) if sp.is_byte(i)}
        plain = [i for i in range(len(self.piece)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {self.piece[i]: i for i in plain}
        self.rank = {self.piece[i]: (-sp.get_score(i), i) for i in plain}
        self.byte_id = {v: i for i, v in self.byte.items()}
        self.written = [bytes((self.byte[i],)) if i in self.byte else p.replace(SPACE, " ").encode() for i, p in enumerate(self.piece)]
        spans = any(SPACE in p.lstrip(SPACE) for p in self.id)
        lines = any("\n" in p for p in self.id)
        self.chunks = re.compile(r"(?s).+" if spans else r"(?s) *[^ ]+| +" if lines else r" *[^ \n]+| +|\n").findall
        self.limit = int(dropout * (1 << 64))
        self.variants = variants if self.limit else 1
        self.seed = seed
        self.by_rank = np.array(sorted(plain, key=lambda i: self.rank[self.piece[i]]), dtype=np.int64)
        place = {int(i): k for k, i in enumerate(self.by_rank)}
        made = {(self.id[p[:k]], self.id[p[k:]]): place[i] for p, i in self.id.items() for k in range(1, len(p)) if p[:k] in self.id and p[k:] in self.id}
        code = np.array([a * len(self.piece) + b for a, b in made], dtype=np.int64)
        self._hash_pairs(code, np.array(list(made.values()), dtype=np.int32))

    def _hash_pairs(self, code: np.ndarray, rank: np.ndarray) -> None:
        """Open addressing: a pair sits at its slot or the next free ones."""

        self.slot_pair = np.full(_SLOTS + 1, -1, dtype=np.int64)
        self.slot_rank = np.zeros(_SLOTS + 1, dtype=np.int32)
        slot, self.probes = _slot(code), 0
        while len(code):
            self.probes += 1
            free = self.slot_pair[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = np.zeros(len(code), dtype=bool)
            put[first] = True
            put &= free
            self.slot_pair[slot[put]], self.slot_rank[slot[put]] = code[put], rank[put]
            code, rank, slot = code[~put], rank[~put], (slot[~put] + 1) & _SLOTS

    def _leaf(self, symbol: str) -> list[int]:
        got = self.id.get(symbol)
        if got is not None:
            return [got]
        return [self.byte_id[b] for b in symbol.replace("\x00\x00", SPACE).encode("utf-8", "surrogatepass")]

    def chunk(self, chunk: str, variant: int) -> tuple[int, ...]:
        """Ids of one chunk: the agenda of merges."""

        from xxhash import xxh64_intdigest

        rank, limit = self.rank, self.limit
        sym = ["\x00\x00" if c == SPACE else SPACE if c == " " else c for c in chunk]
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            r = rank.get(sym[i] + sym[i + 1])
            if r is not None:
                agenda.append((r[0], i, r[1], sym[i] + sym[i + 1], i + 1))
        heapq.heapify(agenda)
        key = xxh64_intdigest(chunk.encode("utf-8", "surrogatepass"), self.seed * 1_000_003 + variant) if limit and agenda else 0
        while agenda:
            _, i, pid, merged, j = heapq.heappop(agenda)
            if j >= n or right[i] != j or sym[i] is None or sym[j] is None or len(sym[i]) + len(sym[j]) != len(merged) or sym[i] + sym[j] != merged:
                continue
            if limit:
                h = (key ^ (i * 0x9E3779B97F4A7C15 + pid * 0xC2B2AE3D27D4EB4F)) & _M64
                h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & _M64
                h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) & _M64
                if h < limit:
                    continue
            sym[i], sym[j] = merged, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(merged + sym[k])
                if r is not None:
                    heapq.heappush(agenda, (r[0], i, r[1], merged + sym[k], k))
            p = left[i]
            if p >= 0:
                r = rank.get(sym[p] + merged)
                if r is not None:
                    heapq.heappush(agenda, (r[0], p, r[1], sym[p] + merged, i))
        out: list[int] = []
        for s in sym:
            if s is not None:
                got = self.id.get(s)
                if got is None:
                    out += self._leaf(s)
                else:
                    out.append(got)
        return tuple(out)

    def variant_of(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The variant of each chunk, from its document's key and its place."""

        if self.variants == 1:
            return np.zeros(len(places), dtype=np.int64)
        mixed = mix64(places.astype(np.uint64) + keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return ((mixed >> np.uint64(32)) % np.uint64(self.variants)).astype(np.int64)

    def encode(self, text: str, key: int = 0) -> list[int]:
        """Ids of one text, chunk by chunk; ``key`` is the document's."""

        found = self.chunks(" " + text) if text else []
        which = self.variant_of(np.full(len(found), key & _M64, dtype=np.uint64), np.arange(len(found)))
        return [i for c, v in zip(found, which.tolist(), strict=True) for i in self.chunk(c, v)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids made by ``encode``."""

        return b"".join([self.written[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]

    # The same for a batch: every distinct (chunk, variant) once, all of one
    # length class side by side.

    def _merge_together(self, sym: np.ndarray, key: np.ndarray) -> np.ndarray:
        """``sym``: one row per chunk, ids of its characters (-2 and below: not
        in the vocabulary), filled up with -1. Every step takes each row's best
        candidate; the right part of a merge becomes -1."""

        n, m = sym.shape
        none = np.iinfo(np.int32).max
        cand = np.full((n, m + 1), none, dtype=np.int32)
        cand[:, : m - 1] = self._candidates(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, m - 1)
        sym = np.concatenate([sym, np.full((n, 1), -1, dtype=sym.dtype)], axis=1)  # a column that neighbours past the end fall on
        right = np.broadcast_to(np.minimum(np.arange(1, m + 2), m).astype(np.int8), (n, m + 1)).copy()
        left = np.broadcast_to(np.r_[m, np.arange(0, m)].astype(np.int8), (n, m + 1)).copy()
        out, live = sym.copy(), np.arange(n)
        while True:
            j = cand.argmin(axis=1)
            rows = np.flatnonzero(cand[np.arange(len(cand)), j] != none)
            if len(rows) * 2 < len(cand):  # most rows are done: go on with the others only
                out[live] = sym
                if not len(rows):
                    return out[:, :m]
                live, sym, cand, right, left, key, j = (x[rows] for x in (live, sym, cand, right, left, key, j))
                rows = np.arange(len(rows))
            j = j[rows]
            pid = self.by_rank[cand[rows, j]]
            skip = self._skipped(key[rows], j, pid)
            cand[rows[skip], j[skip]] = none
            r, j, pid = rows[~skip], j[~skip], pid[~skip]
            k = right[r, j]
            after, before = right[r, k], left[r, j]
            sym[r, j], sym[r, k] = pid, -1
            cand[r, k] = none
            right[r, j] = after
            left[r, after] = j
            cand[r, j] = self._candidates(pid, sym[r, after])
            cand[r, before] = self._candidates(sym[r, before], pid)
            cand[r, m] = none

    def _candidates(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that the neighbours a, b make, or the largest int."""

        out = np.full(len(a), np.iinfo(np.int32).max, dtype=np.int32)
        some = np.flatnonzero((a >= 0) & (b >= 0))
        code = a[some].astype(np.int64) * len(self.piece) + b[some]
        slot = _slot(code)
        for _ in range(self.probes):
            at = self.slot_pair[slot]
            hit = at == code
            out[some[hit]] = self.slot_rank[slot[hit]]
            go = ~hit & (at >= 0)
            some, code, slot = some[go], code[go], (slot[go] + 1) & _SLOTS
            if not len(some):
                break
        return out

    def _skipped(self, key: np.ndarray, start: np.ndarray, pid: np.ndarray) -> np.ndarray:
        if not self.limit:
            return np.zeros(len(key), dtype=bool)
        h = key ^ (start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pid.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h < np.uint64(self.limit)

    def _distinct(self, chunks: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each (chunk, variant), end to end, and their offsets."""

        from xxhash import xxh64_intdigest

        size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, widths, ids
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 18), (18, _WIDEST)):
            rows = np.flatnonzero((size > low) & (size <= high))
            if not len(rows):
                continue
            text = [chunks[i] for i in rows.tolist()]
            codes = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            coded = pa.array(codes).dictionary_encode()
            used, back = coded.dictionary.to_numpy(), coded.indices.to_numpy(zero_copy_only=False)
            first = np.array([self.id.get(SPACE if c == 32 else "" if chr(c) == SPACE else chr(c), -2 - c) for c in used.tolist()], dtype=np.int64)
            sym = np.full((len(rows), high), -1, dtype=np.int32)
            sym[np.arange(high)[None, :] < size[rows][:, None]] = first[back]
            key = np.array([xxh64_intdigest(t.encode("utf-8", "surrogatepass"), self.seed * 1_000_003 + v)
                            for t, v in zip(text, variants[rows].tolist(), strict=True)], dtype=np.uint64)
            ids = self._merge_together(sym, key)
            width = (ids != -1).sum(axis=1)
            ids = ids[ids != -1].astype(np.int64)
            if (ids < 0).any():  # characters outside the vocabulary become bytes
                code = np.where(ids < 0, -2 - ids, 0)
                spelled = [list(chr(c).encode("utf-8", "surrogatepass")) for c in np.unique(code).tolist()]
                order = np.searchsorted(np.unique(code), code)
                n = np.where(ids < 0, np.array([len(x) for x in spelled])[order], 1)
                ends = np.cumsum(n)
                inner = np.arange(ends[-1]) - np.repeat(ends - n, n)
                table = np.array([[self.byte_id[b] for b in x] + [0] * (4 - len(x)) for x in spelled], dtype=np.int64)
                of = np.repeat(np.arange(len(ids)), n)
                owner = np.repeat(np.arange(len(rows)), width)
                width = np.bincount(owner, weights=n, minlength=len(rows)).astype(np.int64)
                ids = np.where(ids[of] < 0, table[order[of], np.minimum(inner, 3)], ids[of])
            found.append((rows, width, ids))
        for i in np.flatnonzero(size > _WIDEST).tolist():
            ids = np.array(self.chunk(chunks[i], int(variants[i])), dtype=np.int64)
            found.append((np.array([i]), np.array([len(ids)]), ids))
        rows = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.int64)
        width = np.concatenate([f[1] for f in found]) if found else rows
        ids = np.concatenate([f[2] for f in found]) if found else rows
        begin = np.zeros(len(chunks), dtype=np.int64)
        count = np.zeros(len(chunks), dtype=np.int64)
        begin[rows], count[rows] = np.cumsum(width) - width, width
        return ids, np.stack([begin, count])

    def encode_batch(self, texts: pa.Array, keys: np.ndarray) -> pa.ListArray:
        """Ids of each text (null for null)."""

        found: list[str] = []
        upto = [0]
        for t in texts.to_pylist():
            if t:
                found += self.chunks(" " + t)
            upto.append(len(found))
        n, ends = np.diff(upto), np.array(upto[1:], dtype=np.int64)
        coded = pa.array(found, type=pa.string()).dictionary_encode()
        del found
        place = np.arange(n.sum()) - np.repeat(ends - n, n)
        which = self.variant_of(np.repeat(keys.astype(np.uint64), n), place)
        pairs = pa.array(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * self.variants + which).dictionary_encode()
        both, back = pairs.dictionary.to_numpy(), pairs.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary.take(pa.array(both // self.variants)).to_pylist()
        ids, (begin, count) = self._distinct(words, both % self.variants)
        begin, count = begin[back], count[back]
        upto = np.cumsum(count)
        total = int(upto[-1]) if len(upto) else 0
        flat = ids[np.repeat(begin - (upto - count), count) + np.arange(total)] if total else np.zeros(0, dtype=np.int64)
        offsets = np.r_[0, np.r_[0, upto][ends]].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)), mask=texts.is_null())

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """The texts of lists of ids (null for null)."""

        spelled = pa.array(self.written, type=pa.binary()).take(ids.flatten())
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), spelled)
        texts = pc.utf8_slice_codeunits(pc.binary_join(lists, b"").cast(pa.string()), 1)  # without the space put in front
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           dropout: float = DROPOUT, variants: int = VARIANTS, seed: int = SEED) -> DataFrame:
    """(id_col, ids, n_ids) for every row of ``docs``."""

    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value, dropout, variants, seed)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                key = part.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
                ids = pieces.encode_batch(part.column("text"), key)
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, pc.list_value_length(ids)], names=[id_col, "ids", "n_ids"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.IntegerType())])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(seed), id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the decoded text added as ``text_col``."""

    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, pieces.decode_batch(part.column(ids_col))], names=[*part.schema.names, text_col])

    return encoded.mapInArrow(run, schema)
