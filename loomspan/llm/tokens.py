"""Byte-level BPE of a public tokenizer over whole columns, with numpy matrices instead of a loop per word."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public vocabulary files are; nothing of them is part of this package.
TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.json"

# How the tokenizer cuts a text into pieces.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A worker keeps the ids of up to so many pieces; then it starts anew.
CACHE_PIECES = 400_000
#: Pieces longer than this many bytes aren't kept.
CACHE_BYTES = 64
#: Cells of one padded matrix.
MATRIX_CELLS = 1 << 20
#: A piece of more bytes than this is merged by itself, with a heap: in a matrix each round copies all of it.
LONG_PIECE = 4096
#: Characters of text that are encoded at once.
CHUNK_CHARS = 4_000_000

_NONE = np.int32(2**31 - 1)


@dataclass(frozen=True)
class Vocabulary:
    """Single bytes' ids and an open-addressing table from a pair of ids to its rank and merged id."""

    byte_ids: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot and rank of each pair; rank _NONE for pairs that never merge."""
        key = (left.astype(np.int64) << 32) | right
        slot = _hash(key, len(self.keys))
        found = self.keys[slot]
        rank = np.where(found == key, self.ranks[slot], _NONE)
        open_ = (found != key) & (found >= 0)
        while open_.any():
            slot = np.where(open_, (slot + 1) & (len(self.keys) - 1), slot)
            found = self.keys[slot]
            rank = np.where(open_ & (found == key), self.ranks[slot], rank)
            open_ &= (found != key) & (found >= 0)
        return slot, rank


def _hash(key: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(17)).astype(np.int64) & (size - 1)


def _printable_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as themselves, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str = TOKENIZER_PATH) -> Vocabulary:
    model = json.loads(open(path, encoding="utf-8").read())["model"]
    ids, written = model["vocab"], {b: c for c, b in _printable_bytes().items()}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
    key, merged = (left << 32) | right, np.array([ids[a + b] for a, b in merges], np.int32)
    size = 1 << (2 * len(merges)).bit_length()
    keys, ranks, into = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
    todo, slot = np.arange(len(key)), _hash(key, size)
    while len(todo):
        at, first = np.unique(slot[todo], return_index=True)
        free = keys[at] < 0
        at, first = at[free], first[free]
        placed = todo[first]
        keys[at], ranks[at], into[at] = key[placed], placed, merged[placed]
        todo = np.setdiff1d(todo, placed, assume_unique=True)
        slot[todo] = (slot[todo] + 1) & (size - 1)
    return Vocabulary(np.array([ids[written[b]] for b in range(256)], np.int32), keys, ranks, into)


def _merge_matrix(vocabulary: Vocabulary, tokens: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge padded rows of ids until no pair of any row is in the vocabulary; gives the rows and their lengths.

    Each round merges, in every row that is left, the leftmost pair of least rank, and with it the row's other pairs of
    that rank that don't overlap it (no pair made by a merge has a lesser rank than the merge). Finished rows are put aside
    and columns that have become empty are cut off.
    """
    n, width = tokens.shape
    out, out_length = np.zeros_like(tokens), length.copy()
    live = np.arange(n)
    slots, ranks = vocabulary.look_up(tokens[:, :-1], tokens[:, 1:]) if width > 1 else (np.zeros((n, 0), np.int64), np.zeros((n, 0), np.int32))
    ranks = np.where(np.arange(1, width)[None, :] < length[:, None], ranks, _NONE)
    while len(live):
        least = ranks.min(axis=1) if ranks.shape[1] else np.full(len(live), _NONE)
        done = least == _NONE
        if done.any():
            out[live[done], : tokens.shape[1]], out_length[live[done]] = tokens[done], length[done]
            keep = ~done
            live, tokens, length, least, slots, ranks = live[keep], tokens[keep], length[keep], least[keep], slots[keep], ranks[keep]
            if not len(live):
                break
        hit = ranks == least[:, None]
        twice = hit[:, 1:] & hit[:, :-1]
        if twice.any():  # aaa: of overlapping pairs in a run, every second one
            for i in np.flatnonzero(twice.any(axis=1)).tolist():
                last = -2
                for j in np.flatnonzero(hit[i]).tolist():
                    if j == last + 1:
                        hit[i, j] = False
                    else:
                        last = j
        row, at = np.nonzero(hit)
        tokens[row, at] = vocabulary.merged[slots[row, at]]
        keep = np.ones(tokens.shape, bool)
        keep[row, at + 1] = False
        keep &= np.arange(tokens.shape[1])[None, :] < length[:, None]
        length = length - hit.sum(axis=1)
        fresh = np.zeros(tokens.shape, bool)
        fresh[row, at] = True
        width = int(length.max())
        inside = np.arange(width)[None, :] < length[:, None]
        compact = np.zeros((len(live), width), tokens.dtype)
        compact[inside] = tokens[keep]
        is_new = np.zeros((len(live), width), bool)
        is_new[inside] = fresh[keep]
        old = np.zeros((len(live), width), np.int64)
        held = np.zeros(tokens.shape, np.int64)
        held[:, :-1] = slots
        old_rank = np.full((len(live), width), _NONE, np.int32)
        held_rank = np.full(tokens.shape, _NONE, np.int32)
        held_rank[:, :-1] = ranks
        old[inside], old_rank[inside] = held[keep], held_rank[keep]
        tokens, slots, ranks = compact, old[:, : width - 1], old_rank[:, : width - 1]
        again = (is_new[:, :-1] | is_new[:, 1:]) & inside[:, 1:]
        r, c = np.nonzero(again)
        slots[r, c], ranks[r, c] = vocabulary.look_up(tokens[r, c], tokens[r, c + 1])
        ranks[~inside[:, 1:]] = _NONE
    return out, out_length


def _merge_long(vocabulary: Vocabulary, piece: bytes) -> np.ndarray:
    """The ids of one long piece: always the leftmost pair of least rank, from a heap; n log n of its length."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    n, known = len(ids), {}
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def look_up(left: int, right: int) -> tuple[int, int]:
        if (left, right) not in known:
            slot, rank = vocabulary.look_up(np.array([left]), np.array([right]))
            known[left, right] = int(rank[0]), int(vocabulary.merged[slot[0]])
        return known[left, right]

    heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := look_up(ids[i], ids[i + 1])[0]) != _NONE]
    heapify(heap)
    while heap:
        _, i, left, right = heappop(heap)
        j = after[i] if ids[i] == left else n
        if j >= n or ids[j] != right:  # merged meanwhile
            continue
        ids[i], ids[j], after[i] = look_up(left, right)[1], -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (far := after[k]) < n and (rank := look_up(ids[k], ids[far])[0]) != _NONE:
                heappush(heap, (rank, k, ids[k], ids[far]))
    return np.array([x for x in ids if x >= 0], np.int32)


def merge_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> list[np.ndarray]:
    """The ids of each piece; pieces of like length are merged in one matrix, very long ones by themselves."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(sizes, kind="stable")
    at, long = np.searchsorted(sizes[order], [1, LONG_PIECE + 1]).tolist()
    for i in order[long:].tolist():
        out[i] = _merge_long(vocabulary, pieces[i])
    order = order[:long]
    while at < len(order):
        least = int(sizes[order[at]])
        widest = max(least + 2, least * 5 // 4)
        end = min(int(np.searchsorted(sizes[order], widest, side="right")), at + max(1, MATRIX_CELLS // widest))
        rows = order[at:end]
        length = sizes[rows]
        matrix = np.zeros((len(rows), int(length.max())), np.int32)
        inside = np.arange(matrix.shape[1])[None, :] < length[:, None]
        matrix[inside] = vocabulary.byte_ids[np.frombuffer(b"".join([pieces[i] for i in rows.tolist()]), np.uint8)]
        merged, kept = _merge_matrix(vocabulary, matrix, length)
        for i, row, n in zip(rows.tolist(), merged, kept.tolist(), strict=True):
            out[i] = row[:n].copy()
        at = end
    return out


class Encoder:
    """Encodes lists of texts; keeps the ids of pieces seen before."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.vocabulary, self.find, self.known = vocabulary, regex.compile(PIECES).findall, {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text; none for an empty or null text."""
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        cut = [self.find(t) if t else [] for t in texts]
        local = dict.fromkeys(p for ps in cut for p in ps)
        new = [p for p in local if p not in self.known]
        made = dict(zip(new, merge_pieces(self.vocabulary, [p.encode("utf-8", "surrogatepass") for p in new]), strict=True))
        ids = [made[p] if p in made else self.known[p] for p in local]
        self.known.update((p, x) for p, x in made.items() if len(p) <= CACHE_BYTES)
        for i, p in enumerate(local):
            local[p] = i
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        codes = np.fromiter((local[p] for ps in cut for p in ps), np.int64)
        pieces = np.fromiter(map(len, cut), np.int64, len(cut))
        per = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(per)])
        edges = np.concatenate([[0], np.cumsum(pieces)])
        lengths = ends[edges[1:]] - ends[edges[:-1]]
        if not len(codes):
            return np.zeros(0, np.int32), lengths
        flat = np.concatenate(ids)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        return flat[np.repeat(starts[codes] - ends[:-1], per) + np.arange(ends[-1])], lengths


def _encode_batches(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= CHUNK_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                ids, lengths = encoder.encode(texts[at:end])
                key = keys.slice(at, end - at)
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                    yield pa.record_batch([key, pa.ListArray.from_arrays(offsets, pa.array(ids))], names=["key", "ids"])
                else:
                    yield pa.record_batch([key, pa.array(lengths)], names=["key", "n_tokens"])
                at = end

    return run


def encode_texts(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZER_PATH) -> DataFrame:
    """(key, ids): the token ids of every text by the byte-level BPE vocabulary at ``path``.

    No special tokens are added; their strings in a text are ordinary text. A null or empty text has an empty list, a text
    of white space its tokens. One row per row, repeated rows and null keys included; other columns are ignored. Texts of
    any length are encoded whole: pieces of up to LONG_PIECE bytes in matrices of bounded size, longer ones (runs of one kind
    of sign) each by itself in time n log n, with the same result. The vocabulary (fixed, some megabytes) is read by the driver and broadcast. Nothing is shuffled.
    """
    return _encoded(documents, key, text, path, True)


def count_tokens(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZER_PATH) -> DataFrame:
    """(key, n_tokens): as encode_texts, but the number of ids only."""
    return _encoded(documents, key, text, path, False)


def _encoded(documents: DataFrame, key: str, text: str, path: str, with_ids: bool) -> DataFrame:
    kind = documents.schema[key].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    out = rows.mapInArrow(_encode_batches(shared, with_ids), f"key {kind}, " + ("ids array<int>" if with_ids else "n_tokens bigint"))
    return out.withColumnRenamed("key", key)
