"""SentencePiece encoding and decoding in numpy: the segmentation of a text with the largest sum of piece scores.

Pieces never cross the beginning of a word (a run of spaces and what follows), nor a line feed, so the distinct words of
a batch are segmented once each. Words of equal length advance together: at every end position, hashes of all substrings
of a length probe the sorted hashes of the pieces of that length, and maxima over lengths are kept with backpointers.
A word without equals in length (a line of Han, an encoded file) is probed at all its positions at once instead, and only
what matched is walked through.
Characters without a piece of their own fall back to the pieces of their bytes.

A vocabulary trained by merges carries merge ranks as scores; the best sum of scores then cuts some words otherwise than
replaying the merges does. Both are spellings of the same text in the same pieces.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.text_arrays import _POWERS, byte_sums, give_back, mixed, stretch_hashes

_SPACE = 0xFF  # stands for the space mark U+2581 inside this module; no UTF-8 text has this byte
_MARK = "▁"
_PENALTY = 10.0
#: Words of more bytes than this are segmented one by one: all matches of a stretch are probed at once, then walked through.
_LONG = 96
_STRETCH = 1 << 15
#: Bytes of words that are segmented together.
_TOGETHER = 1 << 20


def _hash(sums: np.ndarray, begin: np.ndarray | int, end: np.ndarray | int, down: np.ndarray) -> np.ndarray:
    return mixed((sums[..., end] - sums[..., begin]) * down[begin])


class Pieces:
    """The pieces of a model file, ready for probing."""

    def __init__(self, vocabulary: list[tuple[str, float]], bytes_at: list[int], dummy_prefix: bool = True) -> None:
        """`vocabulary` by id; ids that are no text have an empty piece. `bytes_at[b]` is the id of byte b."""
        self.dummy_prefix = dummy_prefix
        raw = [p.replace(_MARK, " ").encode().replace(b" ", b"\xff") for p, _ in vocabulary]
        if any(b"\xff" in p.lstrip(b"\xff") for p in raw):
            raise ValueError("pieces that go on after a space inside are not supported")
        self.byte_ids = np.array(bytes_at, np.int64)
        spelled = list(raw)
        for value, k in enumerate(bytes_at):
            spelled[k] = bytes([value])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate(([0], np.cumsum([len(p) for p in spelled])))
        self.line_feeds = any(b"\n" in p for p in raw)  # else line feeds can part words, too
        self.unknown = min((s for (p, s) in vocabulary if p), default=0.0) - _PENALTY
        self.by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        _, down = _POWERS.to(max(map(len, raw), default=0) + 1)
        for length in sorted({len(p) for p in raw if p}, reverse=True):
            ids = np.array([k for k, p in enumerate(raw) if len(p) == length])
            data = np.frombuffer(b"".join(raw[k] for k in ids), np.uint8).reshape(len(ids), length)
            keys = _hash(byte_sums(data), 0, length, down)
            order = np.argsort(keys)
            score = np.array([vocabulary[k][1] for k in ids])
            self.by_length.append((length, keys[order], ids[order], score[order]))

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = lambda k: model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k)
        vocabulary = [("" if special(k) else model.id_to_piece(k), model.get_score(k)) for k in range(n)]
        return Pieces(vocabulary, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def _segment(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length (a row each): piece ids in order, and how many each word has."""
        m, n = words.shape
        sums = byte_sums(words)
        _, down = _POWERS.to(n + 1)
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        piece = np.zeros((m, n + 1), np.int32)
        step = np.ones((m, n + 1), np.int32)
        piece[:, 1:] = self.byte_ids[words]
        follows = np.zeros((m, n + 1), bool)  # whether the byte from here on continues a character
        follows[:, :n] = (words & 0xC0) == 0x80
        begun = np.zeros(m, np.int64)  # where the character under way begins
        for end in range(1, n + 1):
            begun = np.where(follows[:, end - 1], begun, end - 1)
            here, back, size = np.full(m, -np.inf), piece[:, end].copy(), np.ones(m, np.int32)
            alone = np.zeros(m, bool)
            for length, keys, ids, score in self.by_length:
                if length > end:
                    continue
                h = _hash(sums, end - length, end, down)
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                known = np.flatnonzero(keys[at] == h)
                if len(known):
                    at = at[known]
                    value = best[known, end - length] + score[at]
                    better = value > here[known]  # ties: the longer piece, which came first
                    rows = known[better]
                    here[rows], back[rows], size[rows] = value[better], ids[at[better]], length
                    alone[known[begun[known] == end - length]] = True
            fallback = np.flatnonzero(~alone & ~follows[:, end])
            value = best[fallback, begun[fallback]] + self.unknown
            better = value > here[fallback]
            rows = fallback[better]
            here[rows], back[rows], size[rows] = value[better], piece[rows, end], 1
            best[:, end], piece[:, end], step[:, end] = here, back, size
        at, lane, found = np.full(m, n), np.arange(m), []
        while (at > 0).any():
            found.append(np.where(at > 0, piece[lane, at], -1))
            at = at - np.where(at > 0, step[lane, at], 0)
        table = np.array(found[::-1]).T
        used = table >= 0
        return table[used], used.sum(axis=1)

    def _segment_long(self, word: np.ndarray) -> np.ndarray:
        """Piece ids of one long word, in order: the same choice as `_segment`, a stretch of ends at a time."""
        n = len(word)
        piece, step = self.byte_ids[word].astype(np.int32), np.ones(n, np.uint16)
        longest = self.by_length[0][0] if self.by_length else 1
        keep = max(longest, 4)
        follows = (word & 0xC0) == 0x80
        best, origin = [0.0], 0  # best[k] is the largest sum up to the byte origin + k
        begun = 0
        for low in range(0, n, _STRETCH):
            high = min(n, low + _STRETCH)
            ends, ids, scores = self._matches(word, low, high)
            lengths = ids[1]
            turn = np.searchsorted(ends, np.arange(low + 1, high + 2)).tolist()
            whole = (~np.append(follows[low + 1 : high], follows[high] if high < n else False)).tolist()
            starts_here = (~follows[low:high]).tolist()
            lengths, named, scores = lengths.tolist(), ids[0].tolist(), scores.tolist()
            here_piece, here_step, changed = [], [], []
            for k in range(high - low):
                end = low + k + 1
                if starts_here[k]:
                    begun = end - 1
                here, chosen, size, alone = -np.inf, -1, 1, False
                for m in range(turn[k], turn[k + 1]):
                    length = lengths[m]
                    value = best[end - length - origin] + scores[m]
                    if value > here:
                        here, chosen, size = value, named[m], length
                    alone = alone or end - length == begun
                if not alone and whole[k]:
                    value = best[begun - origin] + self.unknown
                    if value > here:
                        here, chosen = value, -1
                best.append(here)
                if chosen >= 0:
                    changed.append(end - 1)
                    here_piece.append(chosen)
                    here_step.append(size)
            piece[changed], step[changed] = here_piece, here_step
            if len(best) > keep + 1:
                origin += len(best) - keep - 1
                best = best[-keep - 1 :]
        found, at, piece_of, step_of = [], n, memoryview(piece), memoryview(step)
        while at > 0:
            found.append(piece_of[at - 1])
            at -= step_of[at - 1]
        return np.array(found[::-1], np.int64)

    def _matches(self, word: np.ndarray, low: int, high: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ends (low < end <= high), ids and lengths, and scores of all pieces in the word; by end, longer pieces first."""
        longest = self.by_length[0][0] if self.by_length else 1
        begin = max(0, low - longest + 1)
        sums = byte_sums(word[begin:high])
        _, down = _POWERS.to(len(sums))
        all_ends, all_ids, all_lengths, all_scores = ([] for _ in range(4))
        for length, keys, ids, score in self.by_length:
            ends = np.arange(max(low + 1, length), high + 1)
            if not len(ends):
                continue
            h = _hash(sums, ends - length - begin, ends - begin, down)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            known = np.flatnonzero(keys[at] == h)
            all_ends.append(ends[known])
            all_ids.append(ids[at[known]])
            all_lengths.append(np.full(len(known), length))
            all_scores.append(score[at[known]])
        if not all_ends:
            none = np.zeros(0, np.int64)
            return none, (none, none), none
        ends = np.concatenate(all_ends)
        order = np.argsort(ends, kind="stable")
        pick = lambda parts: np.concatenate(parts)[order]
        return ends[order], (pick(all_ids), pick(all_lengths)), pick(all_scores)

    def _plain(self, text: str | None) -> bytes:
        raw = (text or "").replace(_MARK, " ").encode()
        return (b" " + raw if raw and self.dummy_prefix else raw).replace(b" ", b"\xff")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin (with the end of the last)."""
        raw = [self._plain(t) for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        text_at = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        is_space = data == _SPACE
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = is_space[1:] & ~is_space[:-1]
        if not self.line_feeds:
            feeds = np.flatnonzero(data == 10)
            cut[feeds] = cut[feeds + 1] = True
        cut[text_at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        # Word hashes, told apart by length as well.
        key = stretch_hashes(data, starts, ends) ^ (ends - starts).astype(np.uint64)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        begin, size = starts[first], ends[first] - starts[first]
        counts = np.zeros(len(first), np.int64)
        parts, owners = [], []
        for n in np.unique(size).tolist():
            rows = np.flatnonzero(size == n)
            if n > _LONG:
                for row in rows:
                    ids = self._segment_long(data[begin[row] : begin[row] + n])
                    counts[row] = len(ids)
                    parts.append(ids)
                    owners.append(np.array([row]))
                continue
            for k in range(0, len(rows), _TOGETHER // n):  # bounded memory
                some = rows[k : k + _TOGETHER // n]
                ids, each = self._segment(data[begin[some][:, None] + np.arange(n)])
                counts[some] = each
                parts.append(ids)
                owners.append(some)
        lengths = np.concatenate([counts[o] for o in owners])
        place = np.empty(len(first), np.int64)
        place[np.concatenate(owners)] = np.cumsum(lengths) - lengths
        ids = _gathered(np.concatenate(parts), place[which], counts[which])
        total = np.concatenate(([0], np.cumsum(counts[which])))
        return ids, total[np.searchsorted(starts, text_at)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that the ids spell."""
        sizes = self.spelled_at[ids + 1] - self.spelled_at[ids]
        raw = _gathered(self.spelled, self.spelled_at[ids], sizes).tobytes().replace(b"\xff", b" ")
        return raw[1:] if raw and self.dummy_prefix else raw


def _gathered(source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """source[begin[i]:begin[i] + size[i]] for all i, one after the other."""
    ends = np.cumsum(size)
    if not len(ends):
        return source[:0]
    return source[np.repeat(begin - ends + size, size) + np.arange(ends[-1])]


_LOADED: dict[str, Pieces] = {}  # one for each file, kept while the worker lives


def _loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces.load(path)
    return _LOADED[path]


def _lists(texts: Iterable[str | None], size: int = 1 << 21) -> Iterator[list[str | None]]:
    group: list[str | None] = []
    total = 0
    for text in texts:
        group.append(text)
        total += len(text or "")
        if total >= size:
            yield group
            group, total = [], 0
            give_back()
    if group:
        yield group
    give_back()


def encoded(text: Column, path: str) -> Column:
    """Piece ids as array<int>; null and empty texts have none."""

    def of(texts: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        for group in _lists(texts):
            ids, at = _loaded(path).encode(group)
            out.extend(np.split(ids.astype(np.int32), at[1:-1]))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(of, "array<int>")(text.cast("string"))


def decoded(ids: Column, path: str) -> Column:
    """The text that an array of ids spells; a null array is the empty text."""

    def of(arrays: pd.Series) -> pd.Series:
        pieces = _loaded(path)
        return pd.Series([
            "" if a is None else pieces.decode(np.asarray(a, np.int64)).decode("utf-8", "replace") for a in arrays
        ], dtype=object)

    return F.pandas_udf(of, "string")(ids)


def piece_digest(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes every text of `docs` (doc_id, text): doc_id, n_pieces, ids_crc32, decoded_sha256.

    ids_crc32 is over the ids as little-endian unsigned 32-bit integers; decoded_sha256 is the lower-case hex digest of
    the decoded UTF-8, which is the text itself, with U+2581 as a space. Null and empty texts have no pieces. Repeated
    rows are coded row by row; other columns are not read; an empty table gives no rows.
    """

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = _loaded(path)
        for texts in batches:
            rows = []
            for group in _lists(texts):
                ids, at = pieces.encode(group)
                for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = ids[a:z]
                    digest = hashlib.sha256(pieces.decode(own)).hexdigest()
                    rows.append((z - a, zlib.crc32(own.astype("<u4").tobytes()), digest))
            yield pd.DataFrame(rows, columns=["n_pieces", "ids_crc32", "decoded_sha256"])

    coded = F.pandas_udf(of, "n_pieces long, ids_crc32 long, decoded_sha256 string")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), coded(F.col("text").cast("string")).alias("coded"))
    return found.select("doc_id", "coded.*")
