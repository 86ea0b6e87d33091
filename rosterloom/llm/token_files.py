"""Token ids as binary files: Simple-8b words in blocks, with escapes and block offsets.

Layout. A chunk holds the ids of whole consecutive documents. Its ids are cut into blocks of `BLOCK`; every block is
packed on its own into 64-bit little-endian words. The top four bits of a word select how many ids it holds and how wide
they are; the first id has the lowest bits. In words of four ids, the all-ones slot is an escape: the id stands in the
chunk's escape list, which is in the order of the ids. `word_offsets` and `escape_offsets` say where each block begins in
either list, so blocks can be decoded singly or all at once without a loop over words.

Chunks are rows of a Parquet table: Spark's commit protocol makes a lost executor harmless, and any store that Spark can
write holds the files.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterloom.llm.storage import shared_path

BLOCK = 1024
#: Ids per word by selector; each has 60 // count bits. The last one has escapes.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4)
ESCAPING = len(COUNTS) - 1
ESCAPE = (1 << 15) - 1
_ROW = BLOCK + COUNTS[0]  # a block, and room for what its last word has beyond its end
_COUNT_OF = np.array(COUNTS, np.int64)

CHUNK_SCHEMA = (
    "shard int, start long, n_ids long, doc_ids array<long>, n_tokens array<long>, "
    "words binary, word_offsets binary, escapes binary, escape_offsets binary"
)
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, word offsets, escapes and escape offsets of unsigned 32-bit ids."""
    ids = np.asarray(ids, np.uint32)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), ids, np.zeros(1, np.int64)
    blocks = -(-len(ids) // BLOCK)
    rows = np.zeros((blocks, _ROW), np.uint32)
    whole = len(ids) // BLOCK
    rows[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    if whole < blocks:
        rows[whole, : len(ids) - whole * BLOCK] = ids[whole * BLOCK :]
    selectors = _widest(rows)
    count = _COUNT_OF[selectors[:, :BLOCK]]
    # All blocks advance together, a word at a time.
    cursors, starts, lane = np.zeros(blocks, np.int64), [], np.arange(blocks)
    length = np.full(blocks, BLOCK)
    if whole < blocks:
        length[whole] = len(ids) - whole * BLOCK
    while (live := cursors < length).any():
        starts.append(np.where(live, cursors, -1))
        cursors = cursors + np.where(live, count[lane, np.minimum(cursors, BLOCK - 1)], 0)
    begin = np.array(starts, np.int64).reshape(-1, blocks).T
    used = begin >= 0
    row, at = np.nonzero(used)[0], begin[used]
    chosen = selectors[row, at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat = rows.reshape(-1)
    for selector, n in enumerate(COUNTS):
        if len(mine := np.flatnonzero(chosen == selector)):
            first, width, packed = row[mine] * _ROW + at[mine], 60 // n, words[mine]
            for k in range(n):
                value = flat[first + k].astype(np.uint64)
                if selector == ESCAPING:
                    value = np.minimum(value, ESCAPE)
                packed |= value << np.uint64(width * k)
            words[mine] = packed
    escaped = ids >= ESCAPE
    per_block = np.add.reduceat(escaped, np.arange(0, len(ids), BLOCK), dtype=np.int64)
    offsets = lambda n: np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    return words, offsets(used.sum(axis=1)), ids[escaped], offsets(per_block)


def _widest(rows: np.ndarray) -> np.ndarray:
    """For every place, the selector that holds the most of the ids from there on."""
    capped = np.minimum(rows, 65535).astype(np.uint16)
    best = np.full(rows.shape, ESCAPING, np.int8)
    most, span = {1: capped}, 1
    while span * 2 <= COUNTS[0]:  # the largest of the next 1, 2, 4, ... ids
        wider = most[span].copy()
        np.maximum(wider[:, :-span], most[span][:, span:], out=wider[:, :-span])
        span *= 2
        most[span] = wider
    for selector in range(ESCAPING - 1, -1, -1):
        n = COUNTS[selector]
        half, limit = 1 << (n.bit_length() - 1), 1 << (60 // n)
        likely = np.flatnonzero((most[half] < limit).any(axis=1))  # wide words are for few blocks
        whole = len(likely) == len(rows)
        near = most[half] if whole else most[half][likely]
        top = near.copy()
        if n > half:
            np.maximum(top[:, : half - n], near[:, n - half :], out=top[:, : half - n])
        if whole:
            best[top < limit] = selector
        elif len(likely):
            best[likely] = np.where(top < limit, np.int8(selector), best[likely])
    return best


def unpack(words: np.ndarray, word_offsets: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of all blocks of a chunk."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT_OF[selectors]
    ends = np.cumsum(counts)
    per_block = np.diff(word_offsets)
    before = np.concatenate(([0], ends))[word_offsets[:-1]]
    place = np.repeat(np.arange(len(per_block)) * _ROW - before, per_block) + ends - counts
    out = np.zeros(len(per_block) * _ROW, np.uint32)
    for selector, n in enumerate(COUNTS):
        if len(mine := np.flatnonzero(selectors == selector)):
            value, at, width = words[mine], place[mine], 60 // n
            mask = np.uint64((1 << width) - 1)
            for k in range(n):
                out[at + k] = ((value >> np.uint64(width * k)) & mask).astype(np.uint32)
    ids = out.reshape(-1, _ROW)[:, :BLOCK].reshape(-1)[:n_ids].copy()
    ids[ids == ESCAPE] = escapes
    return ids


# White space as the tokenizer's pattern sees it (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters of every Unicode version, and marks that start a token of their own; other non-ASCII marks are left alone.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARK = r"!-&(-/:-@\[-`{-~"
_WORD = (
    f" ?[{_LETTER}]++(?![\x80-\U0010ffff])| ?[{_MARK}]++(?![\x00-\x08\x0e-\x1f'\x7f-\U0010ffff])"
)
#: Cuts only where the byte-level pattern always cuts: around white space, and between plain letters and plain marks.
_PIECE = re.compile(f"{_WORD}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: A piece that is one word of the byte-level pattern; other pieces may hold several.
_ONE_WORD = re.compile(_WORD)


_PACKED = [struct.Struct(f"<{n}I") for n in range(32)]


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class TextEncoder(dict):
    """Ids of texts by the tokenizers library; each distinct piece of the texts is encoded once and remembered.

    `limit` bounds the memory of remembered pieces, not what is encoded.
    """

    def __init__(self, tokenizer_path: str, limit: int = 1_200_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that look at what stands around them are not supported")
        self.added = {t.content: np.array([k], "<u4").tobytes() for k, t in added.items()}
        # The longest first, as the library matches them.
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if added else None
        self.limit = limit
        self.letters = _byte_letters()
        self.space = self.letters[ord(" ")]

    def __missing__(self, piece: str) -> bytes:
        body = piece[1:] if piece[0] == " " else piece
        if body.isascii() and body.isalpha():  # one word, in which only the space has another letter
            ids = [token.id for token in self.model.tokenize(piece if body is piece else self.space + body)]
        elif _ONE_WORD.fullmatch(piece):
            ids = [token.id for token in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        coded = _PACKED[len(ids)].pack(*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < self.limit and len(piece) < 64:
            self[piece] = coded
        return coded

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; strings of added tokens in the text are those tokens."""
        if not text:
            return b""
        if not any(map(text.__contains__, self.added)):
            return self._plain(text)
        return b"".join(self.added[part] if k % 2 else self._plain(part) for k, part in enumerate(self.cut.split(text)))

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        return b"".join(map(self.__getitem__, _PIECE.findall(text)))


_ENCODERS: dict[str, TextEncoder] = {}  # one for each file, kept while the worker lives


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, chunk_ids: int = 1 << 19) -> None:
    """Writes the ids of `docs` (doc_id, text) in ascending doc_id order as chunks under `path`.

    Null text is the empty text: `end_id` alone. Rows with the same doc_id stand next to each other, ordered by a hash
    of their text; null ids come first. Only doc_id and text of `docs` are read. An empty table writes no chunk.
    """

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _ENCODERS.setdefault(tokenizer_path, TextEncoder(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        shard, start = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        parts: list[bytes] = []

        def chunk() -> pd.DataFrame:
            nonlocal start, doc_ids, parts
            ids = np.frombuffer(b"".join(parts), "<u4")
            words, word_offsets, escapes, escape_offsets = pack(ids)
            row = {
                "shard": shard, "start": start, "n_ids": len(ids), "doc_ids": doc_ids,
                "n_tokens": [len(p) // 4 for p in parts], "words": words.astype("<u8").tobytes(),
                "word_offsets": word_offsets.astype("<i8").tobytes(), "escapes": escapes.astype("<u4").tobytes(),
                "escape_offsets": escape_offsets.astype("<i8").tobytes(),
            }
            start, doc_ids, parts = start + len(ids), [], []
            return pd.DataFrame([row])

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                parts.append(encoder.ids(text) + end)
                size += len(parts[-1]) // 4
                if size >= chunk_ids:
                    yield chunk()
                    size = 0
        if parts:
            yield chunk()

    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInPandas(chunks, CHUNK_SCHEMA)
        .write.parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files under `path`: doc_id, start, n_tokens and ids_crc32, from the decoded ids."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    # One row for each partition that was written: a bounded table.
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = totals.select(
        "shard",
        F.coalesce(
            F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("shard_start"),
    )

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = unpack(
                    np.frombuffer(row.words, "<u8"), np.frombuffer(row.word_offsets, "<i8"),
                    np.frombuffer(row.escapes, "<u4"), row.n_ids,
                ).astype("<u4")
                sizes = np.asarray(row.n_tokens, np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(ids.tobytes())
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(row.doc_ids, "Int64"),
                        "start": row.start + ends - sizes,
                        "n_tokens": sizes,
                        "ids_crc32": [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, sizes, strict=True)],
                    }
                )

    return (
        chunks.join(F.broadcast(before), "shard")
        .withColumn("start", F.col("start") + F.col("shard_start"))
        .drop("shard", "shard_start", "escape_offsets")
        .mapInPandas(documents, DOCUMENT_SCHEMA)
    )


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Encodes, writes and reads back; see `write_token_files` for nulls, ties and empty tables."""
    path = shared_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer_path, path, end_id)
    return read_token_files(docs.sparkSession, path)
