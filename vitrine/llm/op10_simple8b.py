"""Token ids in files of Simple-8b words, with escapes and block offsets.

A 64-bit word holds a selector in its top four bits and as many ids as the selector says, of equal
width, in the other sixty.  An id of more than sixty bits is an escape: a word with
selector 0, then the id as a word of its own.  Words are cut into blocks of at most
``BLOCK_IDS`` ids.  A block lists its escapes, so the selectors of all words are known at once and a
reader unpacks all words of one selector together, with no walk from word to word; and it lists the offsets of its
ids by marks, the number of ids before every ``MARK``-th word, so a range of ids is decoded from the words it lies in alone.

A file is a list of blocks, each closed by a line feed that the writer sets (see ``frames``).  A
block lists the documents it holds ids of: a document's ids may run over several blocks.
Documents are in ascending order of id within and across files (nulls first), dealt by
range; rows of equal id are ordered by a hash of their text.  The strings of special tokens in a text are encoded as ordinary text.

Defined cases: a null text is an empty one, so its only id is the end id; a null id is kept;
equal rows are encoded once each; an empty table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.llm.frames import read_files, write_chunks
from vitrine.llm.subwords import json_encoder
from vitrine.session import cut_lineage, scratch_path

#: Ids to a word, and bits to an id, for selectors 1 to 14; 0 is the escape.
COUNTS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
MAGIC, HEADER = b"S8B1", struct.Struct("<4sIIIII")
DOCUMENT = struct.Struct("<qBQII")
BLOCK_IDS, MARK = 1 << 16, 256
#: Texts that are cut into pieces together.
GROUP_BYTES = 2 << 20
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"


def fitting(width: np.ndarray) -> np.ndarray:
    """For each id, given the ids' bit widths, the selector of the most ids that fit from it on (0: an escape).

    The last word of a block may be part empty.
    """
    n, widest = len(width), int(width.max())
    fits = np.zeros(n, dtype=np.uint8)
    for selector in range(14, 0, -1):
        count, bits = COUNTS[selector], WIDTHS[selector]
        if widest <= bits:
            fits[:] = selector
            continue
        narrow = width <= bits
        at = np.flatnonzero(narrow)
        wide_last = n - 1 - int(np.argmin(narrow[::-1]))
        if len(at) < n // 4:  # few: look at them alone
            runs = at[: max(len(at) - count + 1, 0)]
            fits[runs[at[count - 1 :] - runs == count - 1]] = selector
        else:
            over = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(~narrow, out=over[1:])
            if n >= count:
                fits[: n - count + 1][over[count:] == over[: n - count + 1]] = selector
        fits[max(wide_last + 1, n - count + 1) :] = selector
    return fits


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if not len(ids) or int(ids.max()) < 1 << 52:
        return np.frexp(ids.astype(np.float64))[1]
    high = ids >> np.uint64(32)
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words for ``ids``, and where escapes stand: each word takes as many of the next ids as any selector allows."""
    ids = ids.astype(np.uint64)
    fits = fitting(widths(ids)) if len(ids) else np.zeros(0, dtype=np.uint8)
    starts, at, steps, n = [], 0, np.maximum(np.array(COUNTS), 1)[fits].tolist(), len(ids)
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = fits[starts]
    escape = chosen == 0
    place = np.arange(len(starts)) + np.cumsum(escape) - escape
    words = np.zeros(len(starts) + int(escape.sum()), dtype=np.uint64)
    padded = np.concatenate((ids, np.zeros(60, dtype=np.uint64)))
    for selector in np.unique(chosen).tolist():
        mine = starts[chosen == selector]
        if not selector:
            words[place[escape] + 1] = ids[mine]
            continue
        word = np.full(len(mine), selector << 60, dtype=np.uint64)
        for i in range(COUNTS[selector]):
            word |= padded[mine + i] << np.uint64(i * WIDTHS[selector])
        words[place[chosen == selector]] = word
    return words, place[escape]


def held(words: np.ndarray, escapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector of every word (15: a raw word behind an escape), and ids it holds."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    selectors[escapes + 1] = 15
    return selectors, np.array([1, *COUNTS[1:], 0])[selectors]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    selectors, counts = held(words, escapes)
    first = np.cumsum(counts) - counts
    ids = np.zeros(n + 60, dtype=np.uint64)
    # A part-empty word can only be the last, and what it lacks falls behind the end.
    for selector in np.unique(selectors).tolist():
        at = np.flatnonzero(selectors == selector)
        if selector == 0:
            ids[first[at]] = words[at + 1]
        elif selector < 15:
            mask = np.uint64((1 << WIDTHS[selector]) - 1)
            for i in range(COUNTS[selector]):
                ids[first[at] + i] = (words[at] >> np.uint64(i * WIDTHS[selector])) & mask
    return ids[:n]


def block(documents: list[tuple[int | None, int, int, int]], ids: np.ndarray) -> bytes:
    """A block: documents (id, number of its first id, ids here, ids in all), escapes, marks, words."""
    words, escapes = pack(ids)
    counts = held(words, escapes)[1]
    marks = (np.cumsum(counts) - counts)[::MARK]
    head = HEADER.pack(MAGIC, len(documents), len(ids), len(words), len(escapes), len(marks))
    listed = b"".join(DOCUMENT.pack(i or 0, i is None, first, here, total) for i, first, here, total in documents)
    return b"".join((head, listed, escapes.astype("<u4").tobytes(), marks.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def blocks(documents: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[bytes]:
    """The blocks of a file, from (id, ids) of its documents in order."""
    listed: list[tuple] = []
    parts: list[np.ndarray] = []
    room = BLOCK_IDS
    for doc, ids in documents:
        at = 0
        while at < len(ids):
            part = ids[at : at + room]
            listed.append((doc, at, len(part), len(ids)))
            parts.append(part)
            at += len(part)
            room -= len(part)
            if not room:
                yield block(listed, np.concatenate(parts))
                listed, parts, room = [], [], BLOCK_IDS
    if listed:
        yield block(listed, np.concatenate(parts))


class Block:
    """A block of a file, at byte ``at`` of its ``content``; its ids are decoded when they are asked for."""

    def __init__(self, content: bytes, at: int):
        magic, documents, self.n, n_words, n_escapes, n_marks = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at {at}")
        at += HEADER.size
        self.documents = [DOCUMENT.unpack_from(content, at + k * DOCUMENT.size) for k in range(documents)]
        at += documents * DOCUMENT.size
        self.escapes = np.frombuffer(content, dtype="<u4", count=n_escapes, offset=at).astype(np.int64)
        at += 4 * n_escapes
        self.marks = np.frombuffer(content, dtype="<u4", count=n_marks, offset=at).astype(np.int64)
        at += 4 * n_marks
        self.words = np.frombuffer(content, dtype="<u8", count=n_words, offset=at)
        self.end = at + 8 * n_words + 1  # and the line feed

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.escapes, self.n)

    def range(self, first: int, count: int) -> np.ndarray:
        """The ``count`` ids from number ``first`` of the block on, from the words between the marks around them."""
        stop = min(first + count, self.n)
        if first >= stop:
            return np.zeros(0, dtype=np.uint64)
        mark = int(np.searchsorted(self.marks, first, "right")) - 1
        after = int(np.searchsorted(self.marks, stop, "left"))
        start, end = mark * MARK, min(after * MARK, len(self.words))
        before = int(self.marks[mark])
        # A mark may fall between an escape and its id, which belong together; the id is counted at the escape.
        if start and (self.escapes == start - 1).any():
            start += 1
        if (self.escapes == end - 1).any():
            end += 1
        escapes = self.escapes[(self.escapes >= start) & (self.escapes < end)] - start
        found = unpack(self.words[start:end], escapes, (int(self.marks[after]) if after < len(self.marks) else self.n) - before)
        return found[first - before : stop - before]


def file_blocks(content: bytes) -> Iterator[Block]:
    at = 0
    while at < len(content):
        block = Block(content, at)
        yield block
        at = block.end


def read_range(content: bytes, first: int, count: int) -> np.ndarray:
    """The ``count`` ids from number ``first`` of a file on; blocks outside are passed over, those at its ends read in part."""
    parts, before = [np.zeros(0, dtype=np.uint64)], 0
    for block in file_blocks(content):
        if before >= first + count:
            break
        if before + block.n > first:
            start = max(first - before, 0)
            parts.append(block.range(start, first + count - before - start))
        before += block.n
    return np.concatenate(parts)


def read_blocks(content: bytes) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """(id, number of the first id, ids in all, ids) of the documents' parts, in the order of a file."""
    for block in file_blocks(content):
        ids, stop = block.ids(), 0
        for doc, null, first, here, total in block.documents:
            yield None if null else doc, first, total, ids[stop : stop + here]
            stop += here


def write_ids(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end: int = END_ID, file_bytes: int = 32 << 20) -> None:
    """Encode every text and write the files, of about ``file_bytes`` of text each.  Ids must be whole numbers."""
    size = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    files = max(-(-size // file_bytes), df.sparkSession.sparkContext.defaultParallelism)

    def encoded(batches):
        coder = json_encoder(tokenizer)

        def documents():
            held, size = [], 0
            for b in batches:
                held.append(b)
                size += b.nbytes
                if size >= GROUP_BYTES:
                    yield from read(held)
                    held, size = [], 0
            if held:
                yield from read(held)

        def read(held):
            rows = pa.Table.from_batches(held).combine_chunks()
            numbers, texts = (pa.concat_arrays(rows.column(c).chunks) for c in ("n", "t"))
            yield from zip(numbers.to_pylist(), coder.strings(texts, end))

        for chunk in blocks(documents()):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.binary())})

    tie = F.xxhash64(F.coalesce(F.col("t"), F.lit("")))
    dealt = df.select(F.col(id_col).cast("bigint").alias("n"), F.col(text_col).alias("t")).repartitionByRange(files, F.col("n").asc_nulls_first(), tie)
    ordered = dealt.sortWithinPartitions(F.col("n").asc_nulls_first(), tie)
    write_chunks(ordered.mapInArrow(encoded, "chunk binary"), path)


def read_ids(spark: SparkSession, path: str, summary: bool = False) -> DataFrame:
    """Documents of the files under ``path``: file, place in the file, id, number of ids, and their ids (or, as a ``summary``, their crc32)."""
    last = "ids_crc32 long" if summary else "ids array<long>"

    def rows(batches):
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                found, have, nth, crc = [], [], 0, 0
                for doc, first, total, ids in read_blocks(content):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc if first else 0)
                    if not summary:
                        have.append(ids)
                    if first + len(ids) == total:
                        found.append((name, nth, None if doc is None else str(doc), total, crc if summary else np.concatenate(have).astype(np.int64)))
                        have, nth = [], nth + 1
                    if len(found) >= 1000:
                        yield pd.DataFrame(found, columns=["file", "nth", "doc", "n_tokens", last.split()[0]])
                        found = []
                yield pd.DataFrame(found, columns=["file", "nth", "doc", "n_tokens", last.split()[0]])

    return read_files(spark, path).mapInPandas(rows, f"file string, nth long, doc string, n_tokens long, {last}")


def starts(read: DataFrame) -> DataFrame:
    """``read`` with ``start``, the number of ids before each document in all files.

    Files are named in their order.  Sums by file (a row each) give every file its
    first number; running sums stay within a file.
    """
    read = cut_lineage(read, "read")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    running = read.withColumn("ran", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return running.join(files, "file").withColumn("start", F.col("base") + F.col("ran")).drop("base", "ran")


def encode(df: DataFrame, **options) -> DataFrame:
    """Write ``df``'s ids as files, read them back: doc_id, start, n_tokens, ids_crc32, file."""
    path = scratch_path(df.sparkSession, "simple8b")
    id_col = options.get("id_col", "doc_id")
    write_ids(df, path, **options)
    out = starts(read_ids(df.sparkSession, path, summary=True))
    return out.select(F.col("doc").cast(dict(df.dtypes)[id_col]).alias(id_col), "start", "n_tokens", "ids_crc32", F.element_at(F.split("file", "/"), -1).alias("file"))


def op10_simple8b(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


QUERIES = {"op10_simple8b": op10_simple8b}
ORACLES: dict[str, str] = {}
