"""What several of the operators share."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words whose ids a task remembers; the memory is emptied when it is full.
REMEMBERED_WORDS = 500_000
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def row_key() -> list[Column]:
    """Two hashes of a document, row_a and row_b; together they tell documents apart at any size."""
    return [F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("row_b")]


def spare_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores added while a column is named so."""
    while wanted.lower() in {t.lower() for t in taken}:
        wanted += "_"
    return wanted


def id_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null ids count as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")), F.lit(buckets))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def read_whole(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


# Marks that end a word. After a letter or digit and before a space they are always tokens of their own; but the tokenizer
# lower-cases this one letter to two characters, and its dot joins the mark. What stands before is looked at after the
# first mark: a search for marks is faster than one for places behind letters.
_END_MARKS = re.compile(r"[.,!?;:%#$&*|](?<=[^\W_\u0130].)[.,!?;:%#$&*|]*(?=[ \n])")


def _pieces(text: str | None) -> bytes:
    """Pieces of a text that the tokenizer treats one by one, each with a space behind it; A-Z lower-cased, as it does itself."""
    if text is None:
        return b" "
    cut = _END_MARKS.sub(r" \g<0>", text).replace("\n", " ").encode("utf-8", "surrogatepass")
    # A special token may stand there, and those know their case.
    return (cut if "<|" in text else cut.lower()) + b" "


class WordIds:
    """Ids of texts, found word by word.

    Merges of this tokenizer never cross a space or a line feed, so the ids of a text are
    those of its pieces between them, and a piece seen before needs no second look.
    """

    def __init__(self, tokenizer_json: str):
        # Spark's tasks are the threads; a pool in each of them would only wait.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self._forget()

    def _codes(self, pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of some pieces after another, and how many each has. Many pieces go at once; where an id's characters stand
        tells whose it is."""
        for begin in range(0, len(pieces), 512):
            some = [p.decode("utf-8", "surrogatepass") for p in pieces[begin:begin + 512]]
            code = self.tokenizer.encode("".join(some)[:-1], add_special_tokens=False)
            places = np.fromiter(itertools.chain.from_iterable(code.offsets), np.int64, 2 * len(code))[::2]
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            yield np.array(code.ids, np.uint32), np.bincount(np.searchsorted(ends, places, side="right"), minlength=len(some))

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of all ``pieces``, which differ, are known afterwards."""
        new = [p for p in pieces if p not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self._forget()
            new = pieces
        codes, sizes = zip(*self._codes(new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.ids = np.concatenate([self.ids, *codes])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; null counts as empty."""
        for some in chunks(texts, _CHUNK_CHARS * 8):
            blobs = [_pieces(t) for t in some]
            raw = b"".join(blobs)
            stops = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x20) + 1
            bounds = np.concatenate([[0], stops])
            # Arrow tells equal pieces apart from others without a Python object for each of them.
            flat = pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).dictionary_encode()
            pieces = flat.dictionary.to_pylist()
            self._learn(pieces)
            at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))[flat.indices.to_numpy()]
            begins = self.starts[at]
            sizes = self.starts[at + 1] - begins
            ends = np.cumsum(sizes)
            found = self.ids[np.arange(ends[-1]) + np.repeat(begins - (ends - sizes), sizes)]
            last = np.searchsorted(stops, np.cumsum([len(b) for b in blobs]))
            yield from np.split(found, ends[last][:-1])


def chunks(texts: list[str | None], chars: int) -> Iterator[list[str | None]]:
    """Runs of texts with about so many characters together; a longer text is a run of its own."""
    begin = 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end] or "") <= chars):
            held += len(texts[end] or "")
            end += 1
        yield texts[begin:end]
        begin = end


def batches(frames: Iterator, columns: list[str]) -> Iterator[list[list]]:
    """Arrow batches as Python lists, one list for each of ``columns``."""
    for batch in frames:
        yield [batch.column(c).to_pylist() for c in columns]


# Characters of text whose words are hashed at once.
_CHUNK_CHARS = 1 << 16
_PLACES = 64


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are white space; a random number for each place in a word and byte, A-Z like a-z; a factor."""
    draw = np.random.default_rng(9_041)  # the same in every task
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    values = draw.integers(0, 1 << 64, (_PLACES, 256), dtype=np.uint64)
    values[:, ord("A"):ord("Z") + 1] = values[:, ord("a"):ord("z") + 1]
    return space, values.reshape(-1), draw.integers(0, 1 << 64, 1, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def sorted_distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words, as ``words_of`` finds them, in order."""
    space, values, factor = _hash_tables()
    for some in chunks(texts, _CHUNK_CHARS):
        blobs = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in some]
        raw = np.frombuffer(b"\n".join([*blobs, b""]), np.uint8)
        blank = space[raw]
        # The last byte is blank, so words begin and end in turn.
        edges = np.flatnonzero(np.diff(blank.view(np.int8), prepend=np.int8(1)))
        first, last = edges[0::2], edges[1::2]
        if len(first):
            sizes = last - first
            offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            place = (np.arange(sizes.sum()) - np.repeat(offsets, sizes)).astype(np.int32)
            value = values[(place & (_PLACES - 1)) << 8 | raw[~blank]]
            if sizes.max() > _PLACES:
                # The first factor is 1: a word's hash is the same beside longer ones.
                turns = np.cumprod(np.append(np.uint64(1), np.full(int(sizes.max()) // _PLACES, factor[0], np.uint64)))
                value = value * turns[place // _PLACES]
            hashed = mixed(np.add.reduceat(value, offsets) + sizes.astype(np.uint64))
        else:
            hashed = np.empty(0, np.uint64)
        stops = np.searchsorted(first, np.cumsum([len(b) + 1 for b in blobs]))
        yield from np.split(hashed, stops[:-1])
