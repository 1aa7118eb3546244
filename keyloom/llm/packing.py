"""Cost-balanced packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import tidy, type_of

#: Tokens that one shard packs together; an id takes 4 bytes.
SHARD_TOKENS = 2_000_000
SEQUENCE_BITS = 36


#: Fixed value: the special string of the vocabulary, whose id is the one behind the ranks. In a text it is that one token.
END_OF_TEXT = "<|endoftext|>"
#: The pattern engine of ``tiktoken`` recurses over white space and breaks off in runs of hundreds of thousands.
LONG_SPACE = re.compile(r"\s{1000}")


def _whole(path: str):
    """Ids by the ``tokenizers`` library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@cache
def encoder(path: str):
    """A function from texts to id arrays: a ``tokenizers`` file, or the same vocabulary's ``tiktoken`` ranks, which are faster.

    Ids are those that ``tokenizers`` gives without added special tokens, ``END_OF_TEXT`` in a text as its own id. With ranks, a text with a long run of white space, or one that ``tiktoken`` breaks off at, goes to the ``tokenizers``
    file of the same name beside them.
    """
    if not str(path).endswith(".tiktoken"):
        return _whole(path)
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {END_OF_TEXT: len(ranks)}
    ids_of = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special).encode
    other = cache(lambda: _whole(str(path).removesuffix(".tiktoken") + ".json"))

    def encode(text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            return other()(text)
        try:
            return np.array(ids_of(text, allowed_special="all"), dtype="<u4")
        except BaseException as e:
            # a panic of the native code is no Exception
            if type(e).__name__ != "PanicException":
                raise
            return other()(text)

    return encode


def pack_lengths(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with these numbers of tokens.

    The estimated cost of a piece is ``linear * n + quadratic * n * n``. Whole runs of ``capacity`` tokens are
    sequences of their own. The remainders go, in descending order, each to the sequence of lowest cost with room for
    all of it; one that fits nowhere is cut, and its parts go to the sequences of lowest cost with any room. There are as
    many sequences as their tokens need, so less than one sequence of padding is left.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for doc in np.flatnonzero(lengths >= capacity):
        for start in range(0, int(lengths[doc]) - capacity + 1, capacity):
            pieces.append((int(doc), start, capacity, sequence, 0))
            sequence += 1
    rest = lengths % capacity
    n = -(-int(rest.sum()) // capacity)
    cost, used = np.zeros(n), np.zeros(n, dtype=np.int64)

    def put(doc: int, length: int, at: int) -> None:
        end = int(lengths[doc])
        start = end - left
        pieces.append((doc, start, length, sequence + at, int(used[at])))
        used[at] += length
        cost[at] += linear * length + quadratic * length * length

    for doc in np.argsort(-rest, kind="stable"):
        left = int(rest[doc])
        if not left:
            break
        open_ = np.where(used + left <= capacity, cost, np.inf)
        at = int(open_.argmin())
        if open_[at] < np.inf:
            put(int(doc), left, at)
            continue
        while left:
            at = int(np.where(used < capacity, cost, np.inf).argmin())
            length = min(left, capacity - int(used[at]))
            put(int(doc), length, at)
            left -= length
    return pieces


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 0,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ids are little-endian unsigned 32-bit.

    Each task tokenizes its documents, closes a shard at SHARD_TOKENS and packs it with ``pack_lengths``; no row is
    shuffled, and a shard leaves less than one sequence of padding, which a partition of few documents leaves too. ``sequence_id`` holds the partition above
    ``SEQUENCE_BITS`` bits, so a task that runs again names its sequences alike.

    A null text is an empty one, of ``end_id`` alone; a very long text may fill many sequences; repeated rows are
    packed each; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        done = 0
        held: list[np.ndarray] = []
        keys: list[pa.Scalar] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            nonlocal held, keys, tokens, done
            lengths = np.array([len(x) for x in held], dtype=np.int64)
            pieces = pack_lengths(lengths, capacity, linear, quadratic)
            doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, kind).take(pa.array(doc)), pa.array(start), pa.array(length),
                    pa.array([held[d][s : s + n].tobytes() for d, s, n in zip(doc, start, length)], pa.binary()),
                    pa.array(lengths[doc]), pa.array(base + done + sequence), pa.array(offset),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            done += int(sequence.max()) + 1
            held, keys, tokens = [], [], 0
            return out

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.array([end_id], dtype="<u4"))
                held.append(ids)
                keys.append(key)
                tokens += len(ids)
                if tokens >= SHARD_TOKENS:
                    yield close()
        if held:
            yield close()

    schema = f"doc_id {type_of(docs, id_col)}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def with_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with ``ids_crc32`` in place of ``ids``."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
