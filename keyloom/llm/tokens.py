"""Token counts of whole texts by a public tokenizer, without the ids."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import type_of

#: Characters of a piece of a long text, and UTF-8 bytes that one call encodes.
PIECE_CHARS = 8_192
BATCH_BYTES = 512 * 1024

#: Where the word tokenizer's texts may be cut: after a blank, which belongs to no token; before a digit behind an ASCII
#: letter or digit, as digits stand alone; before an ideographic mark behind kana or an ideograph. No special string has such
#: a place inside, and no character there composes with its neighbour.
WORD_BOUNDARY = re.compile(r"(?<=[ \t\n\r])|(?<=[a-zA-Z0-9])(?=[0-9])|(?<=[ぁ-ゖァ-ヺ一-鿿])(?=[。、，！？])")


@cache
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of texts: by ``tokenizers`` for a .json file, by ``sentencepiece`` for a .model file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    # one core is one task's: the library's own threads would take those of others
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def pieces(text: str, boundary: re.Pattern | None, chars: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at the first boundary behind every ``chars`` characters; whole where there is none."""
    start = 0
    while boundary is not None and len(text) - start > chars:
        found = boundary.search(text, start + chars)
        if found is None or found.end() >= len(text):
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def token_counts(
    docs: DataFrame, tokenizer_path: str, boundary: re.Pattern | None = WORD_BOUNDARY, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Tokens are those of the whole text, without begin, end or added special tokens; special strings inside a text are
    handled as the library does by default. Texts longer than ``PIECE_CHARS`` are cut where ``boundary`` says that
    the tokens on both sides don't depend on one another; give None for a tokenizer without such places, such as one
    of sentencepiece, whose pieces run over blanks. Pieces are encoded in calls of about ``BATCH_BYTES`` bytes, however many texts
    that are, so memory follows the longest stretch without a boundary and not the number of rows. There is no shuffle.

    A null text is an empty one, of no tokens; repeated rows are counted each; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column(1), "")
            totals = np.zeros(batch.num_rows, dtype=np.int64)
            held: list[str] = []
            owners: list[int] = []
            size = 0

            def encode() -> None:
                np.add.at(totals, owners, count(held))
                held.clear()
                owners.clear()

            for row, text in enumerate(texts):
                for piece in pieces(text.as_py(), boundary):
                    held.append(piece)
                    owners.append(row)
                    # at least a byte a character; a few times that at most
                    size += len(piece)
                    if size >= BATCH_BYTES:
                        encode()
                        size = 0
            if held:
                encode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals), batch.column(2)], ["doc_id", "n_tokens", "n_bytes"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    found = narrow.mapInArrow(run, f"doc_id {type_of(docs, id_col)}, n_tokens bigint, n_bytes bigint")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
