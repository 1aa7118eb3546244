"""Line dedup: winnowing over line hashes, joined positions, runs extended both ways."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from keyloom.llm.common import cut, free_names, tidy, type_of

#: A line, cut further at sentence ends, with the white space after it. The matches of a text join up to the text.
LINE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+$")


def split_lines(text: str) -> list[str]:
    return LINE.findall(text)


def windows(sizes: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``start, end`` of all windows in lines of ``sizes`` words, side by side; those of text ``i`` begin at ``offsets[i]``.

    A window is a shortest run of lines with at least ``min_words`` words, from a start on or back from an end. Every line
    of a run of that many words lies in a window within the run: up to the last start with enough words after it, those
    from starts on cover the run, and those back from ends cover the lines after that.
    """
    upto = np.concatenate(([0], np.cumsum(sizes)))
    low, high = (np.repeat(x, np.diff(offsets)) for x in (offsets[:-1], offsets[1:]))
    ends = np.searchsorted(upto, upto[:-1] + min_words)
    starts = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    ahead = np.flatnonzero((ends <= high) & (sizes > 0))
    back = np.flatnonzero((starts >= low) & (sizes > 0))
    back = back[ends[starts[back]] != back + 1]
    return np.concatenate((ahead, starts[back])), np.concatenate((ends[ahead], back + 1))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _fingerprint_rows(min_words: int):
    """Rows of a text and a fingerprint, the least line hash of a window, so that equal windows share it; with the windows' spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_lines(t.as_py() or "") for t in batch.column(2)]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
            n = int(offsets[-1])
            hashes = np.fromiter((xxh64_intdigest(x.strip()) for p in parts for x in p), dtype=np.uint64, count=n)
            sizes = np.fromiter((len(x.split()) for p in parts for x in p), dtype=np.int64, count=n)
            text = np.repeat(np.arange(len(parts)), np.diff(offsets))
            start, end = windows(sizes, offsets, min_words)
            # equal lines of a text are a place, numbered by text and hash: the least number of a window has its least hash
            order = np.lexsort((hashes, text))
            new = np.ones(n, dtype=bool)
            new[1:] = (np.diff(text[order]) > 0) | (np.diff(hashes[order]) > 0)
            place = np.empty(n + 1, dtype=np.int64)
            place[order], place[n] = np.cumsum(new) - 1, n
            line, count = order[new], np.diff(np.append(np.flatnonzero(new), n))
            own = np.minimum.reduceat(place, np.stack((start, end), axis=1).ravel())[::2] if len(start) else start
            by = np.argsort(own, kind="stable")
            own, start, end = own[by], start[by], end[by]
            flat = memoryview(hashes.astype("<u8").tobytes())
            contents = np.fromiter((xxh64_intdigest(flat[8 * s : 8 * e]) for s, e in zip(start.tolist(), end.tolist())), dtype=np.uint64, count=len(start))
            found, first = np.unique(own, return_index=True)
            base = offsets[text[start]]
            at = pa.array(text[line[found]])
            spans = pa.StructArray.from_arrays([pa.array((start - base).astype(np.int32)), pa.array((end - base).astype(np.int32)), _signed(contents)], names=["start", "end", "content"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(own)).astype(np.int32)), spans)
            columns = [batch.column(0).take(at), batch.column(1).take(at), _signed(hashes[line[found]]), pa.array(count[found].astype(np.int32)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "print", "places", "spans"])

    return run


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``doc_id, version, runs`` of the documents with lines that repeat an earlier run; runs are ``start, end`` of lines.

    Fingerprints in two places or more, of one document or several, are joined with the positions of their windows. Of each window content the
    earliest position, by id, version (a hash of the text) and line, stays; the others are repeated. Repeated windows that
    overlap or touch join up: as windows run ahead from every start and back from every end, that extends a match to all
    of its lines both ways. A window content costs one row a position and no pair of positions is formed, so a passage in a third of all
    documents is as cheap as any.
    """
    version = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    kind = type_of(docs, id_col)
    rows = cut(
        docs.select(F.col(id_col).alias("doc_id"), version.alias("version"), F.col(text_col).alias("text"))
        .mapInArrow(tidy(_fingerprint_rows(min_words)), f"doc_id {kind}, version bigint, print bigint, places int, spans array<struct<start int, end int, content bigint>>")
    )
    # what is counted is written, so that the joins shuffle both sides and Spark may split a value that very many texts share
    often = cut(rows.groupBy("print").agg(F.sum("places").alias("n")).where("n > 1").select("print"))
    placed = rows.join(often, "print").select("doc_id", "version", F.inline("spans"))
    placed = cut(placed.distinct())
    first = cut(placed.groupBy("content").agg(F.min(F.struct("doc_id", "version", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    own = F.struct("doc_id", "version", "start")
    later = placed.join(first, "content").where(own != F.col("first"))
    return later.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))


def _removed(n: int, runs: list[dict]) -> np.ndarray:
    gone = np.zeros(n, dtype=bool)
    for r in runs or ():
        gone[r["start"] : r["end"]] = True
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, lines_as: str | None = None, words_as: str | None = None) -> DataFrame:
    """``docs`` with repeated runs of lines taken out of ``text``; columns of the numbers of lines and words removed, if named, follow.

    A run is ``min_words`` words or more of consecutive lines, equal but for white space around them, that an earlier
    document, or an earlier place of the same one, holds too. All rows stay, and a copy of an earlier document keeps an
    empty text. A null text stays null, one without a line loses nothing. Rows that repeat both id and text are one document
    and are treated alike; a null id comes before all others; an empty table gives no rows; other columns pass through,
    whatever their names. Lines count as equal by 64-bit hashes, of which those of a run's windows make one of 64 bits.
    """
    own, version, found, runs = free_names(docs, "v", "version", "id", "runs")
    told = [c for c in (lines_as, words_as) if c]
    repeated = repeated_runs(docs, id_col, text_col, min_words).withColumnsRenamed({"doc_id": found, "version": version, "runs": runs})
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = keyed.join(repeated, F.col(id_col).eqNullSafe(F.col(found)) & (F.col(own) == F.col(version)), "left")
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(len(names))
            hit = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            lines, words, texts = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64), []
            for i in hit:
                parts = split_lines(batch.column(at)[i].as_py() or "")
                gone = _removed(len(parts), own[i].as_py())
                texts.append("".join(x for x, g in zip(parts, gone) if not g))
                lines[i], words[i] = gone.sum(), sum(len(x.split()) for x, g in zip(parts, gone) if g)
            mask = np.zeros(batch.num_rows, dtype=bool)
            mask[hit] = True
            columns = [*batch.columns[: len(names)], *(pa.array(x) for x, name in ((lines, lines_as), (words, words_as)) if name)]
            columns[at] = pa.compute.replace_with_mask(columns[at], pa.array(mask), pa.array(texts, columns[at].type))
            yield pa.RecordBatch.from_arrays(columns, [*names, *told])

    schema = docs.select(*names, *[F.lit(0).cast("long").alias(c) for c in told]).schema
    return joined.select(*names, runs).mapInArrow(tidy(run), schema)
