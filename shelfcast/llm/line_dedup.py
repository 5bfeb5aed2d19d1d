"""Line dedup: repeated line runs from suffix ranks by prefix doubling; later copies are deleted.

Every text is a sequence of line ids. The suffixes of all texts are ranked by distributed prefix doubling: the
rank of a suffix by its first 2^k lines is the place of the pair (rank by 2^(k-1) lines, rank of the suffix 2^(k-1)
lines on) among the sorted pairs. Only suffixes that share their prefix with another one go on, so a round
costs what is still repeated. A prefix has to reach ``min_words`` words, which bounds the rounds.

A window is the shortest run of lines from a position, forward or backward, with ``min_words`` words. Two
ranks name a window exactly, as two runs of 2^k lines cover it. Windows of the same name are an interval of
the suffix array whose common prefix is at least that long; all but the first of them, in order of document
and position, are later copies. The windows inside a longer repeated run cover all of it, so whole maximal runs go,
and a line goes only if it lies in a run of ``min_words`` words or more that occurs earlier as well.

Rows of one document meet in one task, rows of one pair or window are only counted or reduced to their
least position, with partial sums in every task, so a line that a third of all documents holds is not hot.

Defined cases: a null text stays null; an empty text has one empty line; runs overlapping their own first copy
stay; rows that agree in id and text are one document and edited alike; a null id comes first. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import text_hash as th
from shelfcast.llm.tables import written
from shelfcast.operators.reshape import with_serial

MIN_WORDS = 50
_LOW = -(1 << 63)
_POSITION = "doc long, text_key long, line int, forward int, backward int, rank long"
_STEP = "doc long, text_key long, line int, forward int, backward int, r1 long, r2 long, lines int"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)), "__key": F.xxhash64("text")})


def _windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest run with ``least`` words from each line on, and up to each line; 0 where there is none."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = np.arange(len(words))
    end = np.searchsorted(total, total[:-1] + least, side="left")
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    return np.where(end <= len(words), end - n, 0), np.where(start >= 0, n + 1 - start, 0)


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """A row per line: its hash as rank, and the length of the windows that start and end there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = batch.column("__doc").to_numpy(), batch.column("__key").to_numpy()
            for lo, hi, data, offsets in th.slices(batch.column("text")):
                starts, ends, upto = th.line_spans(data, offsets)
                words = th.word_spans(data, offsets)[0]
                count = np.searchsorted(words, ends) - np.searchsorted(words, starts)
                per_row = np.diff(upto)
                both = [_windows(count[a:b], least) for a, b in zip(upto[:-1], upto[1:])]
                line = np.arange(len(starts)) - np.repeat(upto[:-1], per_row)
                columns = [
                    np.repeat(doc[lo:hi], per_row), np.repeat(key[lo:hi], per_row), line.astype(np.int32),
                    np.concatenate([f for f, _ in both]).astype(np.int32), np.concatenate([b for _, b in both]).astype(np.int32),
                    th.span_hashes(data, starts, ends).view(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "text_key", "line", "forward", "backward", "rank"])

    return docs.filter("text IS NOT NULL").select("__doc", "__key", "text").mapInArrow(run, _POSITION)


def _step(positions: DataFrame, k: int) -> DataFrame:
    """From ranks by 2^k lines: the pairs of the next round (lines = 0) and the windows of 2^k to 2^(k+1) - 1 lines.

    ``forward`` belongs to the first of a row's 2^k lines, ``backward`` to the last one.
    """
    span = 1 << k

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Whole documents, as the rows come sorted by document and line."""
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {n: batch.column(n).to_numpy() for n in batch.schema.names}
            if held is not None:
                rows = {n: np.concatenate([held[n], rows[n]]) for n in rows}
            if not len(rows["doc"]):
                continue
            last = (rows["doc"] == rows["doc"][-1]) & (rows["text_key"] == rows["text_key"][-1])
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            held = {n: c[cut:] for n, c in rows.items()}
            if cut:
                yield {n: c[:cut] for n, c in rows.items()}
        if held is not None and len(held["doc"]):
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in documents(batches):
            new = np.concatenate([[True], (rows["doc"][1:] != rows["doc"][:-1]) | (rows["text_key"][1:] != rows["text_key"][:-1])])
            place = (np.cumsum(new) << 32) + rows["line"]
            rank = rows["rank"]

            def at(where: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Index of the row ``distance`` lines on in the same document, and whether it is there."""
                i = np.minimum(np.searchsorted(place, place[where] + distance), len(place) - 1)
                return i, place[i] == place[where] + distance

            parts = []
            every = np.arange(len(place))
            i, there = at(every, np.full(len(place), span))
            parts.append((every[there], i[there], np.zeros(there.sum(), np.int64)))
            size = rows["forward"].astype(np.int64)
            here = np.flatnonzero((size >= span) & (size < 2 * span))
            last, there = at(here, size[here] - span)
            parts.append((here[there], last[there], size[here][there]))
            size = rows["backward"].astype(np.int64)
            here = np.flatnonzero((size >= span) & (size < 2 * span))
            first, there = at(here, span - size[here])
            parts.append((first[there], here[there], size[here][there]))
            a, b, size = (np.concatenate([p[j] for p in parts]) for j in range(3))
            columns = [rows["doc"][a], rows["text_key"][a], rows["line"][a], rows["forward"][a], rows["backward"][b], rank[a], rank[b], size.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "text_key", "line", "forward", "backward", "r1", "r2", "lines"])

    return positions.repartition("doc", "text_key").sortWithinPartitions("doc", "text_key", "line").mapInArrow(run, _STEP)


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, text_key, line, lines): the windows that occur earlier, without overlap in the same document."""
    lines = written(_lines(_keyed(docs), min_words), "lines")
    twice = lines.groupBy("rank").agg(F.count("*").alias("n")).filter("n > 1").select("rank")
    positions = lines.join(twice, "rank").select("doc", "text_key", "line", "forward", "backward", "rank")
    longest = lines.agg(F.max(F.greatest("forward", "backward"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows, k = None, 0
    while (1 << k) <= longest:
        step = written(_step(positions, k), f"step-{k}")
        found = step.filter("lines > 0").withColumn("k", F.lit(k))
        windows = found if windows is None else windows.unionByName(found)
        k += 1
        if (1 << k) > longest:
            break
        pairs = step.filter("lines = 0")
        repeated = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n")).filter("n > 1").select("r1", "r2")
        ranks = with_serial(repeated, ["r1", "r2"], "rank", buckets=partitions)
        positions = pairs.join(ranks, ["r1", "r2"]).select("doc", "text_key", "line", "forward", "backward", "rank")
    if windows is None:
        return lines.select("doc", "text_key", "line", F.lit(0).alias("lines")).limit(0)
    name = ["k", "lines", "r1", "r2"]
    first = windows.groupBy(*name).agg(F.min(F.struct("doc", "text_key", "line")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = (F.col("first.doc") == F.col("doc")) & (F.col("first.text_key") == F.col("text_key"))
    later = windows.join(first, name).filter(~same | (F.col("line") >= F.col("first.line") + F.col("lines")))
    return later.select("doc", "text_key", "line", "lines")


def _runs(windows: DataFrame) -> DataFrame:
    """(doc, text_key, cuts): the windows of each document, as start and length."""
    return windows.groupBy("doc", "text_key").agg(F.collect_set(F.struct("line", "lines")).alias("cuts"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, removed: str | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of the text.

    With ``removed`` a column of that name holds the numbers of the lines that went, from 0.
    """
    cuts = written(_runs(later_copies(docs, min_words)), "cuts").withColumnsRenamed({"doc": "__doc", "text_key": "__key"})
    # The cuts grow with the corpus, so they meet the texts by a shuffle at every size, never by broadcast.
    joined = _keyed(docs).join(cuts.hint("merge"), ["__doc", "__key"], "left")
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform("cuts", lambda c: F.sequence(c["line"], c["line"] + c["lines"] - 1)))))
    joined = joined.withColumn("__gone", F.coalesce(gone, F.array().cast("array<int>")))
    rest = joined.select(*docs.columns, "__gone")
    schema, docs_columns = docs.schema, list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, numbers = batch.column(at).to_pylist(), batch.column("__gone").to_pylist()
            for i, drop in enumerate(numbers):
                if drop and texts[i] is not None:
                    drop = set(drop)
                    texts[i] = "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in drop)
            columns = [pa.array(texts, batch.schema.field(at).type) if j == at else batch.column(j) for j in range(len(docs_columns))]
            if removed:
                columns.append(batch.column("__gone"))
            yield pa.RecordBatch.from_arrays(columns, [*docs_columns, *([removed] if removed else [])])

    if removed:
        schema = type(schema)([*schema.fields]).add(removed, T.ArrayType(T.IntegerType()))
    return rest.mapInArrow(run, schema)
