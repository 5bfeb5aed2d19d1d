"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokenising needs no shuffle: a task encodes whole texts and emits a row per piece. Pieces are then
packed in random groups of bounded size: best fit first, then a local search that moves one document,
or exchanges one for one, two for one and one for two, from the emptiest bin into fuller ones. Every
step raises the sum of squared fills, until bins become empty. Bins that stay underfull go on to the
next level, where the few that each group left are packed together in fewer groups. No task ever
holds more than ``GROUP_SIZE`` pieces on average, whatever the size of the corpus.

Defined cases: a null text counts as empty and gives one piece with the end id alone; a repeated row is
packed as often as it occurs; an empty table gives an empty result; other columns stay, and a column
that has the name of a result column is an error.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import table_path

CAPACITY = 4096
GROUP_SIZE = 20_000
#: Bins with more free room than this share of the capacity are packed again on the next level.
OPEN_SHARE = 0.01
#: Distinct words a worker remembers; the memory is started anew beyond.
CACHE_WORDS = 600_000
CACHE_CHARS = 40
TEXT_SLICE = 1 << 22


class WordEncoder:
    """Ids of whole texts, little-endian, from the ids of their words.

    The tokenizer never joins characters across a blank or a line end, so a text's ids are those
    of its words in order, and each word is encoded once. It also parts letters from punctuation, so
    a word and its final mark are looked up on their own. Texts of Latin-1 characters, each of which has
    one lower-case form, are lower-cased before, as the tokenizer does itself.
    """

    MARKS = ".,;:!?|#$%&*"

    def __init__(self, path: str, lower: bool = True) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lower, self.known, self.cores = lower, {"": b""}, {"": b""}
        ends = [i for w, i in self.tokenizer.get_vocab(True).items() if w.endswith("</w>")]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(True), bool)
        self.ends_word[ends] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, cores: list[str]) -> None:
        """Ids of words: those of letters alone in one call, parted after the tokens that end a word."""
        letters = [c for c in cores if c.isalpha()]
        ids = self._encode(" ".join(letters)) if letters else np.zeros(0, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(letters):
            data, stops = ids.tobytes(), (4 * ends).tolist()
            self.cores.update((c, data[i:j]) for c, i, j in zip(letters, [0, *stops], stops))
            cores = [c for c in cores if not c.isalpha()]
        for c in cores:
            self.cores[c] = self._encode(c).tobytes()

    def _folded(self, text: str) -> str:
        if self.lower:
            try:
                text.encode("latin-1")
                return text.lower()
            except UnicodeEncodeError:
                pass
        return text

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known, self.cores = {"": b""}, {"": b""}
        split = []
        for w in words:
            if w not in self.known:
                core = w.rstrip(self.MARKS)
                split.append((w, core, w[len(core) :]) if core and core.isalpha() else (w, w, ""))
        self._learn(list({x for _, core, mark in split for x in (core, mark)} - self.cores.keys()))
        for w, core, mark in split:
            self.known[w] = self.cores[core] + self.cores[mark]
        found = list(map(self.known.__getitem__, words))
        for w, core, mark in split:
            if len(w) > CACHE_CHARS:
                for memory, x in ((self.known, w), (self.cores, core), (self.cores, mark)):
                    memory.pop(x, None) if x else None
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Arrow parts the texts and numbers their distinct words; numpy puts the ids in the words' order."""
        column = pc.replace_substring(pa.array([self._folded(t) for t in texts], pa.large_string()), "\n", " ")
        parts = pc.split_pattern(column, " ")
        words = parts.values.dictionary_encode()
        found = self._ids(words.dictionary.to_pylist())
        index = words.indices.to_numpy()
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(size) - size)[index]
        size = size[index]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = ids[np.repeat(first - end[:-1], size) + np.arange(end[-1])]
        at = end[parts.offsets.to_numpy()]
        return [ids[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def text_slices(texts: list[str | None], most: int = TEXT_SLICE) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``most`` characters; a null text is empty."""
    start, part, size = 0, [], 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= most:
            yield start, part
            start, part, size = i + 1, [], 0
    if part:
        yield start, part


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """A row per piece: the other columns of ``docs`` with piece, start, length and ids_crc32."""
    keep = [f for f in docs.schema.fields if f.name != text]
    new = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    clash = {f.name for f in keep} & {n for n, _ in new}
    if clash:
        raise ValueError(f"columns of the input have names of the result: {sorted(clash)}")
    schema = T.StructType([*keep, *[T.StructField(n, t) for n, t in new]])
    names, end = [f.name for f in keep], np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(names.index(text) if text in names else batch.schema.get_field_index(text))
            rows, piece, start, length, crc = [], [], [], [], []
            for first, texts in text_slices(column.to_pylist()):
                for i, ids in enumerate(encode(texts), first):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            kept = batch.select(names).take(pa.array(rows, pa.int64())) if names else None
            own = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([*(kept.columns if names else []), *own], names=[*names, *[n for n, _ in new]])

    return docs.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that still has room."""
    free: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect.bisect_left(free, (size, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > size:
            bisect.insort(free, (room - size, b))
    return bins


def _best_step(give: list[int], take: list[int], lengths: np.ndarray, room: int) -> tuple[int, list[int], list[int]]:
    """The step that fills the taking bin most: (gain, documents given, documents given back)."""
    best = (0, [], [])
    x, y = lengths[give], lengths[take]
    fits = np.where(x <= room, x, 0)
    if fits.size and fits.max() > best[0]:
        best = (int(fits.max()), [give[int(fits.argmax())]], [])
    two_x = np.triu_indices(len(give), 1) if len(give) <= 64 else (np.zeros(0, int),) * 2
    two_y = np.triu_indices(len(take), 1) if len(take) <= 64 else (np.zeros(0, int),) * 2
    for a, b, ga, gb in (
        (x, y, [[g] for g in give], [[t] for t in take]),
        (x[two_x[0]] + x[two_x[1]], y, list(zip(two_x[0], two_x[1])), [[t] for t in take]),
        (x, y[two_y[0]] + y[two_y[1]], [[g] for g in give], list(zip(two_y[0], two_y[1]))),
    ):
        if best[0] == room or not len(a) or not len(b):
            continue
        gain = a[:, None] - b[None, :]
        gain = np.where(gain <= room, gain, 0)
        at = int(gain.argmax())
        if gain.flat[at] > best[0]:
            i, j = divmod(at, len(b))
            out = ga[i] if isinstance(ga[i], list) else [give[k] for k in ga[i]]
            back = gb[j] if isinstance(gb[j], list) else [take[k] for k in gb[j]]
            best = (int(gain.flat[at]), out, back)
    return best


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, donors: int = 24) -> list[list[int]]:
    """Empty the least filled bins into the others while that raises the squared fill."""
    fill = np.array([int(lengths[b].sum()) for b in bins], dtype=np.int64)
    least = -(-int(lengths.sum()) // capacity)
    alive, failed = len(bins), 0
    dead = np.zeros(len(bins), bool)
    while alive > least and failed < donors:
        order = np.argsort(np.where(dead, capacity + 1, fill), kind="stable")
        e = int(order[failed])
        if dead[e] or fill[e] >= capacity:
            break
        for r in order[::-1].tolist():
            if dead[r] or r == e or fill[r] >= capacity or fill[r] < fill[e]:
                continue
            while fill[e] and fill[r] < capacity:
                gain, out, back = _best_step(bins[e], bins[r], lengths, int(capacity - fill[r]))
                if not gain:
                    break
                bins[e] = [i for i in bins[e] if i not in out] + list(back)
                bins[r] = [i for i in bins[r] if i not in back] + list(out)
                fill[e] -= gain
                fill[r] += gain
            if not fill[e]:
                break
        if fill[e]:
            failed += 1
        else:
            dead[e], alive, failed = True, alive - 1, 0
    return [b for b, gone in zip(bins, dead) if not gone]


def pack_lengths(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    lengths = np.asarray(lengths, np.int64)
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """``items`` with sequence_id and offset; a row must not be longer than the capacity.

    A level is written before the next one reads it, so a lost executor repeats a level's tasks
    at most. The number of levels grows with the logarithm of the number of groups.
    """
    spark = items.sparkSession
    clash = {"sequence_id", "offset"} & set(items.columns)
    if clash:
        raise ValueError(f"columns of the input have names of the result: {sorted(clash)}")
    columns = items.columns
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("__open", T.BooleanType())])

    def run(level: int):
        def pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            lengths = rows[length].to_numpy(np.int64)
            if len(lengths) and lengths.max() > capacity:
                raise ValueError("a row is longer than the capacity")
            order, seq, offset, still = [], [], [], []
            for b, members in enumerate(pack_lengths(lengths, capacity)):
                sizes = lengths[members]
                order += members
                seq += [(level << 58) + (int(key[0]) << 24) + b] * len(members)
                offset += (np.cumsum(sizes) - sizes).tolist()
                still += [bool(capacity - sizes.sum() > OPEN_SHARE * capacity)] * len(members)
            out = rows.iloc[order][columns].reset_index(drop=True)
            return out.assign(sequence_id=np.array(seq, np.int64), offset=np.array(offset, np.int64), __open=np.array(still, bool))

        return pack_group

    level, rest, done = 0, items, []
    count = rest.count()
    while True:
        groups = max(1, -(-count // group_size))
        dealt = rest.withColumn("__group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        path = table_path(spark, f"packed-{level}")
        dealt.groupBy("__group").applyInPandas(run(level), schema).write.parquet(path)
        result = spark.read.schema(schema).parquet(path)
        if groups == 1:
            return _union([*done, result]).drop("__open")
        rest = result.filter("__open").select(*columns)
        left = rest.count()
        if -(-left // group_size) >= groups:  # nothing to gain from another level
            return _union([*done, result]).drop("__open")
        done.append(result.filter("NOT __open"))
        count, level = left, level + 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Tokenise and pack: piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    path = table_path(spark, "pieces")
    token_pieces(docs, tokenizer, text, capacity, end_id).write.parquet(path)  # encoded once, read by count and packing
    return pack(spark.read.parquet(path), capacity=capacity)
