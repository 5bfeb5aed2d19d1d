"""Fill-in-the-middle: texts cut at two code points and written in one of three orders.

The code-point boundaries of a text are a compressed set (``boundary_set``): its cardinality gives the number of
units, two selects give the byte offsets of both cuts. A text is worked on alone, in the task that reads it:
nothing is shuffled, and memory follows the longest text of a batch.

Defined cases: a null text is empty and stays plain; a null id is hashed as an empty one. Repeated rows are cut alike.
Texts that hold one of the markers stay plain, as their parts could not be told apart again. Rows keep their
columns; the result is one struct column, and an input column of its name is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.boundary_set import utf8_boundaries


@dataclass(frozen=True)
class FimParams:
    """``fim_percent`` of the texts are cut, ``spm_percent`` of those in suffix-first order; ``seed`` names the draw."""

    fim_percent: int = 90
    spm_percent: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1"


RESULT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def transform(key: str, text: str, p: FimParams = FimParams()) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix length, middle length, output) of one text; the draws hang on the key alone."""
    data = text.encode()
    boundaries = utf8_boundaries(data)
    n = len(boundaries) - 1
    digest = hashlib.sha256(f"{p.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not n or any(m in text for m in (p.prefix, p.suffix, p.middle)) or h3 % 100 >= p.fim_percent:
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = boundaries.select(a), boundaries.select(z)
    prefix, middle, suffix = data[:i].decode(), data[i:j].decode(), data[j:].decode()
    if h4 % 100 < p.spm_percent:
        return n, "spm", a, z - a, f"{p.suffix}{suffix}{p.prefix}{prefix}{p.middle}{middle}"
    return n, "psm", a, z - a, f"{p.prefix}{prefix}{p.suffix}{suffix}{p.middle}{middle}"


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text", into: str = "fim", params: FimParams = FimParams()) -> DataFrame:
    """The rows with a struct (n, form, prefix_chars, middle_chars, output) in the column ``into``."""
    if into in docs.columns:
        raise ValueError(f"column exists: {into}")
    schema = T.StructType([*docs.schema.fields, T.StructField(into, RESULT)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(id)).cast(pa.string()).to_pylist()
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            rows = [transform(k or "", t or "", params) for k, t in zip(keys, texts)]
            kind = kind or pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
            names = [f.name for f in kind]
            cells = pa.array([dict(zip(names, r)) for r in rows], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, into])

    return docs.mapInArrow(cut, schema)


def restored(output: Column, form: Column, params: FimParams = FimParams()) -> Column:
    """The text rebuilt from an output and its form alone; a plain expression.

    A cut text holds no marker and two markers never overlap, so each marker stands in the output exactly once.
    """
    p, s, m = params.prefix, params.suffix, params.middle
    middle = F.substring_index(output, m, -1)
    head = F.substring_index(output, m, 1)

    def after(value: Column, marker: str) -> Column:
        return F.substring(value, F.lit(len(marker) + 1), F.length(value))

    psm = F.concat(after(F.substring_index(head, s, 1), p), middle, F.substring_index(head, s, -1))
    spm = F.concat(F.substring_index(head, p, -1), middle, after(F.substring_index(head, p, 1), s))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
