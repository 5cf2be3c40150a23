"""Helpers shared by the operators: written intermediates and vectorised text hashing.

Word and shingle hashes are 64 bits wide and do not depend on the Python process, so every
executor computes the same values and a re-run after a lost executor does too. Words are
hashed as polynomials over their bytes, whole groups of texts at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.session import work_dir

U64 = np.uint64
#: Odd multiplier of the token-sequence hash and the two of the finaliser (splitmix64).
SEQ_MULT = U64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that read the table, never
    what made it, and values that depend on row placement are fixed from here on.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(docs: DataFrame, key: str = "_row") -> DataFrame:
    """``docs`` as a written table with a unique long per row (repeated rows stay apart)."""
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text (null: empty), whatever else the input carries."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so sums and high bits of its results behave as random."""
    x = x ^ (x >> U64(30))
    x = x * MIX_1
    x = x ^ (x >> U64(27))
    x = x * MIX_2
    return x ^ (x >> U64(31))


#: Bytes of text hashed in one go, and the largest base of the polynomial's memo of powers.
CHUNK_BYTES = 1 << 20
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=U64) * SEQ_MULT)
_LOWER = _BYTE.copy()
_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = U64(0xD1342543DE82EF95)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the polynomial's base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1024)
        _POWERS[:] = [np.concatenate([np.ones(1, U64), np.full(size - 1, x)]).cumprod(dtype=U64)
                      for x in (_BASE, _BASE_INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: Sequence[bytes], lower: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of many texts, some texts at a time.

    Yields (hashes, offsets): text i of the group has hashes[offsets[i]:offsets[i + 1]].
    ``lower`` makes A-Z equal to a-z. A group is ``CHUNK_BYTES`` of text, or one longer text;
    memory is about 40 bytes per byte of the group.
    """
    table, group, held = _LOWER if lower else _BYTE, [], 0
    for i, t in enumerate(texts):
        group.append(t)
        held += len(t) + 1
        if held < CHUNK_BYTES and i + 1 < len(texts):
            continue
        data = np.frombuffer(b"\n".join(group) + b"\n", dtype=np.uint8)
        white = _WHITE[data]
        edge = np.flatnonzero(white[1:] != white[:-1]) + 1
        if not white[0]:
            edge = np.concatenate([np.zeros(1, edge.dtype), edge])
        starts, ends = edge[::2], edge[1::2]
        up, down = powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(table[data] * up[:-1], dtype=U64)])
        h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))
        begin = np.cumsum([0] + [len(t) + 1 for t in group])
        yield h, np.searchsorted(starts, begin)
        group, held = [], 0


def sequence_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Mixed hash of every run of ``width`` token hashes (empty when there are fewer)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    acc = h[:n].copy()
    for j in range(1, width):
        acc = acc * SEQ_MULT + h[j:j + n]
    return mix(acc)


def shingle_sets(texts: Sequence[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """For every text the sorted distinct hashes of its ``width``-word shingles.

    Words are lower-cased in A-Z. With fewer words the whole sequence is one shingle;
    without words the set is empty.
    """
    for h, at in word_hashes(texts):
        runs = sequence_hashes(h, width)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(runs[a:b - width + 1])
            else:
                yield sequence_hashes(h[a:b], b - a) if b > a else np.empty(0, dtype=U64)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Rows of a batch that are turned into Python values at a time.
SLICE = 1024


def append_columns(df: DataFrame, source: str, fields: T.StructType,
                   compute: Callable[[list], Sequence], keep_source: bool = True) -> DataFrame:
    """``df`` with ``fields`` added, computed batch by batch from the column ``source``.

    ``compute`` gets the batch's values and returns one array or list per field. The other
    columns pass through as Arrow arrays, so their types and nulls stay as they are; ``source``
    itself does not come back where ``keep_source`` is false.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = list(to_arrow_schema(fields))
    kept = [f for f in df.schema.fields if keep_source or f.name != source]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(b.schema.get_field_index(source))
            # some rows at a time, so that a batch of long texts is never held as Python values as a whole
            new = [[pa.array(x, type=f.type) for x, f in zip(compute(values.slice(i, SLICE).to_pylist()), added, strict=True)]
                   for i in range(0, max(b.num_rows, 1), SLICE)]
            cols = [*(b.column(b.schema.get_field_index(n)) for n in names),
                    *(pa.concat_arrays(x) for x in zip(*new, strict=True))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f.name for f in added)])

    return df.mapInArrow(run, T.StructType([*kept, *fields.fields]))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until the input has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Columns of ``documents`` that operators read by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def neutral(docs: DataFrame, *own: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but those of ``DOCUMENT`` and ``own`` under neutral names, and the names before.

    Operators that hand their input's columns through work on this, so no extra column can clash with
    their helpers, and give the names back with ``toDF``.
    """
    names = docs.columns
    return docs.toDF(*(c if c in (*DOCUMENT, *own) else f"extra{i}" for i, c in enumerate(names))), names


#: Entries of a key list that may be broadcast (a few tens of MB); longer lists are shuffled.
BROADCAST_ROWS = 1_000_000


def join_keys(rows: DataFrame, keys: DataFrame, on, how: str, entries=None,
              limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join wide ``rows`` with a written list of short ``keys``.

    The list is counted first (``entries``: a column that says how many each row holds): up to
    ``limit`` it is broadcast, so the wide rows stay where they are; a longer list takes the
    ordinary shuffle join with skew handling.
    """
    size = keys.count() if entries is None else keys.agg(F.sum(entries)).first()[0] or 0
    return rows.join(F.broadcast(keys) if size <= limit else keys, on, how)


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the byte polynomial, for :func:`range_hashes`."""
    up, _ = powers(len(data) + 1)
    return np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[data] * up[:-1], dtype=U64)])


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end) of each range; equal bytes have equal hashes."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [start, end) ranges, as maximal ranges in order (touching ones join)."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``data`` without the (merged) spans."""
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])
