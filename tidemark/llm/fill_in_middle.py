"""Fill-in-the-middle by block rotation within one buffer.

A document is cut in prefix, middle and suffix at two of its line ends, drawn from a hash of its key. Sentinels are put in
a bytearray in document order, ``<P>prefix<M>middle<S>suffix``; then two neighbouring blocks change places by three
reversals, without a second copy of the text: ``<M>middle`` with ``<S>suffix`` for the order prefix, suffix, middle
(psm), all before the suffix with the suffix for suffix, prefix, middle (spm). ``restore`` finds the sentinels, rotates
back and takes them out, which gives every byte of the text again.

Rows are independent, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, slices, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Seed of the draw, percentage of documents that are transformed, and of these in the order suffix, prefix, middle.
SEED, RATE, SPM = 7, 100, 50
#: Bytes that a reversal moves at once: its only extra memory.
_STEP = 1 << 16


def reverse(buffer: bytearray, low: int, high: int) -> None:
    """Reverse ``buffer[low:high]`` in place."""
    view = np.frombuffer(buffer, np.uint8)
    while high - low > 1:
        n = min(_STEP, (high - low) // 2)
        held = view[low:low + n][::-1].copy()
        view[low:low + n] = view[high - n:high][::-1]
        view[high - n:high] = held
        low, high = low + n, high - n


def rotate(buffer: bytearray, low: int, middle: int, high: int) -> None:
    """Exchange the neighbouring blocks ``[low:middle]`` and ``[middle:high]``; their lengths may differ."""
    reverse(buffer, low, middle)
    reverse(buffer, middle, high)
    reverse(buffer, low, high)


def draws(key, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers below 2 ** 32 for a key; a null key is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def line_ends(text: bytes) -> np.ndarray:
    """Place behind every line; the last one may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not len(text) or text.endswith(b"\n") else np.append(ends, len(text))


def _points(data: memoryview) -> int:
    """Code points of UTF-8: bytes that do not go on with one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def transform(text: bytes, key, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple:
    """lines, form, code points of prefix and of middle (None if plain), output."""
    ends = line_ends(text)
    h1, h2, h3, h4 = draws(key, seed)
    n = len(ends)
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    view = memoryview(text)
    chars = _points(view[:a]), _points(view[a:b])
    buffer = bytearray(text)
    for place, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[place:place] = sentinel
    a, b = a + 3, b + 6  # where <M> and <S> begin now
    form = "spm" if h4 % 100 < spm else "psm"
    rotate(buffer, 0 if form == "spm" else a, b, len(buffer))
    return n, form, *chars, bytes(buffer)


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` made ``output`` of. Raises if a sentinel is missing or out of order."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    p, s, m = (buffer.index(x) for x in (PREFIX, SUFFIX, MIDDLE))
    if not (0 == s < p < m if form == "spm" else 0 == p < s < m):
        raise ValueError(f"sentinels are not in the order of {form}")
    if form == "spm":
        rotate(buffer, 0, p, len(buffer))  # the suffix goes behind the rest
        b = len(buffer) - p
        a = m - p
    else:
        rotate(buffer, s, m, len(buffer))
        a = s
        b = s + len(buffer) - m
    for place in (b, a, 0):
        del buffer[place:place + 3]
    return bytes(buffer)


def _transformed(seed: int, rate: int, spm: int):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch, "text"):
                part = batch.slice(start, stop - start)
                made = [transform(t or b"", k, seed, rate, spm)
                        for t, k in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("key").to_pylist(), strict=True)]
                n, form, prefix, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array(output, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output: one row per row of ``docs``.

    A text that is empty (or null) or holds a sentinel stays as it is, form ``plain``, as do the documents above ``rate``
    percent. Rows that repeat a key are cut by the same numbers; a null key has its own. Parts may be empty. Other
    columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_transformed(seed, rate, spm),
                           f"doc_id {dict(rows.dtypes)['id']}, n long, form string, prefix_chars long, middle_chars long, output string")


def _restored(batches):
    for batch in batches:
        for start, stop in slices(batch, "output"):
            part = batch.slice(start, stop - start)
            texts = [None if t is None else restore(t, f) for t, f in zip(
                part.column("output").cast(pa.binary()).to_pylist(), part.column("form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*part.schema.names, "restored"])


def restored(made: DataFrame) -> DataFrame:
    """``made``, a table of ``fill_in_middle``, with the text that each output was made of."""
    return made.mapInArrow(_restored, ", ".join(f"`{c}` {t}" for c, t in made.dtypes) + ", restored string")


OP12_SQL = r"""
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM (SELECT *, least(x, y) AS a, greatest(x, y) AS b
    FROM (SELECT *, CAST(CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (n + 1) AS BIGINT) AS x,
        CAST(CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (n + 1) AS BIGINT) AS y
      FROM (SELECT *, CAST(len(u) AS BIGINT) AS n
        FROM (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
          FROM documents)))))
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark, sf_dir):
    made = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
